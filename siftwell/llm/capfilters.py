"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector belongs to every filter it exceeds a threshold on. The directions form a
structured random product code: the rotated space is cut into four parts, each part has ``k`` random unit
directions, and a filter is one choice from each part, ``k ** 4`` in all. A vector is list-decoded: sums of
the first two and of the last two parts are sorted, and only those that can still reach the threshold are
joined, so the cost follows the filters found and not the filters there are. The code grows with the number
of vectors, without end, which holds the size of an ordinary filter constant. A vector in few caps takes its best
filters instead. How many it takes at least follows from the wanted recall: pairs at exactly the link's cosine are
drawn for the dimension and the code, and the list grows until ``RECALL`` of them share a filter; closer pairs
share one more often.

Members of a filter meet twice. First with ``BITS`` signs of random projections each: who has nobody within
``MOST_BITS`` of its signs leaves (a pair at the link's cosine is further apart with a probability below 1e-6). Those that
stay fetch their vectors and are compared exactly; a pair counts only in its first common filter, and a task emits
each member's link count and a spanning forest, never the pairs. Both happen in blocks of at most ``BLOCK``.
Equal vectors are one class beforehand, so a large group of copies costs one vector.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing;
vectors of other lengths meet only their own kind; a null vec_id links with nothing; rows that share a vec_id are one
vector to the components; ties at the threshold belong to the filter; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm import bytetext as bt
from siftwell.llm.components import components
from siftwell.llm.support import arrow_batches, settle, small

COSINE = 0.95
PARTS = 4
#: Share of pairs at the link's cosine that share a filter, how many such pairs are drawn, and the list sizes tried.
RECALL, DRAWN = 0.9995, 2000
LISTS = [4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024]
SEED = 90125
BLOCK = 1500
#: Members of an ordinary filter if a vector is in USUAL_LIST of them.
LOAD, USUAL_LIST = 500, 16
#: Signs of a sketch, and the most that may differ: 13 do on average at a cosine of 0.95, 64 among strangers.
BITS, MOST_BITS = 128, 32
#: Sums of parts worked on at once.
_SUMS = 1 << 20


def code_size(vectors: int) -> int:
    """Directions in each part for so many vectors."""
    return int(max(4, np.ceil((max(vectors, 1) * USUAL_LIST / LOAD) ** (1 / PARTS))))


@lru_cache(maxsize=8)
def code(dim: int, k: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rotation and unit directions of each part (norm 1/2 each, so that a filter has norm 1)."""
    rng = np.random.default_rng([SEED, dim, k])
    rotation, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    parts = []
    for columns in np.array_split(np.arange(dim), PARTS):
        d = rng.standard_normal((k, max(len(columns), 1)))
        parts.append(d / np.linalg.norm(d, axis=1, keepdims=True) / np.sqrt(PARTS))
    return rotation, parts


def threshold(dim: int, k: int, least: int) -> float:
    """What a filter must exceed: half of ``least`` filters do on average."""
    return NormalDist().inv_cdf(1 - min(0.5, least / 2 / k**PARTS)) / np.sqrt(dim)


@lru_cache(maxsize=8)
def planes(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim, 0, 1]).standard_normal((dim, BITS))


def pairs_at(cosine: float, dim: int, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random pairs of unit vectors at exactly the cosine."""
    rng = np.random.default_rng([SEED, dim, seed])
    a, b = rng.standard_normal((2, n, dim))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    return a, cosine * a + np.sqrt(1 - cosine * cosine) * b


def shared_share(dim: int, k: int, least: int, cosine: float, n: int, seed: int) -> float:
    """Share of random pairs at the cosine that share a filter."""
    keys = [row * np.int64(k) ** PARTS + found for row, found in (decode(x, k, least) for x in pairs_at(cosine, dim, n, seed))]
    return len(np.unique(np.intersect1d(*keys) // np.int64(k) ** PARTS)) / n


@lru_cache(maxsize=4096)
def list_size(dim: int, k: int, cosine: float = COSINE) -> int:
    """The fewest filters of a vector that let ``RECALL`` of the drawn pairs meet."""
    if dim < 2:
        return LISTS[0]
    sizes = [*(x for x in LISTS if x < k**PARTS), k**PARTS]
    # a longer list shares more: the first that suffices is found by halving
    return sizes[bisect_left(sizes, True, hi=len(sizes) - 1, key=lambda x: shared_share(dim, k, x, cosine, DRAWN, 1) >= RECALL)]


def decode(unit: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of every filter that the unit vectors exceed, by row and filter.

    A vector that exceeds fewer than ``least`` belongs to that many of its best filters.
    """
    run = max(1, _SUMS // (k * k))
    if len(unit) <= run:
        return _decode(unit, k, least)
    found = [_decode(unit[at : at + run], k, least) for at in range(0, len(unit), run)]
    rows = [row + at for (row, _), at in zip(found, range(0, len(unit), run), strict=True)]
    return np.concatenate(rows), np.concatenate([f for _, f in found])


def _decode(unit: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    n, dim = unit.shape
    rotation, parts = code(dim, k)
    turned = unit @ rotation
    scores = []
    for columns, directions in zip(np.array_split(np.arange(dim), PARTS), parts, strict=True):
        scores.append(turned[:, columns] @ directions.T if len(columns) else np.zeros((n, k)))
    first = (scores[0][:, :, None] + scores[1][:, None, :]).reshape(n, -1)
    second = (scores[2][:, :, None] + scores[3][:, None, :]).reshape(n, -1)
    order = np.argsort(-second, axis=1)
    ranked = np.take_along_axis(second, order, axis=1)
    # the last of the best sums is among those of ranks i, j with (i + 1) (j + 1) <= least
    least = min(least, k**PARTS)
    reach = min(least, k * k)
    top = -np.sort(-first, axis=1)[:, :reach]
    i, j = (np.array(r) for r in zip(*[(i, j) for i in range(reach) for j in range(min(reach, least // (i + 1)))], strict=True))
    limit = -np.sort(-(top[:, i] + ranked[:, j]), axis=1)[:, least - 1]
    limit = np.minimum(threshold(dim, k, least), limit) - 1e-12
    row, left = np.nonzero(first >= (limit - ranked[:, 0])[:, None])
    need = limit[row] - first[row, left]
    reach = np.empty(len(row), np.int64)
    step = max(1, 4 * _SUMS // (k * k))
    for at in range(0, len(row), step):
        part = slice(at, at + step)
        reach[part] = (ranked[row[part]] >= need[part, None]).sum(axis=1)
    out = np.repeat(np.arange(len(row)), reach)
    nth = np.arange(len(out)) - np.repeat(np.cumsum(reach) - reach, reach)
    rows = row[out]
    found = left[out].astype(np.int64) * k * k + order[rows, nth]
    by = np.lexsort((found, rows))
    return rows[by], found[by]


def _decoder(codes: dict[int, tuple[int, int]]):
    """Filters and sketches of vectors; ``codes`` has k and the list size of each length of vectors."""

    def run(batches):
        for batch in batches:
            vectors = batch.column("vector")
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            reps = batch.column("rep")
            for dim in np.unique(sizes):
                own = np.flatnonzero(sizes == dim)
                raw = flat[(starts[own][:, None] + np.arange(dim)).reshape(-1)].reshape(len(own), dim)
                # vectors of other scales must not overflow
                x = raw.astype(np.float64)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                row, found = decode(x, *codes[int(dim)])
                ends = np.searchsorted(row, np.arange(len(own) + 1)).astype(np.int32)
                signs = np.packbits(x @ planes(int(dim)) > 0, axis=1).view(np.int64)
                columns = {
                    "rep": reps.take(pa.array(own)),
                    "dim": pa.array(np.full(len(own), dim, np.int32)),
                    "vector": vectors.take(pa.array(own)),
                    "filters": pa.ListArray.from_arrays(pa.array(ends), pa.array(found)),
                    "signs0": pa.array(signs[:, 0]),
                    "signs1": pa.array(signs[:, 1]),
                }
                yield pa.RecordBatch.from_arrays([*columns.values()], [*columns])

    return run


def _sieve(batches):
    """Members (dim, filter, lo, hi, rep, block) that have another with close signs in their filter."""
    for batch in batches:
        sizes = np.diff(batch.column("members").offsets.to_numpy())
        members = batch.column("members").flatten()
        rep, block, *signs = (members.field(c).to_numpy(zero_copy_only=False) for c in ("rep", "block", "signs0", "signs1"))
        bits = np.unpackbits(np.stack(signs, axis=1).view(np.uint8), axis=1).astype(np.float32) * 2 - 1
        crossed = batch.column("lo").to_numpy() != batch.column("hi").to_numpy()
        ends = np.cumsum(sizes)
        stay, group = [], []
        for g in range(len(sizes)):
            a, b = ends[g] - sizes[g], ends[g]
            near = bits[a:b] @ bits[a:b].T >= BITS - 2 * MOST_BITS
            np.fill_diagonal(near, False)
            if crossed[g]:
                near &= block[a:b, None] != block[None, a:b]
            hit = np.flatnonzero(near.any(axis=1))
            stay.append(hit + a)
            group.append(np.full(len(hit), g))
        stay, group = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (stay, group))
        told = [batch.column(c).take(pa.array(group)) for c in ("dim", "filter", "lo", "hi")]
        yield pa.RecordBatch.from_arrays([*told, pa.array(rep[stay]), pa.array(block[stay])], ["dim", "filter", "lo", "hi", "rep", "block"])


def _repeats(filters: list[np.ndarray], below: int) -> np.ndarray | None:
    """Which members have a common filter below the given one, as a matrix; ``filters`` lists each member's."""
    lists = [f[f < below] for f in filters]
    owner = np.repeat(np.arange(len(filters)), [len(x) for x in lists])
    values, index, seen = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    use = seen[index] > 1
    if not use.any():
        return None
    _, index = np.unique(index[use], return_inverse=True)
    owner = owner[use]
    common = np.zeros((len(filters), len(filters)), np.float32)
    for low in range(0, int(index.max()) + 1, 4096):
        part = (index >= low) & (index < low + 4096)
        dense = np.zeros((len(filters), 4096), np.float32)
        dense[owner[part], index[part] - low] = 1
        common += dense @ dense.T
    return common > 0


def _linker(cosine: float):
    def run(batches):
        for batch in batches:
            sizes = np.diff(batch.column("members").offsets.to_numpy())
            members = batch.column("members").flatten()
            ends = np.cumsum(sizes)
            reps = members.field("rep").to_numpy(zero_copy_only=False)
            copies = members.field("copies").to_numpy(zero_copy_only=False)
            block = members.field("block").to_numpy(zero_copy_only=False)
            vectors, filters = members.field("vector"), members.field("filters")
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            at = np.concatenate([[0], np.cumsum(np.diff(vectors.offsets.to_numpy()))])
            ids = filters.flatten().to_numpy(zero_copy_only=False)
            fat = np.concatenate([[0], np.cumsum(np.diff(filters.offsets.to_numpy()))])
            names, lows, highs = (batch.column(c).to_numpy() for c in ("filter", "lo", "hi"))
            out = []
            for g in range(len(sizes)):
                a, b = ends[g] - sizes[g], ends[g]
                x = flat[at[a] : at[b]].reshape(b - a, -1)
                x = x / np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                near = x @ x.T >= cosine
                np.fill_diagonal(near, False)
                if lows[g] != highs[g]:
                    near &= block[a:b, None] != block[None, a:b]
                hit = np.flatnonzero(near.any(axis=1))
                if not len(hit):
                    continue
                near = near[np.ix_(hit, hit)]
                seen = _repeats([ids[fat[a + m] : fat[a + m + 1]] for m in hit], int(names[g]))
                if seen is not None:
                    near &= ~seen
                i, j = np.nonzero(np.triu(near, 1))
                if not len(i):
                    continue
                label = bt.forest(len(hit), i, j)
                out.append((reps[a + hit], near @ copies[a + hit], reps[a + hit[label]]))
            columns = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out, strict=True) if out else ([], [], []))]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["rep", "links", "root"])

    return run


def near_vectors(table: DataFrame, cosine: float = COSINE, vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``table`` (vec_id, embedding)."""
    arrow_batches(table.sparkSession)
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    fine = F.coalesce(
        F.col("vec_id").isNotNull()
        & F.exists("vector", lambda x: x != 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))),
        F.lit(False),
    )
    rows = rows.select("vec_id", F.when(fine, F.col("vector")).alias("vector"))
    # -0.0 and 0.0 make equal vectors
    rows = rows.select("vec_id", F.transform("vector", lambda x: x + F.lit(0).cast("float")).alias("vector"))
    classes = settle(
        rows.where(F.col("vector").isNotNull())
        .groupBy("vector")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    )
    lengths = classes.groupBy(F.size("vector").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()
    codes = {r["dim"]: (k := code_size(r["n"]), list_size(r["dim"], k, cosine)) for r in lengths}
    kind = dict(rows.dtypes)["vector"]
    decoded = settle(
        classes.select("rep", "vector").mapInArrow(
            _decoder(codes), f"rep long, dim int, vector {kind}, filters array<long>, signs0 long, signs1 long"
        )
    )
    placed = decoded.select("rep", "dim", F.explode("filters").alias("filter"), "signs0", "signs1")
    crowded = placed.groupBy(F.col("dim").alias("cd"), F.col("filter").alias("cf")).agg(F.count(F.lit(1)).alias("members"))
    crowded = small(settle(crowded.where(F.col("members") > BLOCK).select("cd", "cf", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))))
    placed = placed.join(crowded, (F.col("dim") == F.col("cd")) & (F.col("filter") == F.col("cf")), "left").drop("cd", "cf")
    count = F.coalesce("blocks", F.lit(1))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), count).cast("int"))
    pair = lambda b: F.struct(F.least("block", b).alias("lo"), F.greatest("block", b).alias("hi"))
    placed = placed.withColumn("pair", F.explode(F.transform(F.sequence(F.lit(0), count - 1), pair))).select("*", "pair.lo", "pair.hi")
    meet = ["dim", "filter", "lo", "hi"]
    groups = placed.groupBy(*meet).agg(F.collect_list(F.struct("rep", "block", "signs0", "signs1")).alias("members"))
    close = groups.where(F.size("members") > 1).mapInArrow(_sieve, "dim int, filter long, lo int, hi int, rep long, block int")
    details = decoded.select(F.col("rep").alias("own"), "vector", "filters").join(
        classes.select(F.col("rep").alias("class_rep"), "copies"), F.col("own") == F.col("class_rep")
    ).select("own", "vector", "filters", "copies")
    full = close.join(details, F.col("rep") == F.col("own"))
    exact = full.groupBy(*meet).agg(F.collect_list(F.struct("rep", "copies", "block", "vector", "filters")).alias("members"))
    found = settle(exact.mapInArrow(_linker(cosine), "rep long, links long, root long"))
    links = found.groupBy(F.col("rep").alias("linked")).agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    named = (
        classes.join(links, F.col("rep") == F.col("linked"), "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select(
            F.col("vector").alias("class_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "rep").alias("found"),
        )
    )
    out = rows.join(named, F.col("vector") == F.col("class_vector"), "left")
    component = F.coalesce("found", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS norm FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_contains(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)), true)),
f AS (SELECT * FROM v WHERE norm > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM f a JOIN f b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
r AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.node),
c AS (SELECT node, min(root) AS root FROM r GROUP BY node),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, c.root AS component_id, c.root = e.vec_id AS kept
FROM embeddings e JOIN c ON c.node = e.vec_id LEFT JOIN n ON n.x = e.vec_id
"""
