"""Near-duplicate documents by SetSketch registers.

1. A document's set of distinct word shingles becomes ``REGISTERS`` registers. Every shingle drives a
   Poisson process of points, each thrown to a random register; a register keeps the least point, which
   is exponential in the set's size, and stores its truncated logarithm to base ``BASE``. Registers of a
   union are the maxima of registers, so sketches merge; equal registers are locality-sensitive.
2. Documents of equal sets form one class, and one representative goes on.
3. ``BANDS`` bands of ``ROWS`` registers give bucket keys. Buckets with one member drop out; a large bucket
   is cut into blocks, and only blocks that are not connected yet meet (see ``components.connected``), so no task
   holds more than two blocks. A pair is weighed only in its first common band, by the joint likelihood of its registers given both
   set sizes; pairs whose likelihood already falls ``DOUBT`` below the wanted similarity are implausible. A task emits a spanning
   forest of its plausible pairs, never the pairs.
4. Components of the plausible forest are compared exactly in the same way: full shingle sets meet in blocks,
   parts that are linked already do not meet again, intersections are counted, and a spanning forest of the links with
   ``100 * intersection >= link * union`` is emitted. Components of those are the result.

A pair at similarity 0.85 (0.80) shares no band with probability 2e-10 (1e-7), and is weighed implausible
with a probability of about 1e-5 (2e-5).

Edge cases: documents without words have an empty set and link with nothing; a null doc_id links with
nothing and has no component; rows that share a doc_id are one document to the links; equal texts always
share a component; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwell.llm import bytetext as bt
from siftwell.llm.components import connected
from siftwell.llm.support import arrow_batches, settle

BANDS, ROWS = 30, 4
REGISTERS = BANDS * ROWS
BASE, RATE, LEVELS = 1.1, 20.0, 255
#: Links need 100 * intersection >= link * union: the contract of the query, and the pipeline's.
LINK, STAGE_LINK = 85, 80
#: A pair is plausible if its register likelihood still rises so far below the link's similarity.
DOUBT = 0.15
#: Members of a bucket block; shingles and members of a verification block.
BLOCK, SET_BLOCK, MEMBER_BLOCK = 800, 400_000, 800
_SEED = bt.U64(0x5E75E7C4)
_PRINT_SEEDS = bt.mix64(np.array([11, 12], np.uint64))


def _units(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1) from 64-bit hashes."""
    return ((x >> bt.U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def registers(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(rows, REGISTERS) bytes; a register is 0 where the set is empty or the minimum lies above the range."""
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    least = np.full((n, REGISTERS), np.inf)
    limit = np.zeros(n)
    todo = np.flatnonzero(sizes > 0)
    reach = log(REGISTERS) + 4
    while len(todo):
        limit[:] = 0
        limit[todo] = reach / sizes[todo]
        row = np.repeat(todo, sizes[todo])
        at = np.concatenate([np.arange(bounds[r], bounds[r + 1]) for r in todo]) if len(todo) < n else np.arange(len(keys))
        state = bt.mix64((keys[at] & bt.HASH_MASK) ^ _SEED)
        point = np.zeros(len(row))
        flat = least.reshape(-1)
        while len(row):
            state = bt.mix64(state + bt.GOLDEN)
            point = point - np.log(_units(state)) / REGISTERS
            keep = point <= limit[row]
            row, state, point = row[keep], state[keep], point[keep]
            slot = (bt.mix64(state ^ bt.MIX_B) % bt.U64(REGISTERS)).astype(np.int64)
            np.minimum.at(flat, row * REGISTERS + slot, point)
        # a register without a point below the limit might have one above it
        todo = todo[~np.isfinite(least[todo]).all(axis=1)]
        reach *= 2
    out = np.zeros((n, REGISTERS), np.uint8)
    some = sizes > 0
    out[some] = np.clip(np.floor(1 - np.log(least[some] / RATE) / log(BASE)), 0, LEVELS)
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """(rows, BANDS) long keys; the band is part of the key."""
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * bt.GOLDEN
    for k in range(ROWS):
        key = bt.mix64(key + parts[:, :, k] + bt.U64(1))
    return key.view(np.int64)


def _slope(at: np.ndarray | float, more, less, same, u, v) -> np.ndarray:
    """Derivative in the similarity of the joint log likelihood of register comparisons."""
    c = (BASE - 1) / BASE
    p = lambda x: -np.log1p(-x * c) / log(BASE)
    dp = lambda x: c / ((1 - x * c) * log(BASE))
    # the similarity is at most the ratio of the sizes
    x, y = np.maximum(u - v * at, 1e-9), np.maximum(v - u * at, 1e-9)
    px, py = p(x), p(y)
    rest = np.maximum(1 - px - py, 1e-12)
    return -more * v * dp(x) / px - less * u * dp(y) / py + same * (v * dp(x) + u * dp(y)) / rest


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of register rows ``a`` and ``b`` of sets of known sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = REGISTERS - more - less
    u = na / (na + nb)
    v = 1 - u
    low, high = np.zeros(len(a)), np.minimum(u / v, v / u)
    for _ in range(30):
        mid = (low + high) / 2
        rising = _slope(mid, more, less, same, u, v) > 0
        low, high = np.where(rising, mid, low), np.where(rising, high, mid)
    return (low + high) / 2


def plausible(a, b, na, nb, link: int = LINK) -> np.ndarray:
    """Whether the likelihood still rises ``DOUBT`` below the link; the sizes alone must allow a link."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    u = na / (na + nb)
    fits = 100 * np.minimum(na, nb) >= link * np.maximum(na, nb)
    return fits & (_slope(link / 100 - DOUBT, more, less, REGISTERS - more - less, u, 1 - u) > 0)


def _sketch(batches):
    for batch in bt.bounded(batches):
        keys, bounds = bt.shingle_sets(batch.column("text"))
        sizes = np.diff(bounds)
        regs = registers(keys, bounds)
        plain = keys & bt.HASH_MASK
        prints = []
        for seed in _PRINT_SEEDS:
            mixed = np.concatenate([bt.mix64(plain ^ seed), [bt.U64(0)]])
            sums = np.add.reduceat(mixed, bounds[:-1]) if len(sizes) else np.zeros(0, np.uint64)
            prints.append(np.where(sizes > 0, sums, bt.U64(0)).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes), pa.array(prints[0]), pa.array(prints[1]), _binary(regs)],
            ["doc_id", "n", "p1", "p2", "regs"],
        )


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _matrix(column: pa.Array, width: int, kind=np.uint8) -> np.ndarray:
    """Rows of a binary column without nulls, all of one width."""
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int32)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if len(column) else np.zeros(0, np.uint8)
    return body.view(kind).reshape(len(column), width)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n, p1, p2, regs) for every row: set size, fingerprint of the whole set, registers."""
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_sketch, "doc_id long, n long, p1 long, p2 long, regs binary")


def _keys(batches):
    for batch in batches:
        keys = band_keys(_matrix(batch.column("regs"), REGISTERS))
        rep = np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(rep), pa.array(keys.reshape(-1))], ["rep", "key"])


def _list_parts(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Sizes of the lists of a column, and all their structs in order."""
    return np.diff(column.offsets.to_numpy()), column.flatten()


#: Pairs weighed at once.
_PAIRS = 200_000


def _weigher(link: int):
    def run(batches):
        for batch in batches:
            sizes, members = _list_parts(batch.column("members"))
            keys, crossed = batch.column("grp").to_numpy(), batch.column("crossed").to_numpy(zero_copy_only=False)
            rep, part, side = (members.field(c).to_numpy(zero_copy_only=False) for c in ("rep", "part", "side"))
            n = members.field("n").to_numpy(zero_copy_only=False).astype(np.float64)
            regs = _matrix(members.field("regs"), REGISTERS)
            bands = band_keys(regs)
            left, right = [], []
            ends = np.cumsum(sizes)
            first = 0
            while first < len(sizes):
                # whole groups up to so many pairs; a larger group alone is two blocks at most
                weight = np.cumsum(sizes[first:] * (sizes[first:] - 1) // 2)
                last = first + max(1, int(np.searchsorted(weight, _PAIRS, side="right")))
                i, j, g = bt.pairs_within(sizes[first:last])
                base = ends[first] - sizes[first]
                i, j, g = i + base, j + base, g + first
                for at in range(0, len(i), _PAIRS):
                    a, b, own = i[at : at + _PAIRS], j[at : at + _PAIRS], g[at : at + _PAIRS]
                    use = (part[a] != part[b]) & (~crossed[own] | (side[a] != side[b]))
                    a, b, own = a[use], b[use], own[use]
                    shared = bands[a] == bands[b]
                    use = bands[a, shared.argmax(1)] == keys[own]
                    a, b = a[use], b[use]
                    if len(a):
                        use = plausible(regs[a], regs[b], n[a], n[b], link)
                        left.append(a[use])
                        right.append(b[use])
                first = last
            yield _edges(rep, left, right)

    return run


def _edges(rep: np.ndarray, left: list, right: list) -> pa.RecordBatch:
    """The spanning forest of index pairs as an Arrow batch of (u, v)."""
    names, index = np.unique(rep, return_inverse=True)
    i = index[np.concatenate(left)] if left else np.zeros(0, np.int64)
    j = index[np.concatenate(right)] if right else np.zeros(0, np.int64)
    label = bt.forest(len(names), i, j)
    moved = np.flatnonzero(label != np.arange(len(names)))
    return pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[label[moved]])], ["u", "v"])


def _comparer(link: int):
    def run(batches):
        for batch in batches:
            crossed = batch.column("crossed").to_pylist()
            for k in range(batch.num_rows):
                members = batch.column("members").slice(k, 1).flatten()
                ids, part, side = (members.field(c).to_numpy(zero_copy_only=False) for c in ("rep", "part", "side"))
                yield _linked(ids, members.field("text"), part, side if crossed[k] else None, link)

    return run


def _linked(ids: np.ndarray, texts: pa.Array, part: np.ndarray, side: np.ndarray | None, link: int) -> pa.RecordBatch:
    """Links among whole texts of different parts (and sides, if given), as a spanning forest."""
    owner, hashes = [], []
    for at in range(0, len(ids), bt.MOST_ROWS):
        keys, _ = bt.shingle_sets(texts.slice(at, bt.MOST_ROWS))
        owner.append((keys >> bt.U64(bt.HASH_BITS)).astype(np.int64) + at)
        hashes.append(keys & bt.HASH_MASK)
    owner, hashes = np.concatenate(owner), np.concatenate(hashes)
    n = len(ids)
    sizes = np.bincount(owner, minlength=n)
    _, code, seen = np.unique(hashes, return_inverse=True, return_counts=True)
    shared = seen[code] > 1
    owner, code = owner[shared], code[shared]
    common = np.zeros((n, n), np.float32)
    if len(code):
        _, code = np.unique(code, return_inverse=True)
        order = np.argsort(code, kind="stable")
        owner, code = owner[order], code[order]
        # in runs of columns, so that the dense part stays small
        width = max(256, 8_000_000 // max(n, 1))
        for low in range(0, int(code[-1]) + 1, width):
            a, b = np.searchsorted(code, [low, low + width])
            dense = np.zeros((n, min(width, int(code[-1]) + 1 - low)), np.float32)
            dense[owner[a:b], code[a:b] - low] = 1
            common += dense @ dense.T
    both = common.astype(np.int64)
    linked = np.triu((100 * both >= link * (sizes[:, None] + sizes[None, :] - both)) & (both > 0), 1)
    linked &= part[:, None] != part[None, :]
    if side is not None:
        linked &= side[:, None] != side[None, :]
    i, j = np.nonzero(linked)
    return _edges(ids, [i], [j])


def near_duplicates(docs: DataFrame, link: int = LINK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    own = settle(sketches(docs))
    classes = settle(
        own.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
        .groupBy("n", "p1", "p2")
        .agg(F.min("doc_id").alias("rep"), F.min("regs").alias("regs"))
    )
    keys = classes.select("rep", "regs").mapInArrow(_keys, "rep long, key long")
    keys = keys.select(F.col("key").alias("grp"), "rep", F.lit(1.0 / BLOCK).alias("w"))
    groups = settle(connected(keys, classes.select("rep", "n", "regs"), _weigher(link)))

    fills = F.greatest(F.col("n") / SET_BLOCK, F.lit(1.0 / MEMBER_BLOCK))
    sized = groups.join(classes.select("rep", "n"), F.col("node") == F.col("rep")).select(F.col("root").alias("grp"), "rep", fills.alias("w"))
    # rows that share a doc_id are one document; equal sets have one representative
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), "text")
    links = connected(sized, texts, _comparer(link))

    named = classes.select(F.col("n").alias("cn"), F.col("p1").alias("c1"), F.col("p2").alias("c2"), "rep")
    named = named.join(links, F.col("rep") == F.col("node"), "left").select("cn", "c1", "c2", F.coalesce("root", "rep").alias("found"))
    out = own.join(named, (F.col("n") == F.col("cn")) & (F.col("p1") == F.col("c1")) & (F.col("p2") == F.col("c2")), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"),
    )


def deduplicate(docs: DataFrame, link: int = STAGE_LINK) -> DataFrame:
    """The rows of ``docs`` that are the first of their group; rows that repeat a doc_id keep one.

    Groups link sets with ``100 * intersection >= link * union``. Rows with a null doc_id link with nothing and
    stay. Columns pass through, whatever their names and types.
    """
    names = docs.columns
    kept = near_duplicates(docs, link).where(F.col("kept")).select(F.col("doc_id").alias("kept_id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)]).alias("row"))
    known = rows.where(F.col("own_id").isNotNull()).join(kept, F.col("own_id") == F.col("kept_id"), "left_semi")
    repeated = rows.where(F.col("own_id").isNotNull()).groupBy("own_id").count().where(F.col("count") > 1)
    if not repeated.isEmpty():
        once = Window.partitionBy("own_id").orderBy(F.md5(F.to_json("row")))
        known = known.withColumn("nth", F.row_number().over(once)).where(F.col("nth") == 1).drop("nth")
    out = known.unionByName(rows.where(F.col("own_id").isNull()))
    return out.select(*[F.col(f"row.c{k}").alias(c) for k, c in enumerate(names)])


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS t FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(t) = 0 THEN [] WHEN len(t) < 5 THEN [md5(array_to_string(t, ' '))]
    ELSE list_transform(range(1, len(t) - 3), lambda i: md5(array_to_string(t[i:i+4], ' '))) END)) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.root) AS component_id, d.doc_id = min(r.root) AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.node = d.doc_id GROUP BY d.doc_id, n.n
"""
