"""k-means over (point_id, embedding): assignment, centroids, seeding, Lloyd runs, ordering and splitting.

Points stay distributed. Centroids are bounded by k and go to the tasks in blocks of at most ``BLOCK_BYTES``.
Every choice is a hash or a hashed exponential of the point id and a seed, so runs repeat exactly.
"""

from __future__ import annotations

from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwell.tables import settle

#: Centroids sent to tasks at once.
BLOCK_BYTES = 256 << 20
#: Distances a task holds at once.
CHUNK = 4_000_000
#: Seeds drawn between two writings of the least distances.
REFRESH = 16
METRICS = ("l2", "cos")


def _check(metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}: choose l2 or cos")


def _rows(column: pa.Array) -> np.ndarray:
    """List rows of one length as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def distances(x: np.ndarray, centres: np.ndarray, metric: str) -> np.ndarray:
    """Squared distances by the expansion of the square, or 2 - 2xy for unit rows."""
    if metric == "cos":
        return 2 - 2 * (x @ centres.T)
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)[None, :], 0)


def _nearest(centres: np.ndarray, ids: np.ndarray, metric: str):
    def run(batches):
        for batch in batches:
            x = _rows(batch.column("embedding"))
            n = batch.num_rows
            best, least = np.zeros(n, np.int64), np.full(n, np.inf)
            step = max(1, CHUNK // max(len(centres), 1))
            for at in range(0, n, step):
                d = distances(x[at : at + step], centres, metric)
                k = d.argmin(axis=1)
                best[at : at + step], least[at : at + step] = ids[k], d[np.arange(len(k)), k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("point_id"), batch.column("embedding"), pa.array(best), pa.array(least)],
                ["point_id", "embedding", "cluster_id", "dist"],
            )

    return run


def assign_nearest(points: DataFrame, centres: np.ndarray, metric: str = "l2", ids: np.ndarray | None = None) -> DataFrame:
    """(point_id, embedding, cluster_id, dist): the nearest centroid of every point, the least id on ties."""
    _check(metric)
    centres = np.asarray(centres, np.float64)
    ids = np.arange(len(centres)) if ids is None else np.asarray(ids)
    order = np.argsort(ids, kind="stable")
    centres, ids = centres[order], ids[order]
    kind = dict(points.dtypes)["embedding"]
    idt = dict(points.dtypes)["point_id"]
    schema = f"point_id {idt}, embedding {kind}, cluster_id long, dist double"
    rows = points.select("point_id", "embedding")
    per = max(1, BLOCK_BYTES // max(1, centres.shape[1] * 8))
    found = [rows.mapInArrow(_nearest(centres[a : a + per], ids[a : a + per], metric), schema) for a in range(0, len(centres), per)]
    if len(found) == 1:
        return found[0]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = every.groupBy("point_id").agg(F.min_by(F.struct("embedding", "cluster_id", "dist"), F.struct("dist", "cluster_id")).alias("b"))
    return best.select("point_id", "b.*")


def mean_vectors(assigned: DataFrame, by: str = "cluster_id") -> DataFrame:
    """(cluster, place, value, n): the mean vector of every cluster, component by component, in the JVM."""
    parts = assigned.select(F.col(by), F.posexplode("embedding").alias("place", "x"))
    return parts.groupBy(by, "place").agg(F.avg(F.col("x").cast("double")).alias("value"), F.count(F.lit(1)).alias("n"))


def _partial(batches):
    sums, counts, width = {}, {}, 0
    for batch in batches:
        x = _rows(batch.column("embedding"))
        labels = batch.column("cluster_id").to_numpy()
        names, index = np.unique(labels, return_inverse=True)
        if not len(names):
            continue
        order = np.argsort(index, kind="stable")
        heads = np.searchsorted(index[order], np.arange(len(names)))
        totals = np.add.reduceat(x[order], heads, axis=0)
        for k, name in enumerate(names):
            sums[name] = sums.get(name, 0) + totals[k]
            counts[name] = counts.get(name, 0) + int((index == k).sum()) if len(names) < 64 else counts.get(name, 0) + int(np.diff(np.append(heads, len(order)))[k])
        width = x.shape[1]
    names = sorted(sums)
    flat = np.concatenate([sums[n] for n in names]) if names else np.zeros(0)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.array(names, np.int64), width)),
            pa.array(np.tile(np.arange(width, dtype=np.int32), len(names))),
            pa.array(flat),
            pa.array(np.repeat(np.array([counts[n] for n in names], np.int64), width)),
        ],
        ["cluster_id", "place", "total", "n"],
    )


def centroids(assigned: DataFrame, previous: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, sizes): means of the clusters 0..k-1; an empty cluster keeps its previous centroid.

    Tasks sum their own points; one array a cluster reaches the driver.
    """
    parts = assigned.select("cluster_id", "embedding").mapInArrow(_partial, "cluster_id long, place int, total double, n long")
    sums = parts.groupBy("cluster_id", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    sums = sums.groupBy("cluster_id").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", "total")))["total"].alias("total"))
    rows = sums.toArrow()
    out, sizes = np.array(previous, np.float64), np.zeros(len(previous), np.int64)
    if rows.num_rows:
        c, n = rows.column("cluster_id").to_numpy(), rows.column("n").to_numpy()
        out[c] = _rows(rows.column("total").combine_chunks()) / n[:, None]
        sizes[c] = n
    return out, sizes


def potential(assigned: DataFrame) -> float:
    """Sum of squared distances of points to the mean of their cluster."""
    parts = assigned.select("cluster_id", F.posexplode("embedding").alias("place", "x"))
    spread = parts.groupBy("cluster_id", "place").agg((F.var_pop(F.col("x").cast("double")) * F.count(F.lit(1))).alias("s"))
    return float(spread.agg(F.coalesce(F.sum("s"), F.lit(0.0))).first()[0])


def unit_hash(seed: int, *cols: str) -> Column:
    """A repeatable number in (0, 1) from columns and a seed."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *[F.col(c) for c in cols]), 11).cast("double") + 0.5) * F.lit(2.0**-53)


def seeded(seed: int, *cols: str) -> Column:
    """A repeatable sort key from columns and a seed that any SQL engine can tell, too."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def _vectors(rows: list) -> np.ndarray:
    return np.array([r["embedding"] for r in rows], np.float64)


def random_init(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """``k`` points, the first in a seeded order."""
    return _vectors(points.orderBy(unit_hash(seed, "point_id"), "point_id").limit(k).collect())


def _closer(base: DataFrame, centres: np.ndarray, metric: str) -> DataFrame:
    """``base`` (point_id, embedding, dist) with distances lowered to those of more centres."""
    if not len(centres):
        return base

    def run(batches):
        for batch in batches:
            d = distances(_rows(batch.column("embedding")), centres, metric).min(axis=1)
            least = np.minimum(d, batch.column("dist").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("point_id"), batch.column("embedding"), pa.array(least)], ["point_id", "embedding", "dist"])

    return base.mapInArrow(run, base.schema)


class Kept:
    """Centres of a run, kept in a folder that outlives the driver, so a run that broke goes on where it was.

    Without a folder nothing is kept. Every step is a table of its own; the last whole one counts.
    """

    def __init__(self, spark, folder: str | None) -> None:
        self.spark, self.folder = spark, folder

    def read(self, kind: str) -> tuple[int, np.ndarray, list] | None:
        """(step, centres, point ids) of the last step kept."""
        if self.folder is None:
            return None
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        place = hadoop.Path(f"{self.folder}/{kind}-*/_SUCCESS")
        found = place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
        paths = sorted(str(f.getPath().getParent()) for f in found or [])
        if not paths:
            return None
        rows = self.spark.read.parquet(paths[-1]).orderBy("place").collect()
        return int(paths[-1].rpartition("-")[2]), _vectors(rows), [r["point_id"] for r in rows]

    def write(self, kind: str, step: int, centres: np.ndarray, ids: list | None = None) -> None:
        """Keep the centres of a step."""
        if self.folder is not None:
            rows = [(i, None if ids is None else ids[i], [float(v) for v in c]) for i, c in enumerate(centres)]
            kind_of_id = "string" if ids and isinstance(ids[0], str) else "long"
            table = self.spark.createDataFrame(rows, f"place int, point_id {kind_of_id}, embedding array<double>")
            table.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{kind}-{step:08d}")


def plusplus_init(points: DataFrame, k: int, seed: int, metric: str = "l2", kept: Kept | None = None) -> tuple[np.ndarray, list]:
    """Greedy k-means++: each step draws 2 + floor(ln k) candidates by distance and keeps the best.

    Candidates are the points with the least exponential key -ln(u) / distance: a weighted draw without a
    running sum. Each step is a pass over the points with their least distance so far, which is written anew every
    ``REFRESH`` steps, so a step costs as much late as early. ``kept`` remembers the centres at those steps.
    """
    _check(metric)
    kept = kept or Kept(points.sparkSession, None)
    known = kept.read("seeds")
    if known is None:
        first = points.orderBy(unit_hash(seed, "point_id"), "point_id").limit(1).collect()
        centres, ids = [_vectors(first)[0]], [first[0]["point_id"]]
    else:
        centres, ids = list(known[1]), known[2]
    trials = 2 + int(log(k)) if k > 1 else 1
    base, done = points.select("point_id", "embedding", F.lit(float("inf")).alias("dist")), 0
    for step in range(len(centres), k):
        near = _closer(base, np.array(centres[done:]), metric)
        if len(centres) - done >= REFRESH:
            base = near = settle(near, instead_of=base if done else None)
            done = len(centres)
            kept.write("seeds", step, np.array(centres), ids)
        key = -F.log(unit_hash(seed + step, "point_id")) / F.col("dist")
        drawn = near.where(F.col("dist") > 0).orderBy(key, "point_id").limit(trials).collect()
        if not drawn:  # fewer distinct points than clusters
            spare = points.orderBy(unit_hash(seed + step, "point_id"), "point_id").limit(1).collect()
            centres.append(_vectors(spare)[0])
            ids.append(spare[0]["point_id"])
            continue
        options = _vectors(drawn)
        sums = near.select("embedding", "dist").mapInArrow(_gains(options, metric), "trial int, total double").groupBy("trial").agg(F.sum("total").alias("total")).collect()
        totals = {r["trial"]: r["total"] for r in sums}
        best = min(range(len(drawn)), key=lambda t: (totals[t], t))
        centres.append(options[best])
        ids.append(drawn[best]["point_id"])
    return np.array(centres), ids


def _gains(options: np.ndarray, metric: str):
    def run(batches):
        total = np.zeros(len(options))
        for batch in batches:
            d = distances(_rows(batch.column("embedding")), options, metric)
            total += np.minimum(d, batch.column("dist").to_numpy()[:, None]).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(options), dtype=np.int32)), pa.array(total)], ["trial", "total"])

    return run


def parallel_init(points: DataFrame, k: int, seed: int, rounds: int = 5) -> np.ndarray:
    """k-means||: a few passes each draw points by distance; the weighted draws are reduced locally.

    A pass draws every point for itself, 2k of them on average, and all that are drawn count.
    """
    drawn = random_init(points, 1, seed)
    for r in range(rounds):
        near = assign_nearest(points, drawn)
        total = near.agg(F.sum("dist")).first()[0] or 0.0
        if total <= 0:
            break
        lucky = near.where(unit_hash(seed + 101 + r, "point_id") < F.lit(2.0 * k / total) * F.col("dist")).orderBy("point_id").collect()
        if lucky:
            drawn = np.concatenate([drawn, _vectors(lucky)])
    if len(drawn) <= k:
        return np.concatenate([drawn, random_init(points, k, seed + 7)])[:k]
    weights = np.zeros(len(drawn))
    for r in assign_nearest(points, drawn).groupBy("cluster_id").count().collect():
        weights[r["cluster_id"]] = r["count"]
    return local_kmeans(drawn, k, 10, seed, weights)[0]


def local_kmeans(x: np.ndarray, k: int, iterations: int, seed: int, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """(centroids, labels, potential) of weighted points in memory, k-means++ seeded."""
    rng = np.random.default_rng(seed)
    w = np.ones(len(x)) if weights is None else np.maximum(weights, 1e-12)
    k = min(k, len(x))
    centres = x[[rng.choice(len(x), p=w / w.sum())]]
    closest = distances(x, centres, "l2")[:, 0]
    while len(centres) < k:
        mass = closest * w
        picks = rng.choice(len(x), size=2 + int(log(k)), p=mass / mass.sum() if mass.sum() > 0 else None)
        d = np.minimum(closest[:, None], distances(x, x[picks], "l2"))
        best = (d * w[:, None]).sum(axis=0).argmin()
        centres, closest = np.concatenate([centres, x[[picks[best]]]]), d[:, best]
    for _ in range(iterations):
        labels = distances(x, centres, "l2").argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, labels, x * w[:, None])
        mass = np.bincount(labels, weights=w, minlength=k)
        centres = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], centres)
    labels = distances(x, centres, "l2").argmin(axis=1)
    means = np.array([x[labels == c].mean(axis=0) if (labels == c).any() else centres[c] for c in range(k)])
    return centres, labels, float(((x - means[labels]) ** 2).sum())


INITS = ("kmeans++", "kmeans||", "random")


def kmeans(
    points: DataFrame, k: int, iterations: int = 50, init: str = "kmeans++", num_init: int = 1, metric: str = "l2", seed: int = 0, keep: str | None = None
) -> tuple[np.ndarray, DataFrame, float]:
    """(centroids, assigned points, potential), the best of ``num_init`` runs; k is at most the number of points.

    ``keep`` names a folder for the centres of every ``REFRESH``-th seed and of every round; a call with the same
    points, options and folder goes on from there.
    """
    _check(metric)
    if init not in INITS:
        raise ValueError(f"unknown init {init!r}: choose one of {INITS}")
    points = settle(points.select("point_id", "embedding"))
    n = points.count()
    if not n:
        raise ValueError("no points")
    k = min(k, n)
    best = None
    for run in range(num_init):
        s = seed + 7919 * run
        kept = Kept(points.sparkSession, keep and f"{keep}/run-{run}")
        known = kept.read("round")
        if known is not None:
            centres = known[1]
        elif init == "kmeans++":
            centres = plusplus_init(points, k, s, metric, kept)[0]
        else:
            centres = parallel_init(points, k, s) if init == "kmeans||" else random_init(points, k, s)
        for step in range(known[0] if known else 0, iterations):
            moved, _ = centroids(assign_nearest(points, centres, metric), centres)
            still = np.array_equal(moved, centres)
            centres = moved
            kept.write("round", step + 1, centres)
            if still:  # a fixed point: further rounds would change nothing
                break
        assigned = assign_nearest(points, centres, metric)
        pot = potential(assigned)
        if best is None or pot < best[2]:
            best = (centres, assigned, pot)
    return best


def sort_members(assigned: DataFrame) -> DataFrame:
    """``assigned`` with ``rank``: members of a cluster by distance to its centroid, then by id."""
    return assigned.withColumn("rank", F.row_number().over(Window.partitionBy("cluster_id").orderBy("dist", "point_id")))


def closest_members(assigned: DataFrame, n: int) -> DataFrame:
    """The ``n`` members of every cluster nearest to its centroid."""
    return sort_members(assigned).where(F.col("rank") <= n)


def random_members(assigned: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """``n`` members of every cluster, the first in a seeded order."""
    order = Window.partitionBy("cluster_id").orderBy(seeded(seed, "point_id"), "point_id")
    return assigned.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def cluster_lists(assigned: DataFrame, k: int) -> DataFrame:
    """(cluster_id, members) for every cluster 0..k-1, empty ones included; members in order of id."""
    found = assigned.groupBy(F.col("cluster_id").alias("c")).agg(F.sort_array(F.collect_list("point_id")).alias("m"))
    every = assigned.sparkSession.range(k).select(F.col("id").alias("cluster_id"))
    kind = dict(assigned.dtypes)["point_id"]
    return every.join(found, F.col("cluster_id") == F.col("c"), "left").select(
        "cluster_id", F.coalesce("m", F.expr(f"cast(array() as array<{kind}>)")).alias("members")
    )


def split_clusters(assigned: DataFrame, splits: int, iterations: int = 50, num_init: int = 10, seed: int = 0) -> DataFrame:
    """Every cluster clustered again into at most ``splits`` parts: (parent_id, cluster_id, rank, point_id, dist).

    One cluster is one task's work, as splitting is meant for clusters that fit one; new ids count parents and
    parts in order, without gaps.
    """
    import pandas as pd

    kind = dict(assigned.dtypes)["point_id"]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("point_id").reset_index(drop=True)
        x = np.stack(group["embedding"].to_numpy()).astype(np.float64)
        runs = [local_kmeans(x, splits, iterations, seed + r) for r in range(num_init)]
        centres, labels, _ = min(runs, key=lambda r: r[2])
        d = ((x - centres[labels]) ** 2).sum(axis=1)
        return pd.DataFrame({"parent_id": group["cluster_id"], "part": labels, "point_id": group["point_id"], "dist": d})

    parts = assigned.select("cluster_id", "point_id", "embedding").groupBy("cluster_id").applyInPandas(run, f"parent_id long, part long, point_id {kind}, dist double")
    parts = settle(parts)
    names = parts.select("parent_id", "part").distinct()
    ids = names.withColumn("cluster_id", (F.row_number().over(Window.orderBy("parent_id", "part")) - 1).cast("long"))
    ids = ids.select(F.col("parent_id").alias("np"), F.col("part").alias("nq"), "cluster_id")
    full = parts.join(ids, (F.col("parent_id") == F.col("np")) & (F.col("part") == F.col("nq"))).select("parent_id", "cluster_id", "point_id", "dist")
    return sort_members(full).select("parent_id", "cluster_id", "rank", "point_id", "dist")


def power_centroid(x: np.ndarray, n: int, steps: int = 5) -> float:
    """The point with the least sum of distances to the power 2n, by Newton steps from the mean."""
    c = float(x.mean())
    for _ in range(steps if len(x) > 1 else 0):
        gap = c - x
        slope = (2 * n * gap ** (2 * n - 1)).sum()
        curve = (2 * n * (2 * n - 1) * gap ** (2 * n - 2)).sum()
        if slope == 0 or curve == 0:
            break
        c -= slope / curve
    return c


def power_kmeans(values: DataFrame, k: int, n: int, iterations: int = 50, seed: int = 0) -> tuple[np.ndarray, DataFrame]:
    """One-dimensional k-means under distance to the power 2n: (centres, (point_id, value, cluster_id)).

    Newton steps need only power sums about the current centre, so a cluster is never gathered: each step is
    one aggregate over all clusters. An empty cluster gets 0.
    """
    points = settle(values.select("point_id", F.array(F.col("value").cast("double")).alias("embedding")))
    k = min(k, points.count())
    centres = plusplus_init(points, k, seed)[0][:, 0]
    for _ in range(iterations):
        near = settle(assign_nearest(points, centres[:, None]).select("cluster_id", F.col("embedding")[0].alias("x")))
        means = {r["cluster_id"]: r["m"] for r in near.groupBy("cluster_id").agg(F.avg("x").alias("m")).collect()}
        moved = np.array([means.get(c, 0.0) for c in range(k)])
        for _ in range(5 if n > 1 else 0):
            at = F.element_at(F.array(*[F.lit(float(c)) for c in moved]), (F.col("cluster_id") + 1).cast("int"))
            sums = near.groupBy("cluster_id").agg(
                F.sum(2 * n * F.pow(at - F.col("x"), F.lit(2 * n - 1))).alias("slope"), F.sum(2 * n * (2 * n - 1) * F.pow(at - F.col("x"), F.lit(2 * n - 2))).alias("curve")
            )
            for r in sums.collect():
                if r["slope"] and r["curve"]:
                    moved[r["cluster_id"]] -= r["slope"] / r["curve"]
        if np.allclose(moved, centres, rtol=0, atol=0):
            break
        centres = moved
    out = assign_nearest(points, centres[:, None]).select("point_id", F.col("embedding")[0].alias("value"), "cluster_id")
    return centres, out
