"""k-means, hierarchies and hierarchical sampling against models in memory."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwell.operators import hierarchy, kmeans, sampling
from siftwell.sources.arrays import mixture, read_npy, reindexed, rings, subset, truncated_normal


def _points(spark, x):
    return spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "point_id long, embedding array<double>").repartition(3)


def test_assignment_and_centroids(spark):
    rng = np.random.default_rng(0)
    x, c = rng.normal(size=(60, 4)), rng.normal(size=(5, 4))
    near = kmeans.assign_nearest(_points(spark, x), c)
    got = {r["point_id"]: (r["cluster_id"], r["dist"]) for r in near.collect()}
    d = ((x[:, None] - c[None]) ** 2).sum(-1)
    assert [got[i][0] for i in range(60)] == d.argmin(1).tolist()
    assert np.allclose([got[i][1] for i in range(60)], d.min(1))
    moved, sizes = kmeans.centroids(near, np.vstack([c, np.full(4, 9.0)]))
    labels = d.argmin(1)
    for k in range(5):
        assert np.allclose(moved[k], x[labels == k].mean(0) if (labels == k).any() else c[k])
    assert (moved[5] == 9).all() and sizes.sum() == 60
    spread = sum(((x[labels == k] - x[labels == k].mean(0)) ** 2).sum() for k in range(5) if (labels == k).any())
    assert abs(kmeans.potential(near) - spread) < 1e-9


def test_blocks_of_centroids_agree(spark, monkeypatch):
    x = np.random.default_rng(1).normal(size=(40, 3))
    p = _points(spark, x)
    one = sorted((r["point_id"], r["cluster_id"]) for r in kmeans.assign_nearest(p, x[:10]).collect())
    monkeypatch.setattr(kmeans, "BLOCK_BYTES", 3 * 8 * 3)
    assert one == sorted((r["point_id"], r["cluster_id"]) for r in kmeans.assign_nearest(p, x[:10]).collect())


def test_cosine_metric_differs_off_the_sphere(spark):
    p = _points(spark, np.array([[10.0, 1.0]]))
    c = np.array([[1.0, 0.0], [9.0, 9.0]])
    assert kmeans.assign_nearest(p, c, "cos").first()["cluster_id"] == 1
    with pytest.raises(ValueError):
        kmeans.assign_nearest(p, c, "manhattan")


@pytest.mark.parametrize("init", kmeans.INITS)
def test_kmeans_finds_separate_blobs(spark, init):
    p = mixture(spark, [(0.0, 0.0), (50.0, 0.0), (0.0, 50.0)], [40, 40, 40], seed=4)
    _, assigned, pot = kmeans.kmeans(p.select("point_id", "embedding"), 3, 10, init, num_init=3, seed=1)
    assert assigned.select("cluster_id").distinct().count() == 3
    assert pot < 2 * 120 * 2


def test_k_is_at_most_n(spark):
    centres, assigned, pot = kmeans.kmeans(_points(spark, np.arange(6.0).reshape(3, 2)), 10, 3, seed=0)
    assert len(centres) == 3 and pot == 0 and assigned.count() == 3
    with pytest.raises(ValueError):
        kmeans.kmeans(_points(spark, np.zeros((1, 2))), 1, 1, init="magic")


def test_members(spark):
    p = spark.createDataFrame([(i, [0.0], i % 2, float(9 - i)) for i in range(10)], "point_id long, embedding array<double>, cluster_id long, dist double")
    assert {r["point_id"] for r in kmeans.closest_members(p, 2).collect()} == {6, 7, 8, 9}
    assert kmeans.random_members(p, 3, 1).count() == 6
    lists = {r["cluster_id"]: r["members"] for r in kmeans.cluster_lists(p, 3).collect()}
    assert lists == {0: [0, 2, 4, 6, 8], 1: [1, 3, 5, 7, 9], 2: []}


def test_split_keeps_parents_apart(spark):
    x = np.concatenate([np.random.default_rng(k).normal(k * 20, 1, (10, 2)) for k in range(3)])
    near = kmeans.assign_nearest(_points(spark, x), np.array([[0.0, 0], [20, 20], [40, 40]]))
    rows = kmeans.split_clusters(near, 4, 5, 2).collect()
    assert len(rows) == 30 and len({r["cluster_id"] for r in rows}) == 12
    assert all(len({r["parent_id"] for r in rows if r["cluster_id"] == c}) == 1 for c in range(12))


def test_power_centroid_lies_between_the_ends(spark):
    x = np.array([0.0, 0.1, 0.2, 5.0])
    c = kmeans.power_centroid(x, 4, 60)
    grid = np.linspace(0, 5, 5001)
    assert abs(c - grid[((grid[:, None] - x) ** 8).sum(1).argmin()]) < 0.01
    values = truncated_normal(spark, 300, 0.0, 1.0, -2, 2, 3)
    centres, out = kmeans.power_kmeans(values, 4, 2, 5)
    assert len(centres) == 4 and out.count() == values.count()


def _water(caps, target):
    """Brute force: the largest level, then the remainder."""
    if sum(caps) <= target:
        return sorted(caps)
    x = max(x for x in range(max(caps) + 1) if sum(min(x, c) for c in caps) <= target)
    given = [min(x, c) for c in caps]
    rest = target - sum(given)
    for k, c in enumerate(caps):
        if rest and c > x:
            given[k], rest = x + 1, rest - 1
    return sorted(given)


def test_water_fill_equals_brute_force(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for g in range(40):
        caps, target = [rng.randint(0, 12) for _ in range(rng.randint(1, 8))], rng.randint(0, 50)
        rows += [(g, k, c, target) for k, c in enumerate(caps)]
        want[g] = _water(caps, target)
    df = spark.createDataFrame(rows, "g int, child int, capacity long, target long")
    got = sampling.water_fill(df, ["g"], "capacity", "target", "child", [F.col("child")]).collect()
    for g, w in want.items():
        assert sorted(r["share"] for r in got if r["g"] == g) == w


@pytest.mark.parametrize("strategy", sampling.STRATEGIES)
@pytest.mark.parametrize(("target", "multiplier"), [(0, 1), (7, 1), (40, 1), (60, 1), (90, 2), (500, 2)])
def test_sample_meets_the_budget(spark, strategy, target, multiplier):
    edges = [(1, c, 100 * c + k, k + 1) for c in range(5) for k in range((c + 1) * 4)]
    edges += [(2, c // 3, c, c % 3 + 1) for c in range(5)]
    df = spark.createDataFrame(edges, "level int, cluster_id long, child_id long, rank int")
    got = sampling.hierarchical_sample(df, 2, target, multiplier, strategy, 3).collect()
    assert sum(r["copies"] for r in got) == min(target, 60 * multiplier)
    assert all(r["copies"] <= multiplier for r in got)


def test_bad_arguments(spark):
    df = spark.createDataFrame([(1, 0, 0, 1)], "level int, cluster_id long, child_id long, rank int")
    with pytest.raises(ValueError):
        sampling.hierarchical_sample(df, 1, 1, 1, "x")
    with pytest.raises(ValueError):
        sampling.hierarchical_sample(df, 1, -1)
    with pytest.raises(ValueError):
        hierarchy.hierarchical_kmeans(df, [], strategy="x")


def test_hierarchy_is_written_and_read(spark, tmp_path):
    edges, centres = hierarchy.hierarchical_kmeans(rings(spark, [60, 40]), [hierarchy.Level(8, 2), hierarchy.Level(2)], 3, "random", resamples=1)
    assert [len(c) for c in centres] == [8, 2]
    hierarchy.write_hierarchy(edges, str(tmp_path / "h"))
    again = hierarchy.read_hierarchy(spark, str(tmp_path / "h"))
    assert hierarchy.flatten(again, 2).where(F.col("level") == 2).count() == 100


def test_npy_subset_and_reindex(spark, tmp_path):
    x = np.arange(20, dtype=np.float32).reshape(10, 2)
    np.save(tmp_path / "x.npy", x)
    p = read_npy(spark, str(tmp_path / "x.npy"), 3)
    assert {r["point_id"]: r["embedding"] for r in p.collect()} == {i: x[i].tolist() for i in range(10)}
    ids = spark.createDataFrame([(0, 7), (1, 3)], "new_id long, point_id long")
    assert subset(p, ids.select("point_id")).count() == 2
    assert {r["point_id"]: r["embedding"][0] for r in reindexed(p, ids).collect()} == {0: 14.0, 1: 6.0}
    with pytest.raises(ValueError):
        reindexed(p, spark.createDataFrame([(0, 99)], "new_id long, point_id long"))


def test_stored_steps_are_not_run_again(spark, tmp_path, monkeypatch):
    p = rings(spark, [80, 40]).select("point_id", "embedding")
    levels = [hierarchy.Level(6, 3), hierarchy.Level(2)]
    first = hierarchy.stored_hierarchy(p, levels, str(tmp_path / "run"), 3, "random", resamples=2, seed=1)
    told = sorted(map(tuple, first.collect()))
    assert len(told) == 126 and len(list((tmp_path / "run/centroids/level=1").iterdir())) == 3
    monkeypatch.setattr(hierarchy, "kmeans", lambda *a, **b: pytest.fail("a stored step ran again"))
    assert told == sorted(map(tuple, hierarchy.stored_hierarchy(p, levels, str(tmp_path / "run"), 3, "random", resamples=2, seed=1).collect()))
