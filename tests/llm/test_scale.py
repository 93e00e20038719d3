"""Crowded groups, limits of batches, and settings that must not change a result."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftwell.llm import bytetext, components, minhash


def _closer(met=None):
    """Links members of different parts (and sides) whose values lie within 1; counts the rows that meet."""

    def run(batches):
        for batch in batches:
            u, v = [], []
            for group in batch.to_pylist():
                m = group["members"]
                if met is not None:
                    met.add(len(m))
                for i, a in enumerate(m):
                    for b in m[:i]:
                        if a["part"] != b["part"] and (not group["crossed"] or a["side"] != b["side"]) and abs(a["value"] - b["value"]) <= 1:
                            u.append(a["rep"])
                            v.append(b["rep"])
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return run


@pytest.mark.parametrize("spread", [1, 60, 4000])
def test_crowded_groups_are_connected(spark, spread):
    rng = random.Random(spread)
    values = [rng.randrange(max(spread, 1)) * 3 + rng.choice([0, 0, 1]) for _ in range(220)]
    members = spark.createDataFrame([(1 if i < 200 else 2, i, 1 / 6) for i in range(220)], "grp long, rep long, w double")
    payload = spark.createDataFrame(list(enumerate(values)), "rep long, value long")
    found = components.connected(members, payload, _closer())
    got = {r["node"]: r["root"] for r in found.collect()}
    want = {}
    for lo, hi in ((0, 200), (200, 220)):
        by_value = {}
        for i in range(lo, hi):
            by_value.setdefault(values[i] // 3, []).append(i)
        for ids in by_value.values():
            for i in ids:
                want[i] = min(ids)
    assert {i: got.get(i, i) for i in range(220)} == want


def test_pairs_of_connected_blocks_never_meet(spark):
    """A crowd of copies costs its members' rows, twice, a delegate a part, and what joins two odd members to it."""
    members = spark.createDataFrame([(1, i, 1 / 10) for i in range(400)], "grp long, rep long, w double")
    payload = spark.createDataFrame([(i, 0 if i > 1 else 50 * (i + 1)) for i in range(400)], "rep long, value long")
    met = spark.sparkContext.accumulator(0)

    components.connected(members, payload, _closer(met)).count()
    assert 400 < met.value < 400 * 4  # 400 * 40 if all pairs of blocks met


def test_large_sets_of_rows_are_refused():
    with pytest.raises(ValueError, match="at most 256"):
        bytetext.shingle_sets(pa.array(["a b c d e f"] * 300))
    batch = pa.RecordBatch.from_arrays([pa.array(["a b"] * 700)], ["text"])
    assert [b.num_rows for b in bytetext.bounded([batch])] == [256, 256, 188]


def test_near_duplicates_with_any_batch_size(spark):
    texts = [(i, f"a b c d e f {i // 3} h") for i in range(600)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: (4, i // 3 * 3) for i in range(600)}


def test_stage_keeps_clashing_columns(spark):
    rows = [(1, "a b", 1, {"x": 1}), (1, "a b", 2, {"x": 2}), (2, "A b", 3, None), (3, None, 4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id int, `a.b` map<string,int>").withColumns({"row": F.lit(1), "own_id": F.lit(2), "nth": F.lit(0)})
    kept = minhash.deduplicate(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


@pytest.mark.parametrize("edges_a_task", [7, 40, 10**6])
def test_components_beyond_one_task(spark, monkeypatch, edges_a_task):
    monkeypatch.setattr(components, "TASK_EDGES", edges_a_task)
    rng = random.Random(edges_a_task)
    edges = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] * 3 + [(100 + k, 101 + k) for k in range(70)]
    root = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(200):
        for u, v in edges:
            if u != v:
                root[u] = root[v] = min(root[u], root[v])
    got = components.components(spark.createDataFrame([*edges, (None, 1), (2, None), (500, 500)], "u long, v long")).collect()
    assert len(got) == len(root) and {r["node"]: r["root"] for r in got} == root


def test_hubs_and_chains(spark, monkeypatch):
    monkeypatch.setattr(components, "TASK_EDGES", 50)
    monkeypatch.setattr(components, "LEAST_HUB", 3)
    monkeypatch.setattr(components, "HUBS", 40)
    rng = np.random.default_rng(5)
    edges = [(0, int(k)) for k in rng.integers(1, 500, 300)] + [(k, k + 1) for k in range(600, 640)] + [(700, k) for k in range(600, 605)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: 0 if x < 500 else 600 for e in edges for x in e}
