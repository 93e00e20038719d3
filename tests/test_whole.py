"""Queries that once took a part of their table, over the whole of it."""

import numpy as np
import pytest
from conftest import DATA

from siftwell.plans import catalog


def test_backfill_takes_all_events(spark, duck):
    got = {r["event_id"] for r in catalog.QUERIES["nan_backfill"](spark, DATA).select("event_id").collect()}
    bins = duck.sql("SELECT event_type, (count(*) * 4) // 5 AS quota FROM events GROUP BY event_type").fetchall()
    assert len(got) == sum(quota for _, quota in bins)
    assert {i % 50 for i in got} == set(range(50))


def test_divergence_takes_all_events(spark, duck):
    x = np.array([v for (v,) in duck.sql("SELECT value / 100 FROM events").fetchall()])
    mass = np.exp(-(((np.arange(50)[:, None] + 0.5) / 50 - x) / 0.1) ** 2 / 2).sum(axis=1)
    p = mass / mass.sum()
    assert abs(catalog.QUERIES["kde_divergence"](spark, DATA).first()["divergence"] - (p * np.log(p * 50)).sum()) < 1e-5


def test_ring_sample_has_all_points(monkeypatch):
    class Asked(Exception):
        pass

    def rings(spark, sizes):
        raise Asked(sizes)

    monkeypatch.setattr(catalog, "rings", rings)
    with pytest.raises(Asked) as asked:
        catalog.QUERIES["ring_sample"](None, DATA)
    assert asked.value.args[0] == [20000, 200, 1000, 500, 8000]
