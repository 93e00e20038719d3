"""Every registered library query with SQL equals DuckDB on the smallest tables; the others give rows."""

import pytest
from conftest import DATA

from siftwell.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, DATA).toArrow().to_pylist()
    want = duck.sql(catalog.ORACLES[name]).to_arrow_table().to_pylist()
    told = lambda rows: sorted(tuple("~" if r[k] is None else repr(float(r[k])) if isinstance(r[k], float) else str(r[k]) for k in sorted(r)) for r in rows)
    assert sorted(got[0] if got else []) == sorted(want[0] if want else [])
    assert told(got) == told(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, DATA).limit(1).count() == 1


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
