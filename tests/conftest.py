"""One local session for all tests."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers import the package too
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from siftwell.session import local_session

    session = local_session(8, "tests", spark__sql__shuffle__partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def rows_of(frame):
    """Rows as sorted tuples of texts, for comparing engines."""
    columns = sorted(frame.columns)

    def told(v):
        if v is None or (isinstance(v, float) and v != v):
            return "~"
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(told(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False))
