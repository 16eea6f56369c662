"""Every registered query against its SQL, over the smallest given tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
import oracle_queries

SF_DIR = "/root/testdata/sf0.001"
ORACLES = oracle_queries.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        if name.endswith(".parquet"):
            table = name.removesuffix(".parquet")
            connection.execute(f"create view {table} as select * from '{SF_DIR}/{name}'")
    yield connection
    connection.close()


def _comparable(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if c in ("Date", "Report_Date"):
            frame[c] = pd.to_datetime(frame[c]).astype("datetime64[us]")
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def test_every_query_has_an_oracle():
    assert set(entry.library_queries()) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    got = entry.library_queries()[name](spark, SF_DIR).toPandas()
    expected = duck.execute(ORACLES[name]).df()
    assert len(got) > 0
    pd.testing.assert_frame_equal(
        _comparable(got), _comparable(expected), check_dtype=False, rtol=0, atol=0
    )


def test_entry(spark):
    assert entry.entry(spark).count() > 0
