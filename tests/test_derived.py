"""The landing of the derived inputs: same rows as their SQL, work that is cut by size."""

import os

import pytest

import derived_inputs
from derived_inputs import INPUT_SQL, derive, landed
from tests.helpers import plan, rows

SF_DIR = "/root/testdata/sf0.001"
MANY_GROUPS = ("income", "balance", "cashflow", "part_prices")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.mark.parametrize("name", sorted(INPUT_SQL))
def test_derivations_equal_their_sql(spark, name):
    tables = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("orders", "lineitem", "part", "customer")}
    used = {t: df for t, df in tables.items() if "{" + t + "}" in INPUT_SQL[name]}
    got = derive(spark, SF_DIR, name)
    expected = spark.sql(INPUT_SQL[name], **used)
    assert got.dtypes == expected.dtypes
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("name", MANY_GROUPS)
def test_rows_are_moved_and_not_partial_sums(spark, name):
    """Nothing is summed up before the rows of a key are together."""
    below = plan(derive(spark, SF_DIR, name)).split("Exchange", 1)[1]
    assert "Aggregate" not in below


def test_a_landing_has_tasks_by_its_rows(spark, monkeypatch):
    """Its tasks get no larger where the session has few shuffle partitions."""
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
    before = {k: spark.conf.get(k) for k in (*keys, "spark.sql.adaptive.coalescePartitions.enabled")}
    monkeypatch.setattr(derived_inputs, "_landed", {})
    monkeypatch.setattr(derived_inputs, "_TASK_ROWS", 500)
    spark.conf.set(keys[0], "2")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held = {k: spark.conf.get(k) for k in keys}
        files = {n: len(landed(spark, SF_DIR, n).inputFiles()) for n in ("income", "balance", "merged")}
        assert held == {k: spark.conf.get(k) for k in keys}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    # 1,500 orders, 7,500 orders and line items, and about 3,000 statements.
    assert all(n > 2 for n in files.values()) and files["balance"] > 8


def test_a_landing_reads_in_small_parts(spark):
    """A task that deals out all rows of a default part of a well compressed file holds too many."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    with derived_inputs._sized(spark, 1):
        assert spark.conf.get(key) == "16m"
    assert spark.conf.get(key) == before != "16m"
