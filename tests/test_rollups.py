import os
import random

import pytest
from pyspark.sql import functions as F

import barloom
from barloom.plans import rollups
from barloom.sinks import lake
from tests.helpers import plan, rows, same

SCHEMA = (
    "Ticker string, Date string, Close double, Low double, High double, Volume_Millions double, "
    "Daily_Return double, Year long, Month long"
)


def _prices(spark, seed=3, size=900):
    rng = random.Random(seed)
    value = lambda: rng.choice([None, rng.randrange(1, 400) / 4])
    data = [
        (
            rng.choice([None, "A", "B", "C"]), "", value(), value(), value(), value(), value(),
            *rng.choice([(2020, 1), (2020, 2), (2021, 1), (2021, 7), (None, None)]),
        )
        for _ in range(size)
    ]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def _served(spark, df, path):
    return spark.read.parquet(lake.write_partitioned(df, str(path), ["Year", "Month"]))


def _files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_merged_states_equal_the_report(spark, tmp_path):
    prices = _prices(spark)
    path = rollups.refresh(rollups.MONTHLY, prices, str(tmp_path / "s"))
    got = barloom.report(spark, rollups.MONTHLY, path)
    expected = barloom.monthly_price_stats(prices)
    assert got.columns == expected.columns and got.dtypes == expected.dtypes
    assert same(rows(got), rows(expected))


@pytest.mark.parametrize("keys", [["Ticker"], ["Year"], ["Ticker", "Year"], []])
def test_states_merge_at_coarser_keys(spark, tmp_path, keys):
    prices = _prices(spark)
    path = rollups.refresh(rollups.MONTHLY, prices, str(tmp_path / "s"))
    measures = [F.expr(e).alias(name) for name, e in rollups.MONTHLY.measures.items()]
    expected = prices.groupBy(*keys).agg(*measures)
    assert same(rows(barloom.report(spark, rollups.MONTHLY, path, keys)), rows(expected))


def test_only_changed_partitions_are_read_and_written(spark, tmp_path):
    first = _served(spark, _prices(spark, 1), tmp_path / "a")
    path = rollups.refresh(rollups.MONTHLY, first, str(tmp_path / "s"))
    before = _files(path)
    new = _prices(spark, 2)
    changed = [(2021, 7), (None, None), (2022, 3)]
    kept = first.where("Year = 2020 or Month = 1")
    third = new.where("Month = 7 or Month is null")
    second = _served(spark, kept.unionByName(third), tmp_path / "b")
    text = plan(rollups.MONTHLY.states(second.where(rollups._named(("Year", "Month"), changed))))
    assert "PartitionFilters: [((((Year" in text and "DataFilters: []" in text
    rollups.refresh(rollups.MONTHLY, second, path, changed)
    after = _files(path)
    touched = {f for f in after if "Month=7" in f or "__HIVE" in f or "Year=2022" in f}
    assert after - touched == before & after and len(before & after) >= 3 and not touched & before
    assert same(rows(barloom.report(spark, rollups.MONTHLY, path)), rows(barloom.monthly_price_stats(second)))


def test_a_report_reads_states_only(spark, tmp_path):
    table = _served(spark, _prices(spark), tmp_path / "t")
    path = rollups.refresh(rollups.MONTHLY, table, str(tmp_path / "s"))
    report = barloom.report(spark, rollups.MONTHLY, path)
    assert {os.path.dirname(f).split("/Year")[0].removeprefix("file://") for f in report.inputFiles()} == {path}


def test_partitions_that_lost_their_rows_leave_the_report(spark, tmp_path):
    prices = _prices(spark)
    path = rollups.refresh(rollups.MONTHLY, prices, str(tmp_path / "s"))
    less = prices.where("not coalesce(Year = 2020 and Month = 2, false)")
    rollups.refresh(rollups.MONTHLY, less, path, [(2020, 2)])
    assert same(rows(barloom.report(spark, rollups.MONTHLY, path)), rows(barloom.monthly_price_stats(less)))
    rollups.refresh(rollups.MONTHLY, less, path, [])
    assert barloom.report(spark, rollups.MONTHLY, path).where("Year = 2020 and Month = 2").isEmpty()


def test_distinct_estimates_stay_within_their_bound_over_many_merges(spark, tmp_path):
    rng = random.Random(8)
    path = str(tmp_path / "s")
    known: set[int] = set()
    table = None
    for year in range(2000, 2008):
        start, size = rng.randrange(30_000), rng.randrange(5_000, 40_000)
        known |= set(range(start, start + size))
        part = spark.range(start, start + size).select(
            F.concat(F.lit("T"), "id").alias("Ticker"), F.lit(year).cast("long").alias("Year")
        )
        part = part.unionByName(part.limit(100)).unionByName(part.limit(3).withColumn("Ticker", F.lit(None)))
        table = part if table is None else table.unionByName(part)
        rollups.refresh(rollups.FUNDAMENTALS_COUNTS, table, path, [(year,)])
        row = barloom.report(spark, rollups.FUNDAMENTALS_COUNTS, path, []).first()
        assert abs(row.tickers - len(known)) <= rollups.SKETCH_ERROR * len(known)
    assert row.rows == table.count()


def test_stored_quality_of_small_and_empty_tables(spark, tmp_path):
    fundamentals = spark.createDataFrame([("A", 2020), ("B", 2020), (None, None)], "Ticker string, Year long")
    stored = [
        rollups.refresh(rollups.FUNDAMENTALS_COUNTS, fundamentals, str(tmp_path / "f")),
        rollups.refresh(rollups.PRICES_COUNTS, _prices(spark, size=0), str(tmp_path / "p")),
    ]
    assert dict(rows(barloom.stored_quality(spark, *stored))) == {
        "Fundamentals row count": 3,
        "Unique tickers in fundamentals": 2,
        "Prices row count": 0,
        "Unique tickers in prices": 0,
    }


def test_what_is_no_rollup(spark):
    with pytest.raises(ValueError, match="median"):
        barloom.Rollup(("Year",), {"m": "median(Close)"}, ("Year",))
    with pytest.raises(ValueError, match="parts"):
        barloom.Rollup(("Ticker",), {"n": "count(*)"}, ("Year",))
