import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import barloom
from barloom.operators import percent_ranks
from tests.helpers import plan, rows

SCHEMA = "Ticker string, Company_Name string, Year bigint, ROE double, Current_Ratio double"


def _companies(spark, seed=4, n=900):
    """Years of very different size, NULL years and metrics, and much-repeated values."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        year = rng.choice([None, 2020, 2020, 2020, 2021])
        roe = rng.choice([None, 0.0, 0.0, -0.0, 7.5, rng.gauss(0, 50), rng.gauss(0, 50)])
        ratio = rng.choice([None, 1.0, 1.0, rng.lognormvariate(0, 2), float("nan")])
        data.append((f"T{i}", None, year, roe, ratio))
    data.append(("alone", None, 1999, 1.0, 1.0))
    return spark.createDataFrame(data, SCHEMA).repartition(7)


def _one_window(df):
    both = F.col("ROE").isNotNull() & F.col("Current_Ratio").isNotNull()
    out = df.withColumn("both", both)
    for m in ("ROE", "Current_Ratio"):
        w = Window.partitionBy("Year", "both").orderBy(m)
        out = out.withColumn(f"{m}_Rank", F.when(both, F.percent_rank().over(w)))
    return out.drop("both")


def _keyed(df):
    return {r.Ticker: (r.ROE_Rank, r.Current_Ratio_Rank) for r in df.collect()}


RANKS = {"ROE": "ROE_Rank", "Current_Ratio": "Current_Ratio_Rank"}


@pytest.mark.parametrize("hot_rows", [1, 20, 100, 1_000_000])
def test_ranks_equal_one_window(spark, hot_rows):
    df = _companies(spark)
    got = percent_ranks(df, "Year", RANKS, hot_rows=hot_rows)
    assert got.columns == [*df.columns, *RANKS.values()]
    assert got.count() == df.count()
    assert _keyed(got) == _keyed(_one_window(df))


def test_one_value_in_a_year_is_spread(spark):
    data = [(f"T{i}", None, 2020, 3.0, float(i % 2)) for i in range(2000)]
    df = spark.createDataFrame(data, SCHEMA).repartition(8)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = percent_ranks(df, "Year", RANKS, hot_rows=100)
        sizes = got.groupBy(F.spark_partition_id()).count().collect()
        ranks = {tuple(r) for r in got.select("ROE_Rank", "Current_Ratio_Rank").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert max(r["count"] for r in sizes) < 1500
    assert ranks == {(0.0, 0.0), (0.0, 1000 / 1999)}


def test_score(spark):
    data = [
        ("A", "a", 2024, 10.0, 1.0),
        ("B", "b", 2024, 20.0, 3.0),
        ("C", "c", 2024, 30.0, 2.0),
        ("D", "d", 2024, None, 9.0),
        ("E", "e", 2023, 5.0, 5.0),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.Ticker: r.Score for r in barloom.ticker_score(df).collect()}
    assert got == {"A": 0.0, "B": 0.75, "C": 0.75, "D": None, "E": 0.0}
    only = barloom.ticker_score(df, years=(2024, 2026))
    assert {r.Year for r in only.collect()} == {2024}


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(percent_ranks(empty, "Year", RANKS)) == []


def test_no_window_without_partition(spark):
    text = plan(percent_ranks(_companies(spark), "Year", RANKS, hot_rows=20))
    assert "SinglePartition" not in text and "Python" not in text
