import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

import barloom
from barloom import schemas
from barloom.operators import skew
from barloom.operators.history import over_history
from tests.helpers import plan, rows, same

PRICE = "Ticker string, Date date, Close double"


def _series(spark, closes, ticker="A", start=dt.date(2024, 1, 2), step=1):
    data = [(ticker, start + dt.timedelta(days=i * step), c) for i, c in enumerate(closes)]
    return spark.createDataFrame(data, PRICE)


def _random_prices(spark, seed=3, tickers=("A", "B", None), n=700):
    """Histories of several years with gaps, NULL and zero closes, and a NULL date."""
    rng = random.Random(seed)
    data = [("A", None, 5.0)]
    for t in tickers:
        day = dt.date(2018, 11, 1)
        for _ in range(n):
            # Long gaps leave years with few rows, so frames reach over several blocks.
            day += dt.timedelta(days=rng.choice([1, 1, 1, 3, 40, 200]))
            close = rng.choice([None, 0.0, *[round(rng.uniform(1, 99), 2)] * 8])
            data.append((t, day, close))
    data.append(("C", dt.date(2020, 5, 5), 1.0))
    return spark.createDataFrame(data, PRICE)


def _one_window(df, n):
    w = Window.partitionBy("Ticker").orderBy("Date")
    return df.withColumns(
        {
            f"SMA_{n}": F.avg("Close").over(w.rowsBetween(1 - n, 0)),
            "Daily_Return": F.try_divide("Close", F.lag("Close").over(w)) - 1,
        }
    )


def test_known_series(spark):
    days = [dt.date(2024, 1, d) for d in (2, 3, 4, 8, 9)]
    data = [
        ("A", d, None, None, None, c, None, 2_500_000)
        for d, c in zip(days, [10.0, 12.0, None, 0.0, 6.0])
    ]
    enriched = barloom.enrich_prices(spark.createDataFrame(data, schemas.PRICES))
    got = enriched.orderBy("Date").collect()
    assert same([r.SMA_20 for r in got], [10.0, 11.0, 11.0, 22 / 3, 7.0])
    assert same([r.Daily_Return for r in got], [None, 0.2, None, None, None])
    assert [(r.Year, r.Month, r.Volume_Millions) for r in got] == [(2024, 1, 2.5)] * 5

    served = barloom.stock_prices(enriched)
    assert served.schema == schemas.STOCK_PRICES
    kept = served.orderBy("Date").collect()
    assert [r.Date for r in kept] == [days[0], days[1], days[4]]
    assert same([r.Daily_Return for r in kept], [None, 0.2, None])


def test_frame_counts_rows_not_days(spark):
    got = barloom.moving_average(_series(spark, [float(i) for i in range(30)], step=9), n=20)
    last = got.orderBy(F.desc("Date")).first()
    assert last.SMA_20 == sum(range(10, 30)) / 20


def test_average_of_only_nulls_is_null(spark):
    assert {r.SMA_3 for r in barloom.moving_average(_series(spark, [None] * 4), n=3).collect()} == {
        None
    }


def test_text_dates_and_rejects(spark):
    df = spark.createDataFrame(
        [("A", "2024-01-02", 1.0), ("A", "not a date", 2.0), ("A", None, 3.0)],
        "Ticker string, Date string, Close double",
    )
    assert sorted(str(r.Date) for r in barloom.stock_prices(df).collect()) == [
        "2024-01-02", "None", "None",
    ]
    assert rows(barloom.rejected_dates(df)) == [("Rejected price dates", 1)]


def _both_measures(df, n, **options):
    """Moving average and return, each from its own pass, joined on the unique dates."""
    average = barloom.moving_average(df, n, **options)
    returns = barloom.daily_return(df, **options).withColumnsRenamed({"Ticker": "t", "Date": "d"})
    match = F.col("Ticker").eqNullSafe(F.col("t")) & F.col("Date").eqNullSafe(F.col("d"))
    return average.join(returns.drop("Close"), match).drop("t", "d")


@pytest.mark.parametrize("n", [1, 2, 20])
@pytest.mark.parametrize("hot_rows", [10, 100])
def test_split_history_equals_one_window(spark, n, hot_rows):
    """Hot tickers, also the NULL ticker, cut into blocks give the very same numbers.

    Blocks of about ten rows are shorter than the frame, which then spans several.
    """
    df = _random_prices(spark)
    assert rows(_both_measures(df, n, hot_rows=hot_rows)) == rows(_one_window(df, n))


def test_copies_of_a_row_are_split(spark):
    """A third of all rows are copies; others share the date or have no key at all."""
    day = dt.date(2020, 3, 2)
    data = [("A", day, 4.0)] * 700 + [("A", day, float(i)) for i in range(300)]
    data += [(None, None, None)] * 400 + [("B", day + dt.timedelta(days=i), 2.0) for i in range(90)]
    df = spark.createDataFrame(data, PRICE).repartition(16)
    split = barloom.moving_average(df, 5, hot_rows=100)
    w = Window.partitionBy("Ticker").orderBy("Date", "Close").rowsBetween(-4, 0)
    assert rows(split) == rows(df.withColumn("SMA_5", F.avg("Close").over(w)))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = split.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert max(r["count"] for r in sizes) < 600


def test_split_enrichment_keeps_every_row_once(spark):
    df = _random_prices(spark).selectExpr("*", "1L as Volume", "'x' as Extra")
    split = barloom.enrich_prices(df, hot_rows=50)
    assert split.columns == barloom.enrich_prices(df).columns
    assert rows(split) == rows(barloom.enrich_prices(df))


def test_split_carries_every_column_that_is_read(spark):
    df = _random_prices(spark, n=300).withColumn("Other", F.col("Close") * 2)

    def measures(w):
        frame = w.rowsBetween(-200, 0)
        return {"a": F.sum("Close").over(frame), "b": F.sum("Other").over(frame)}

    def run(**options):
        out = over_history(df, measures, depth=200, reads=["Close", "Other"], **options)
        return rows(out.select("Ticker", "Date", F.round("a", 6), F.round("b", 6)))

    assert same(run(hot_rows=20), run())


def test_split_works_on_timestamps(spark):
    df = _random_prices(spark).withColumn("Date", F.col("Date").cast("timestamp"))
    split = barloom.moving_average(df, 20, hot_rows=100)
    assert rows(split) == rows(barloom.moving_average(df, 20))


def test_plain_plan_has_one_exchange_and_one_window(spark, tmp_path):
    path = str(tmp_path / "prices")
    _random_prices(spark).selectExpr("*", "1L as Volume").write.parquet(path)
    text = plan(barloom.enrich_prices(spark.read.parquet(path)))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Window [") == 1 and text.count("Sort [") == 1
    assert "Python" not in text


def test_monthly_stats_reuse_the_partitioning_of_the_window(spark, tmp_path):
    path = str(tmp_path / "prices")
    data = [("A", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 1.5, 10)]
    spark.createDataFrame(data, schemas.PRICES).write.parquet(path)
    served = barloom.stock_prices(barloom.enrich_prices(spark.read.parquet(path)))
    text = plan(barloom.monthly_price_stats(served))
    assert text.count("Exchange") == 1 and "hashpartitioning(Ticker" in text
    counted = plan(barloom.quality_summary(served, served))
    assert "Window" not in counted


def test_ticker_filter_passes_below_the_window(spark, tmp_path):
    path = str(tmp_path / "prices")
    _random_prices(spark).write.parquet(path)
    enriched = barloom.moving_average(spark.read.parquet(path))
    text = plan(enriched.where("Ticker = 'A' and Close > 0"))
    assert "PushedFilters: [IsNotNull(Ticker), EqualTo(Ticker,A)]" in text
    assert "GreaterThan(Close" not in text


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0.5, 100), min_size=1, max_size=12))
def test_properties(spark, closes):
    df = _series(spark, closes)
    one = barloom.moving_average(df, n=1)
    assert all(r.SMA_1 == r.Close for r in one.collect())
    product = 1.0
    for r in barloom.daily_return(df).collect():
        product *= 1 + (r.Daily_Return or 0.0)
    assert same(product, closes[-1] / closes[0], 1e-6)


def test_average_needs_a_row(spark):
    with pytest.raises(ValueError):
        barloom.moving_average(_series(spark, [1.0]), n=0)


def test_windows_have_tasks_by_the_number_of_rows(spark, monkeypatch, tmp_path):
    """Else a task sorts a share of the table that grows with it, up to spilling."""
    path = str(tmp_path / "prices")
    _random_prices(spark).selectExpr("*", "1L as Volume").write.parquet(path)
    df = spark.read.parquet(path)
    few = barloom.enrich_prices(df)
    assert "REPARTITION_BY_NUM" not in plan(few)
    monkeypatch.setattr(skew, "TASK_ROWS", 7)
    tasks = -(-df.count() // 7)
    many = barloom.enrich_prices(df)
    text = plan(many)
    assert "Exchange hashpartitioning(Ticker" in text and f", {tasks}), REPARTITION_BY_NUM" in text
    assert text.count("Exchange") == 1 and rows(many) == rows(few)
    split = plan(barloom.enrich_prices(df, hot_rows=50))
    assert f", {tasks}), REPARTITION_BY_NUM" in split


@pytest.mark.parametrize("empty", ["where 1 = 0", "where Close > 5 and Close < 1"])
def test_windows_over_no_rows(spark, empty):
    _random_prices(spark).createOrReplaceTempView("some_prices")
    assert barloom.moving_average(spark.sql(f"select * from some_prices {empty}")).count() == 0
    assert skew.hot_keys_and_rows({"": spark.sql(f"select * from some_prices {empty}")}, ["Ticker"]) == (None, 0)


def test_rows_are_counted_where_no_key_is_frequent(spark):
    """Classes of many rare keys list none; their rows count all the same."""
    rare = spark.range(1_200_000).select(F.col("id").cast("string").alias("k"))
    assert skew.hot_keys_and_rows({"": rare}, ["k"]) == (None, 1_200_000)
    assert skew.hot_keys_and_rows({"": rare.union(rare.limit(5)), "b": rare.limit(7)}, ["k"]) == (None, 1_200_012)
