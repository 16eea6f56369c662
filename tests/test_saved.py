import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import barloom
from barloom import schemas
from barloom.operators import saved
from barloom.sinks import catalog, save_bucketed
from tests.helpers import plan, rows, same

DAY = dt.date(2024, 1, 1)


@pytest.fixture
def database(spark, tmp_path, request):
    name = "saved_" + str(abs(hash(request.node.name)))[:9]
    catalog.create_database(spark, name, str(tmp_path / "db"))
    return name


def _prices(spark, tickers=12, days=60):
    rng = random.Random(4)
    data = [
        (None if t == 0 else f"T{t}", DAY + dt.timedelta(d), 1.0, 2.0, 0.5, rng.choice([None, 0.0, float(d % 7 + t)]), 1.0, d)
        for t in range(tickers)
        for d in range(days if t != 3 else 5 * days)
    ]
    rng.shuffle(data)
    return spark.createDataFrame(data, schemas.PRICES).repartition(5)


def _statements(spark):
    def table(schema, keys):
        data = [(*k, *[float(i + j) for j in range(len(schema.fields) - 2)]) for i, k in enumerate(keys)]
        return spark.createDataFrame(data, schema).repartition(3)

    day = [DAY + dt.timedelta(d) for d in range(4)]
    some = [(f"T{i % 9}", day[i % 4]) for i in range(30)] + [(None, day[0]), (None, None), ("T1", None), ("", dt.date(1970, 1, 1))]
    return (
        table(schemas.INCOME, some + [("hot", day[0])] * 7),
        table(schemas.BALANCE, some[5:] + [("hot", day[0])] * 3 + [(None, None)]),
        table(schemas.CASHFLOW, some[:20] + [("only", day[1]), (None, dt.date(1970, 1, 1)), ("", None)]),
    )


def test_windows_of_saved_prices_move_and_sort_nothing(spark, database):
    prices = _prices(spark)
    barloom.save_prices(prices, f"{database}.p")
    got = barloom.enrich_saved_prices(spark, f"{database}.p")
    text = plan(got)
    assert "Exchange" not in text and "Sort" not in text and "Bucketed: true" in text
    assert text.count("Window") <= 2 and "avg(Close" in text
    assert same(rows(got), rows(barloom.enrich_prices(prices)))


@pytest.mark.parametrize("hot_rows", [50, 100, 10_000])
def test_histories_too_big_for_a_bucket_lie_beside(spark, database, hot_rows):
    prices = _prices(spark)
    name = f"{database}.p"
    barloom.save_prices(prices, name, buckets=3, hot_rows=hot_rows)
    hot = {r.Ticker for r in spark.table(f"{name}__hot").select("Ticker").collect()} if hot_rows < 10_000 else set()
    assert hot == {50: {None, *[f"T{i}" for i in range(1, 12)]}, 100: {"T3"}}.get(hot_rows, set())
    assert {r.Ticker for r in spark.table(name).select("Ticker").collect()}.isdisjoint(hot)
    got = barloom.enrich_saved_prices(spark, name, hot_rows=hot_rows)
    assert same(rows(got), rows(barloom.enrich_prices(prices)))


def test_saving_again_replaces_buckets_and_hot_rows(spark, database):
    name = f"{database}.p"
    barloom.save_prices(_prices(spark), name, hot_rows=100)
    few = _prices(spark, tickers=2, days=3)
    barloom.save_prices(few, name, hot_rows=100)
    assert not spark.catalog.tableExists(f"{name}__hot")
    assert same(rows(barloom.enrich_saved_prices(spark, name)), rows(barloom.enrich_prices(few)))


def test_a_second_file_of_a_bucket_costs_a_sort_and_no_shuffle(spark, database):
    name = f"{database}.p"
    prices = _prices(spark)
    january = F.col("Date") < dt.date(2024, 1, 20)
    barloom.save_prices(prices.where(january), name)
    later = prices.where(~january).repartition(8, "Ticker")
    later.write.mode("append").format("parquet").bucketBy(8, "Ticker").sortBy("Ticker", "Date", "Close").saveAsTable(name)
    got = barloom.enrich_saved_prices(spark, name)
    assert "Exchange" not in plan(got) and "Sort" in plan(got)
    assert same(rows(got), rows(barloom.enrich_prices(prices)))


def test_saved_statements_merge_without_a_shuffle(spark, database):
    tables = _statements(spark)
    barloom.save_statements(*tables, database=database)
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(broadcast)
    spark.conf.set(broadcast, "-1")
    try:
        got = barloom.merge_saved_statements(spark, database)
        assert "Exchange" not in plan(got) and "Sort [" not in plan(got)
        assert plan(got).count("SortMergeJoin") == 3
    finally:
        spark.conf.set(broadcast, before)
    expected = barloom.merge_statements(*tables)
    assert got.columns == expected.columns and got.dtypes == expected.dtypes
    assert rows(got) == rows(expected)


@pytest.mark.parametrize("hot_rows", [1, 2, 5])
def test_hot_keys_of_saved_statements(spark, database, hot_rows):
    tables = _statements(spark)
    barloom.save_statements(*tables, database=database, buckets=4, hot_rows=hot_rows)
    assert spark.table(f"{database}.income__hot").count() >= 7
    got = barloom.merge_saved_statements(spark, database, hot_rows=hot_rows)
    assert rows(got) == rows(barloom.merge_statements(*tables))


def test_empty_tables(spark, database):
    empty = [spark.createDataFrame([], s) for s in (schemas.INCOME, schemas.BALANCE, schemas.CASHFLOW)]
    barloom.save_statements(*empty, database=database)
    assert barloom.merge_saved_statements(spark, database).count() == 0
    barloom.save_prices(spark.createDataFrame([], schemas.PRICES), f"{database}.p")
    assert barloom.enrich_saved_prices(spark, f"{database}.p").count() == 0


def test_keys_of_other_types_are_stored_without_null(spark, database):
    kinds = "a long, b timestamp, c boolean, d double"
    data = [(1, None, True, 0.5), (None, dt.datetime(1970, 1, 1), None, 0.0), (0, None, False, None), (None, None, None, None)]
    left = spark.createDataFrame([(*k, i) for i, k in enumerate(data)], kinds + ", x int")
    right = spark.createDataFrame([(*k, i) for i, k in enumerate(data[1:] + data[:1])], kinds + ", y int")
    keys = ["a", "b", "c", "d"]
    saved.save_statements({"l": left, "r": right}, database, keys)
    got = saved.merge_saved(spark, ["l", "r"], database, keys)
    assert sorted((r.x, r.y) for r in got.collect()) == [(0, 3), (1, 0), (2, 1), (3, 2)]
    assert rows(got.select(*keys)) == rows(left.select(*keys))


def test_one_file_per_bucket(spark, database):
    table = save_bucketed(_prices(spark), f"{database}.b", ["Ticker"], ["Date"], buckets=5)
    assert len(table.inputFiles()) <= 5
