import datetime as dt
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

import barloom
from barloom.operators import hot_keys, outer_merge, skew
from tests.helpers import plan, rows

KEYS = ["Ticker", "Report_Date"]


def _table(spark, pairs, measure):
    data = [(t, d, v) for (t, d), v in pairs]
    return spark.createDataFrame(data, f"Ticker string, Report_Date date, {measure} int")


def _random_tables(spark, seed, size=120, hot=0):
    """Three tables with repeated, missing and NULL keys; ``hot`` extra rows of some keys."""
    rng = random.Random(seed)
    days = [dt.date(2020, 1, 1), dt.date(2021, 1, 1), None]
    tables = {}
    for i, name in enumerate("abc"):
        pairs = [
            ((rng.choice([None, *[f"T{j}" for j in range(60)]]), rng.choice(days)), k)
            for k in range(size)
        ]
        if hot and name in "ab":
            pairs += [(("H", days[0]), 1000 + k % 7) for k in range(hot // (1 + 9 * i))]
        if hot and name == "b":
            pairs += [((None, None), 5) for _ in range(hot)]
        if hot and name == "c":
            pairs += [(("C", days[1]), 3) for _ in range(hot)]
        tables[name] = _table(spark, pairs, f"v_{name}").repartition(6)
    return tables


def _by_pandas(tables):
    merged = None
    for df in tables.values():
        frame = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
        merged = frame if merged is None else merged.merge(frame, on=KEYS, how="outer")
    merged = merged.astype(object).where(merged.notna(), None)
    return sorted(
        (tuple(int(v) if isinstance(v, float) else v for v in r) for r in merged.values.tolist()),
        key=lambda r: [(v is not None, str(v)) for v in r],
    )


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def test_null_keys(spark):
    day = dt.date(2020, 1, 1)
    left = _table(spark, [(("A", day), 1), ((None, day), 2)], "l")
    right = _table(spark, [(("A", day), 5), ((None, day), 6)], "r")
    tables = {"left": left, "right": right}
    assert rows(outer_merge(tables, KEYS)) == [(None, day, 2, 6), ("A", day, 1, 5)]
    assert rows(outer_merge(tables, KEYS, null_safe=False)) == [
        (None, day, None, 6), (None, day, 2, None), ("A", day, 1, 5),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables_equal_pandas(spark, seed):
    tables = _random_tables(spark, seed)
    assert _sorted(outer_merge(tables, KEYS)) == _by_pandas(tables)


@pytest.mark.parametrize("hot_rows", [20, 60])
def test_hot_keys_equal_pandas(spark, hot_rows):
    """Keys that hold much of one or of two tables, the NULL key among them."""
    tables = _random_tables(spark, 5, size=60, hot=200)
    hot = hot_keys(tables, KEYS, hot_rows)
    found = {(r._table, r.Ticker) for r in hot.collect()}
    assert {("a", "H"), ("b", None), ("c", "C")} <= found
    assert _sorted(outer_merge(tables, KEYS, hot_rows=hot_rows)) == _by_pandas(tables)


def test_hot_keys_without_null_matching(spark):
    tables = _random_tables(spark, 6, size=60, hot=200)
    split = outer_merge(tables, KEYS, null_safe=False, hot_rows=20)
    assert _sorted(split) == _sorted(outer_merge(tables, KEYS, null_safe=False))


def test_hot_rows_are_spread(spark):
    """No task of the hot merge gets all copies of the hot key."""
    day = dt.date(2020, 1, 1)
    copies = _table(spark, [(("H", day), 1)] * 4000, "l").repartition(16)
    other = _table(spark, [(("H", day), 2), (("X", day), 3)], "r")
    merged = outer_merge({"left": copies, "right": other}, KEYS, hot_rows=100)
    sizes = merged.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 4001
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = merged.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(r["count"] for r in sizes) < 2500


def test_no_hot_keys_is_none(spark):
    assert hot_keys(_random_tables(spark, 1), KEYS) is None
    assert hot_keys({"no table is read": None}, KEYS, hot_rows=None) is None


def test_unique_keys_path(spark):
    day = dt.date(2020, 1, 1)
    tables = {
        "a": _table(spark, [(("A", day), 1), (("B", day), 2)], "x"),
        "b": _table(spark, [(("B", day), 3), ((None, day), 4)], "y"),
        "c": _table(spark, [((None, day), 5)], "z"),
    }
    fast = outer_merge(tables, KEYS, unique_keys=True)
    assert fast.columns == [*KEYS, "x", "y", "z"]
    assert rows(fast) == rows(outer_merge(tables, KEYS))
    assert plan(fast).count("Exchange hashpartitioning") == 1
    assert rows(outer_merge(tables, KEYS, unique_keys=True, null_safe=False)) == rows(
        outer_merge(tables, KEYS, null_safe=False)
    )


def test_unique_keys_refuses_a_repeated_key(spark):
    a = spark.createDataFrame([("A", 1), ("A", 2)], "k string, x int")
    b = spark.createDataFrame([("A", 3)], "k string, y int")
    with pytest.raises(Exception, match="repeats a key"):
        outer_merge({"a": a, "b": b}, ["k"], unique_keys=True).collect()


def test_hot_rows_of_clustered_input_are_spread(spark):
    """Rows of one key that all come from one task are dealt out by their values."""
    data = spark.range(4000).selectExpr("'A' as k", "id as x").repartition(4, "k")
    other = spark.createDataFrame([("A", 1)], "k string, y int")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = outer_merge({"a": data, "b": other}, ["k"], hot_rows=500)
        sizes = merged.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in sizes) == 4000 and max(r["count"] for r in sizes) < 2500


def test_only_overlapping_names_get_a_suffix(spark):
    day = dt.date(2020, 1, 1)
    schema = "Ticker string, `Report Date` date, Currency string, {} int"
    frames = [
        spark.createDataFrame([("A", day, c, 1)], schema.format(m))
        for c, m in (("USD", "Revenue"), ("EUR", "Debt"))
    ]
    cash = spark.createDataFrame([("A", day, 9)], "Ticker string, `Report Date` date, Cash int")
    merged = barloom.merge_statements(*frames, cash)
    assert merged.columns == [
        *KEYS, "Currency_income", "Revenue", "Currency_balance", "Debt", "Cash",
    ]
    assert rows(merged) == [("A", day, "USD", 1, "EUR", 1, 9)]


def _wide(tables, width=20):
    """The same tables with many more columns each."""
    return {
        n: df.select("*", *[(F.col(f"v_{n}") + i).alias(f"{n}{i}") for i in range(width)])
        for n, df in tables.items()
    }


def _saved(spark, tables, tmp_path):
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    return {name: spark.read.parquet(str(tmp_path / name)) for name in tables}


def _sort_merge_plan(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(outer_merge(tables, KEYS))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wide_tables_equal_pandas(spark):
    tables = _wide(_random_tables(spark, 7))
    assert _sorted(outer_merge(tables, KEYS)) == _by_pandas(tables)
    hot = _wide(_random_tables(spark, 8, size=40, hot=80))
    assert _sorted(outer_merge(hot, KEYS, hot_rows=30)) == _by_pandas(hot)


def test_wide_tables_are_shuffled_once_each(spark, tmp_path):
    tables = _saved(spark, _wide(_random_tables(spark, 1)), tmp_path)
    text = _sort_merge_plan(spark, tables)
    assert text.count("Exchange hashpartitioning") == len(tables) + 1
    assert text.count("SortMergeJoin") == len(tables)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_narrow_tables_are_chained(spark, tmp_path):
    text = _sort_merge_plan(spark, _saved(spark, _random_tables(spark, 1), tmp_path))
    assert text.count("FullOuter") == 2 and text.count("Exchange hashpartitioning") == 4
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_row_count_of_unique_keys_is_the_union(spark):
    day = dt.date(2020, 1, 1)
    sets = [set(range(0, 9)), set(range(5, 14)), set(range(3, 20, 4))]
    tables = {
        f"t{i}": _table(spark, [((f"T{k}", day), k) for k in ks], f"v{i}")
        for i, ks in enumerate(sets)
    }
    assert outer_merge(tables, KEYS).count() == len(set().union(*sets))


def _keys(spark, hot, distinct):
    """``distinct`` keys once or twice each, and the ``hot`` ones so often."""
    rare = spark.range(distinct).select((F.col("id") * 7 % (distinct // 2)).cast("string").alias("k"))
    for key, n in hot.items():
        rare = rare.unionByName(spark.range(n).select(F.lit(key).cast("string").alias("k")))
    return rare.repartition(8).select("k", F.lit(1).alias("v"))


def test_sketches_miss_no_hot_key(spark):
    hot = {"A": 90_000, "B": 20_000, None: 9_000, "C": 4_001, **{f"h{i}": 4_100 + i for i in range(40)}}
    table = _keys(spark, {**hot, "almost": 4_000, "less": 900}, 600_000)
    found = {r.k: r._parts for r in hot_keys({"t": table, "u": table.limit(10)}, ["k"], 4_000).collect()}
    assert found == {k: -(-n // 4_000) for k, n in hot.items()}


def test_only_listed_keys_are_counted_exactly(spark, monkeypatch):
    from barloom.operators import skew

    seen = []
    counted = skew._counted
    monkeypatch.setattr(skew, "_counted", lambda df, keys: (seen.append((df, keys)), counted(df, keys))[1])
    table = _keys(spark, {"A": 9_000}, 400_000)
    assert hot_keys({"t": table}, ["k"], 100_000) is None and not seen
    assert [r.k for r in hot_keys({"t": table}, ["k"], 5_000).collect()] == ["A"]
    ((df, keys),) = seen
    assert keys == ["_table", "k"] and df.select("k").distinct().count() == 1


def test_candidates_are_bounded_whatever_the_number_of_keys(spark):
    from barloom.operators import skew

    table = _keys(spark, {"A": 5_000}, 1_000_000).select(F.lit("t").alias("_table"), F.xxhash64("k").alias("_hash"))
    listed = skew._candidates(table)
    assert listed.count() <= skew._CLASSES * skew._REPORTED
    hashed = spark.range(1).select(F.xxhash64(F.lit("A"))).first()[0]
    assert listed.where(F.col("_hash") == hashed).first()._n >= 5_000


@pytest.mark.parametrize("wide", [False, True])
def test_a_merge_has_tasks_by_the_number_of_rows(spark, monkeypatch, tmp_path, wide):
    """Else a task sorts a share of the tables that grows with them, whatever it is."""
    tables = {}
    for name, df in _random_tables(spark, 3).items():
        more = {f"{name}{i}": F.col(f"v_{name}") + i for i in range(20 if wide else 0)}
        df.withColumns(more).write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    few = outer_merge(tables, KEYS)
    assert "REPARTITION_BY_NUM" not in plan(few)
    monkeypatch.setattr(skew, "TASK_ROWS", 20)
    many = outer_merge(tables, KEYS)
    text = plan(many)
    # 360 rows; each table is moved once, and so is the list of keys or the intermediate rows.
    assert set(re.findall(r"hashpartitioning\(.*?, (\d+)\)", text)) == {"18"}
    assert text.count("Exchange hashpartitioning") == 4
    assert _sorted(many) == _sorted(few)
    split = outer_merge(tables, KEYS, hot_rows=15)
    assert ", 18), REPARTITION_BY_NUM" in plan(split) and _sorted(split) == _sorted(few)
