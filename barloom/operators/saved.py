"""Histories and statements that are shuffled once, when they are saved.

A saved table lies in buckets by key, sorted. Windows over it and merges of it then run
bucket by bucket, without an exchange. Keys that are too big for a task would make one
bucket too big as well; they are found when the table is saved, and their rows go to a
second table, ``<name>__hot``, which takes the way of the plain operators.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.history import Measures, over_history
from barloom.operators.merge import outer_merge, suffix_overlaps
from barloom.operators.skew import HOT_ROWS, hot_keys, mark_hot
from barloom.sinks.buckets import save_bucketed, trust_order
from barloom.sinks.catalog import drop_table, quoted

_NULLS = "_nulls"
_HOT = "__hot"
_KEYS = "__keys"


def save_history(
    df: DataFrame,
    name: str,
    key: str = "Ticker",
    order: str = "Date",
    reads: Sequence[str] = ("Close",),
    buckets: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> None:
    """Save ``df`` for :func:`over_saved_history`: by ``key``, sorted by ``order`` and ``reads``.

    Replaces what was saved under ``name``.
    """
    hot = hot_keys({"": df}, [key], hot_rows)
    _save_hot(df, name, hot, [key])
    cold = df if hot is None else mark_hot(df, hot.select(key), [key], "left_anti")
    save_bucketed(cold, name, [key], [order, *reads], buckets)


def over_saved_history(
    spark: SparkSession,
    name: str,
    measures: Measures,
    depth: int,
    key: str = "Ticker",
    order: str = "Date",
    reads: Sequence[str] = ("Close",),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """:func:`~barloom.operators.history.over_history` of a saved table.

    The buckets are read in their order: no exchange and no sort. Histories that were too
    big for a bucket are cut into blocks.
    """
    trust_order(spark)
    window = Window.partitionBy(key).orderBy(order, *reads)
    done = spark.table(name).withColumns(measures(window))
    if not spark.catalog.tableExists(name + _HOT):
        return done
    big = over_history(spark.table(name + _HOT), measures, depth, key, order, reads, hot_rows)
    return done.unionByName(big)


def save_statements(
    tables: Mapping[str, DataFrame],
    database: str,
    keys: Sequence[str],
    buckets: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> None:
    """Save ``tables`` alike for :func:`merge_saved`, and the list of all their keys.

    Columns that occur in several tables get their table's name as suffix. Keys are stored
    without NULL, which is told by a bit of its own, so that NULLs match by plain equality.
    """
    keys = list(keys)
    tables = suffix_overlaps(tables, keys)
    hot = hot_keys(tables, keys, hot_rows)
    big = None if hot is None else hot.select(*keys).distinct()
    stored = _stored(keys)
    lists = []
    for name, df in tables.items():
        table = f"{database}.{name}"
        _save_hot(df, table, big, keys)
        cold = df if big is None else mark_hot(df, big, keys, "left_anti")
        laid = cold.select(*_store(cold, keys), *[c for c in cold.columns if c not in keys])
        save_bucketed(laid, table, stored, buckets=buckets)
        lists.append(laid.select(*stored))
    # Dealt out before keys are made distinct: Spark 4.1 takes a union of buckets for rows
    # that lie by key already, although their buckets are not brought together.
    every = reduce(DataFrame.union, lists).repartition(*stored).distinct()
    save_bucketed(every, _key_table(database, tables), stored, buckets=buckets)


def merge_saved(
    spark: SparkSession,
    names: Sequence[str],
    database: str,
    keys: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Null-safe full outer merge of saved tables, as ``outer_merge`` of the same rows.

    Each table is left-joined to the list of keys, bucket by bucket: nothing is shuffled.
    Rows of keys that were too big for a bucket are merged on their own.
    """
    trust_order(spark)
    keys = list(keys)
    stored = _stored(keys)
    tables = [spark.table(f"{database}.{name}") for name in names]
    measures = [c for df in tables for c in df.columns if c not in stored]
    merged = reduce(lambda a, b: a.join(b, stored, "left"), tables, spark.table(_key_table(database, names)))
    merged = merged.select(*_restore(keys), *measures)
    hot = {n: f"{database}.{n}{_HOT}" for n in names}
    if not all(spark.catalog.tableExists(t) for t in hot.values()):
        return merged
    big = outer_merge({n: spark.table(t) for n, t in hot.items()}, keys, hot_rows=hot_rows)
    return merged.unionByName(big)


def _save_hot(df: DataFrame, name: str, hot: DataFrame | None, keys: list[str]) -> None:
    """Rows of the hot keys beside the buckets, or nothing where there are none."""
    if hot is None:
        drop_table(df.sparkSession, name + _HOT)
        return
    rows = mark_hot(df, hot.select(*keys), keys, "left_semi")
    rows.write.mode("overwrite").format("parquet").saveAsTable(quoted(name + _HOT))


def _key_table(database: str, names: Sequence[str] | Mapping[str, DataFrame]) -> str:
    return f"{database}.{'_'.join(names)}{_KEYS}"


def _stored(keys: Sequence[str]) -> list[str]:
    return [*(f"_key_{k}" for k in keys), _NULLS]


def _store(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The keys with a default in place of NULL, and which of them are NULL, as bits."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = [F.coalesce(F.col(k), _default(kinds[k])).alias(f"_key_{k}") for k in keys]
    bits = [F.when(F.col(k).isNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)]
    return [*values, reduce(Column.bitwiseOR, bits).cast("int").alias(_NULLS)]


def _restore(keys: Sequence[str]) -> list[Column]:
    present = lambda i: F.col(_NULLS).bitwiseAND(F.lit(1 << i)) == 0
    return [F.when(present(i), F.col(f"_key_{k}")).alias(k) for i, k in enumerate(keys)]


def _default(kind: T.DataType) -> Column:
    text = "" if isinstance(kind, (T.StringType, T.BinaryType)) else "1970-01-01"
    dated = isinstance(kind, (T.StringType, T.BinaryType, T.DateType, T.TimestampType))
    return (F.lit(text) if dated else F.lit(0)).cast(kind)
