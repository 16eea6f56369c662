"""Finding the few keys that are too big for one task.

A key is hot when it has more than ``hot_rows`` rows, whatever the size of its table.
The ``MOST_KEYS`` largest of a table are treated as such, so they fit on the driver
and in a broadcast; should there be more, those beyond have each less than
``1 / MOST_KEYS`` of the rows. They are counted by a small job when an operator is
built: usually none is found, and the operator needs no provision for skew at all.
Which keys are found only changes how work is spread, never a result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 1_000_000
MOST_KEYS = 10_000
# Rows that a task sorts: with a fixed number of tasks their memory would grow with the table.
TASK_ROWS = 250_000
# Sketches: keys are dealt to classes by hash, and each class tracks so many of its keys.
_CLASSES = 64
_TRACKED = 4_096
_REPORTED = 1_024

TABLE = "_table"
PARTS = "_parts"


def hot_keys(
    tables: Mapping[str, DataFrame], keys: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> DataFrame | None:
    """The hot keys as ``(_table, *keys, _parts)``, or None if there is none.

    ``hot_rows`` None says that no key is hot, and saves the job that looks for them.

    ``_parts`` is the number of tasks a key is worth. Counting every key would shuffle
    all of them when most are unique. So each task first sketches its rows: per class of
    hashes a bounded list of the most frequent keys, which is merged by class. A key with
    more than ``hot_rows`` rows that is also more than 1/600 of its class (about 1/37,000
    of a table without very big keys) is surely listed; smaller ones are far below a
    task's share of such a table. Exact counts are made of the listed keys only. What is
    collected are at most 65,536 candidates and ``MOST_KEYS`` keys per table.
    """
    return hot_keys_and_rows(tables, keys, hot_rows)[0]


def hot_keys_and_rows(
    tables: Mapping[str, DataFrame], keys: Sequence[str], hot_rows: int | None = HOT_ROWS
) -> tuple[DataFrame | None, int]:
    """:func:`hot_keys`, and the rows of all tables, which the same job counts.

    Without the job, 0.
    """
    if hot_rows is None:
        return None, 0
    keys = list(keys)
    slim = reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(name).alias(TABLE), F.xxhash64(*keys).alias("_hash"), *keys)
            for name, df in tables.items()
        ],
    )
    frequent = F.col("_n") > hot_rows
    found = _candidates(slim).where(frequent | (F.col("_at") == 0)).select("*", frequent.alias("_frequent")).collect()
    total = sum(row["_rows"] for row in found if row["_at"] == 0)
    big = [row for row in found if row["_frequent"]]
    if not big:
        return None, total
    spark = slim.sparkSession
    listed = spark.createDataFrame([(row[TABLE], row["_hash"]) for row in big], f"{TABLE} string, _hash long")
    counted = _counted(slim.join(F.broadcast(listed), [TABLE, "_hash"]), [TABLE, *keys])
    hot = counted.where(F.col("_n") > hot_rows).select(
        TABLE, *keys, F.ceil(F.col("_n") / F.lit(max(hot_rows, 1))).cast("int").alias(PARTS)
    )
    rows = []
    for name in tables:
        rows += hot.where(F.col(TABLE) == name).orderBy(F.desc(PARTS)).limit(MOST_KEYS).collect()
    return (spark.createDataFrame(rows, _nullable(hot.schema)) if rows else None), total


def spread(df: DataFrame, rows: int, keys: Sequence[str], enough: int | None = None) -> DataFrame:
    """``df``, whose size is about ``rows``, dealt out by ``keys`` to tasks of ``TASK_ROWS`` rows.

    Where those tasks are no more than ``enough``, which is the cores at hand unless given,
    Spark's own number will do.
    """
    tasks = math.ceil(rows / TASK_ROWS)
    if enough is None:
        enough = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks, *keys) if tasks > enough else df


def mark_hot(
    df: DataFrame, hot: DataFrame, keys: Sequence[str], how: str = "left"
) -> DataFrame:
    """Add the columns of ``hot`` to ``df``; NULL keys match each other."""
    names = {k: f"_hot_{k}" for k in keys}
    small = F.broadcast(hot.withColumnsRenamed(names))
    match = [F.col(k).eqNullSafe(F.col(h)) for k, h in names.items()]
    return df.join(small, match, how).drop(*names.values())


def _candidates(slim: DataFrame) -> DataFrame:
    """``(_table, _hash, _n)`` of frequent keys; ``_n`` is never less than the true count.

    ``_at`` is the place of a key in the list of its class, from 0, and ``_rows`` the number
    of rows of the class. A class whose keys are all rare has one row, without a key.
    """
    number = F.pmod("_hash", F.lit(_CLASSES)).cast("int").alias("_class")
    sketch = F.expr(f"approx_top_k(_hash, {_REPORTED}, {_TRACKED})").alias("_top")
    tops = slim.select(TABLE, number, "_hash").groupBy(TABLE, "_class").agg(sketch, F.count("*").alias("_rows"))
    found = tops.select(TABLE, "_rows", F.posexplode_outer("_top").alias("_at", "_t"))
    at = F.coalesce("_at", F.lit(0)).alias("_at")
    return found.select(TABLE, F.col("_t.item").alias("_hash"), F.col("_t.count").alias("_n"), at, "_rows")


def _counted(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("_n"))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
