"""Tables that lie in the order in which they are shown.

The rows are dealt to files by ranges of the whole sort order, and sorted inside each file.
A small index lists the files in order, with their number of rows and the least and greatest
value of the first column. The head of the table, or a range of it, then comes from a few
files, and inside them from a few row groups, whose statistics are as narrow.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.sinks.lake import latest_version, write_version

#: Bytes of a row group: small, so that a head reads little of its file.
ROW_GROUP = 8 << 20

_FILE = "file"


def save_ordered(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    files: int | None = None,
    row_group: int = ROW_GROUP,
) -> str:
    """Write ``df`` below ``path`` in ``order``: names of columns, with ``" desc"`` for descending.

    Descending columns have their NULLs last, ascending ones first, as Spark sorts. Rows
    that are equal in all of ``order`` share a file. ``files`` is the session's number of
    shuffle partitions unless given; the index has a row for each. A new index replaces
    the one before in one step; data of earlier writes stay until their owner clears them.
    """
    spark = df.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = _sort(order)
    data = f"{path.rstrip('/')}/data/v{time.time_ns():020d}"
    laid = df.repartitionByRange(files, *sort).sortWithinPartitions(*sort)
    laid.write.option("parquet.block.size", row_group).parquet(data)
    first = F.col(_name(order[0]))
    index = (
        spark.read.schema(df.schema)
        .parquet(data)
        .groupBy(F.col("_metadata.file_path").alias(_FILE))
        .agg(F.count("*").alias("rows"), F.min(first).alias("least"), F.max(first).alias("most"), F.count_if(first.isNull()).alias("nulls"))
    )
    # Of all columns only names and types are needed to read an empty table.
    described = index.withColumns({"order": F.lit(",".join(order)), "ddl": F.lit(_ddl(df))})
    nothing = spark.createDataFrame([(",".join(order), _ddl(df))], "order string, ddl string")
    write_version(described.unionByName(nothing, allowMissingColumns=True).coalesce(1), f"{path.rstrip('/')}/index")
    return path


def ordered_head(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The first ``n`` rows, in order; reads only the files that hold them."""
    listed, order, ddl = _index(spark, path)
    chosen, held = [], 0
    for row in listed:
        if held >= n:
            break
        chosen.append(row[_FILE])
        held += row["rows"]
    return _read(spark, chosen, ddl).orderBy(*_sort(order)).limit(n)


def ordered_between(spark: SparkSession, path: str, low=None, high=None) -> DataFrame:
    """Rows whose first sort column is at least ``low`` and at most ``high``.

    Only files that have such values are read. NULLs are in no range.
    """
    listed, order, ddl = _index(spark, path)
    chosen = [
        row[_FILE]
        for row in listed
        if row["most"] is not None
        and (low is None or row["most"] >= low)
        and (high is None or row["least"] <= high)
    ]
    first = F.col(_name(order[0]))
    within = first.isNotNull()
    if low is not None:
        within &= first >= low
    if high is not None:
        within &= first <= high
    return _read(spark, chosen, ddl).where(within)


def _index(spark: SparkSession, path: str) -> tuple[list, list[str], str]:
    """Rows of the index in the order of the table, one per file; its order and schema."""
    found = latest_version(spark, f"{path.rstrip('/')}/index")
    if found is None:
        raise ValueError(f"{path} holds no ordered table")
    rows = spark.read.parquet(found).collect()
    # Tasks number their files, so names stand in the order of the ranges.
    listed = sorted((r for r in rows if r[_FILE] is not None), key=lambda r: r[_FILE].rsplit("/", 1)[1])
    return listed, rows[0]["order"].split(","), rows[0]["ddl"]


def _read(spark: SparkSession, files: list[str], ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(*files) if files else spark.createDataFrame([], ddl)


def _name(column: str) -> str:
    return column.removesuffix(" desc")


def _sort(order: Sequence[str]) -> list[Column]:
    return [F.desc(_name(c)) if c.endswith(" desc") else F.asc(c) for c in order]


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
