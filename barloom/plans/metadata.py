"""Answers that need no data column: from the catalog's partitions and from file footers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.plans.reports import MIN_MARGIN, MIN_REVENUE, PERFORMER_COLUMNS, TOP_ROWS
from barloom.sinks.catalog import quoted
from barloom.sinks.versions import current_version


def latest_partition(spark: SparkSession, name: str, key: str = "Year") -> int | None:
    """The greatest ``key`` of the partitions of table ``name`` that have rows.

    The catalog lists the partitions; a calendar's worth of values comes to the driver.
    Only footers of the newest partitions are opened, until one has a row. NULL, which is
    no year, is passed over; None means that no other partition has rows.
    """
    table = current_version(spark, name)
    # Keys are spelled ``a=1/b=2``; the default partition is that of NULL.
    value = F.regexp_extract("partition", rf"(?i)(?:^|/){key}=([^/]+)", 1).try_cast("long")
    listed = spark.sql(f"SHOW PARTITIONS {quoted(table)}").select(value.alias("v"))
    values = sorted((r.v for r in listed.distinct().where("v is not null").collect()), reverse=True)
    return next((v for v in values if not spark.table(table).where(F.col(key) == v).isEmpty()), None)


def stored_latest_year(spark: SparkSession, name: str) -> DataFrame:
    """:func:`~barloom.plans.reports.latest_year` of a saved table, from its partitions."""
    return spark.createDataFrame([(latest_partition(spark, name),)], "max_year long")


def stored_top_performers(
    spark: SparkSession,
    name: str,
    min_revenue: float = MIN_REVENUE,
    min_margin: float = MIN_MARGIN,
    n: int = TOP_ROWS,
) -> DataFrame:
    """:func:`~barloom.plans.reports.top_performers` of a saved table.

    The last year is known before the query is planned, so its partition alone is listed
    and read.
    """
    year = latest_partition(spark, name)
    its = F.lit(False) if year is None else F.col("Year") == year
    return (
        spark.table(name)
        .where(its & (F.col("Revenue") > min_revenue) & (F.col("Profit_Margin") > min_margin))
        .select(*PERFORMER_COLUMNS)
        .orderBy(F.desc("Revenue"), F.asc("Ticker"))
        .limit(n)
    )


def stored_row_counts(spark: SparkSession, checks: Mapping[str, str]) -> DataFrame:
    """One row ``(check, count)`` per check and table, from the footers of the files."""
    parts = [
        spark.table(name).agg(F.count("*").alias("count")).select(F.lit(check).alias("check"), "count")
        for check, name in checks.items()
    ]
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total
