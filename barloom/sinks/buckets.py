"""Tables that lie by key, so that work by key needs no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from barloom.sinks.catalog import quoted

_ORDERED_SCANS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def save_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], order: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Replace table ``name`` by the rows of ``df`` in buckets by ``keys``.

    Each bucket is one file, sorted by ``keys`` and then ``order``: the rows are shuffled
    by the same hash that numbers the buckets. ``buckets`` is the session's number of
    shuffle partitions unless given. Tables that are to be joined need equal numbers.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = df.repartition(buckets, *keys)
    writer = laid.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys)
    writer.sortBy(*keys, *order).saveAsTable(quoted(name))
    return spark.table(name)


def trust_order(spark: SparkSession) -> None:
    """Let scans of buckets that are one sorted file each count as sorted.

    A setting of the session. Spark itself checks that no bucket has a second file.
    """
    spark.conf.set(_ORDERED_SCANS, "true")
