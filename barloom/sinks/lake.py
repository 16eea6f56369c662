"""File sinks: raw landing, partitioned tables, clean CSV."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from barloom.functions.headers import clean_headers

OVERWRITE_ALL = "static"
OVERWRITE_TOUCHED = "dynamic"


def raw_path(lake: str, table: str) -> str:
    return f"{lake.rstrip('/')}/raw/{table}"


def transformed_path(lake: str, table: str) -> str:
    return f"{lake.rstrip('/')}/transformed/{table}"


def write_raw(df: DataFrame, lake: str, table: str) -> str:
    """Land ``df`` as Parquet under clean headers; returns the directory."""
    path = raw_path(lake, table)
    clean_headers(df).write.mode("overwrite").parquet(path)
    return path


def clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition directory together, splitting big ones.

    Without it each task of a table shuffled by ticker would write a small file into
    every directory. The rebalance splits a directory that holds much of the data.
    """
    return df.hint("rebalance", *keys)


def write_partitioned(
    df: DataFrame, path: str, keys: Sequence[str], overwrite: str = OVERWRITE_ALL
) -> str:
    """Parquet partitioned by ``keys``; ``dynamic`` replaces only partitions in ``df``."""
    writer = clustered(df, keys).write.mode("overwrite").partitionBy(*keys)
    writer.option("partitionOverwriteMode", overwrite).parquet(path)
    return path


def export_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """CSV files with one clean header line each."""
    writer = clean_headers(df).write.mode("overwrite").option("header", True)
    writer.option("sep", sep).csv(path)
    return path


def write_version(df: DataFrame, path: str, keep: int = 1) -> str:
    """Write ``df`` as the newest version below ``path``; ``keep`` earlier ones stay.

    A version counts once it is whole, so ``df`` may read the one before.
    """
    spark = df.sparkSession
    version = f"{path.rstrip('/')}/v{time.time_ns():020d}"
    df.write.parquet(version)
    for old in whole_versions(spark, path)[: -1 - keep]:
        target = spark._jvm.org.apache.hadoop.fs.Path(old)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return version


def latest_version(spark: SparkSession, path: str) -> str | None:
    found = whole_versions(spark, path)
    return found[-1] if found else None


def whole_versions(spark: SparkSession, path: str) -> list[str]:
    """The versions below ``path`` whose write has ended, oldest first."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "v*/_SUCCESS")) or []
    return sorted(mark.getPath().getParent().toString() for mark in marks)
