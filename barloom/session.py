"""Session for command-line runs; a cluster's own settings win."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from barloom.operators import skew

_PARTITIONS = "spark.sql.shuffle.partitions"

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target size of shuffle reads, and so of the files a rebalanced write produces.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def get_session(app: str = "barloom", **settings: str) -> SparkSession:
    """The running session, or a new one with the defaults that nobody has set."""
    spark = SparkSession.builder.appName(app).getOrCreate()
    given = dict(spark.sparkContext.getConf().getAll())
    for name, value in _DEFAULTS.items():
        if name not in given:
            spark.conf.set(name, value)
    for name, value in settings.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """For a write of about ``rows``: as many shuffle partitions as they call for, or more.

    With the session's number the memory of a task would grow with the table. Unlike rows
    that are dealt out to a given number of tasks, these partitions can still be split or
    combined by adaptive execution.
    """
    before = spark.conf.get(_PARTITIONS)
    spark.conf.set(_PARTITIONS, max(int(before), math.ceil(rows / skew.TASK_ROWS)))
    try:
        yield
    finally:
        spark.conf.set(_PARTITIONS, before)
