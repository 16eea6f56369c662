"""Tables that are replaced in one step, with the earlier rows readable until then and after.

A table is a view on its current version. A new version is a table of its own, in a folder
of its own, and is written whole before anyone can see it. Then the view is altered, which
is a single change of its catalog entry: a reader resolves either the old version or the
new one. The version before stays, so that readers who have started can finish.
"""

from __future__ import annotations

import re
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from barloom.scratch import path_exists
from barloom.sinks.catalog import create_view, quoted
from barloom.sinks.lake import clustered

_MARK = "__v"


def replace_table(
    df: DataFrame, name: str, keys: Sequence[str] = ("Year",), cluster: bool = True, keep: int = 1
) -> DataFrame:
    """Replace ``name`` by the rows of ``df``, partitioned by ``keys``, in one catalog change.

    ``keep`` earlier versions stay, older ones are dropped with their files. A failed write
    changes nothing for readers. ``name`` must be free or made by this function: a plain
    table of that name could not be switched without a gap. Without ``cluster`` rows are
    written where they are read, as in :func:`~barloom.sinks.catalog.save_table`.
    """
    spark = df.sparkSession
    _check_name(spark, name)
    earlier = versions(spark, name)
    database, table = _split(spark, name)
    version = f"{table}{_MARK}{time.time_ns():020d}"
    root = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    # The first version lies where a plain table of this name would.
    path = f"{root}/{version if earlier or path_exists(spark, f'{root}/{table}') else table}"
    writer = (clustered(df, keys) if cluster else df).write.format("parquet").option("path", path)
    try:
        writer.partitionBy(*keys).saveAsTable(quoted(f"{database}.{version}"))
    except Exception:
        _delete(spark, path)
        raise
    create_view(spark, name, f"SELECT * FROM {quoted(f'{database}.{version}')}")
    for old in earlier[: max(len(earlier) - keep, 0)]:
        drop_version(spark, old)
    return spark.table(name)


def versions(spark: SparkSession, name: str) -> list[str]:
    """The versions of ``name``, oldest first."""
    database, table = _split(spark, name)
    start = f"{table}{_MARK}".lower()
    found = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return [f"{database}.{t}" for t in sorted(found) if t.lower().startswith(start)]


def current_version(spark: SparkSession, name: str) -> str:
    """The version that ``name`` shows now, or ``name`` itself if it is a plain table."""
    if spark.catalog.getTable(name).tableType != "VIEW":
        return name
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").where("col_name = 'View Text'")
    text = details.first()["data_type"]
    shown = re.fullmatch(r"SELECT \* FROM `(\w+)`\.`(\w+)`", text)
    if shown is None:
        raise ValueError(f"{name} is a view that does not show a version: {text}")
    return ".".join(shown.groups())


def drop_version(spark: SparkSession, version: str) -> None:
    """Drop a version and its files."""
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(version)}")
    path = details.where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE {quoted(version)}")
    _delete(spark, path)


def _check_name(spark: SparkSession, name: str) -> None:
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        raise ValueError(f"{name} is a plain table; drop or rename it once to have versions of it")


def _split(spark: SparkSession, name: str) -> tuple[str, str]:
    database, _, table = name.rpartition(".")
    return database or spark.catalog.currentDatabase(), table


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
