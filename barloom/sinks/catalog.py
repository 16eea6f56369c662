"""Catalog objects: databases, external tables, saved tables, views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barloom.sinks.lake import clustered

KEYS_AS_STRINGS = "STRINGS"
KEYS_TYPED = "AUTO"


def quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database unless it exists; ``location`` must be shared storage."""
    place = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{place}")


def register_external(
    spark: SparkSession,
    name: str,
    path: str,
    keys: Sequence[str],
    schema: T.StructType | None = None,
    key_typing: str = KEYS_AS_STRINGS,
) -> DataFrame:
    """(Re)create table ``name`` over partitioned Parquet at ``path``.

    Without ``schema`` the columns are taken from the files. Partition keys are
    declared last, as strings or in the types that their directory names suggest, so no
    session setting is changed. Dropping the old table leaves its files alone.
    """
    if key_typing not in (KEYS_AS_STRINGS, KEYS_TYPED):
        raise ValueError(f"unknown key typing {key_typing!r}")
    lower = {k.lower() for k in keys}
    found = spark.read.parquet(path).schema
    columns = schema if schema is not None else found
    inferred = {f.name.lower(): _key_type(f.dataType) for f in found.fields if f.name.lower() in lower}
    fields = [f for f in columns.fields if f.name.lower() not in lower]
    typed = key_typing == KEYS_TYPED
    fields += [T.StructField(k, inferred[k.lower()] if typed else T.StringType()) for k in keys]
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    drop_table(spark, name)
    spark.sql(
        f"CREATE TABLE {quoted(name)} ({ddl}) USING parquet "
        f"PARTITIONED BY ({', '.join(quoted(k) for k in keys)}) LOCATION {_text(path)}"
    )
    spark.sql(f"ALTER TABLE {quoted(name)} RECOVER PARTITIONS")
    return spark.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quoted(name)}")


def _key_type(kind: T.DataType) -> T.DataType:
    """Whole numbers are long whatever their size, so that new directories fit."""
    return T.LongType() if isinstance(kind, T.IntegerType) else kind


def save_table(
    df: DataFrame, name: str, keys: Sequence[str] = ("Year",), cluster: bool = True
) -> DataFrame:
    """Replace table ``name`` by the rows of ``df``, partitioned by ``keys``.

    Without ``cluster`` rows are written where they are read, which suits a source that
    lies in directories of the same keys.
    """
    (clustered(df, keys) if cluster else df).write.mode("overwrite").format("parquet").partitionBy(
        *keys
    ).saveAsTable(quoted(name))
    return df.sparkSession.table(name)


def create_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Create or replace a catalog view on a SQL query over saved tables.

    A view that exists is altered: replacing it would drop it first, and readers could
    find none.
    """
    exists = spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"
    verb = "ALTER VIEW" if exists else "CREATE OR REPLACE VIEW"
    spark.sql(f"{verb} {quoted(name)} AS {query}")
    return spark.table(name)


def row_count(spark: SparkSession, name: str) -> int:
    return spark.table(name).count()


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
