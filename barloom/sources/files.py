"""Readers for delivered CSV files and for Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import schemas
from barloom.functions.headers import check_unique, clean_header, clean_headers, has_column
from barloom.functions.projection import project

# Defaults of a delivery.
VARIANT_STATEMENTS = "annual"
VARIANT_PRICES = "daily"
MARKET = "us"
SEPARATOR = ";"
DATE_FORMAT = "yyyy-MM-dd"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    date_format: str = DATE_FORMAT,
    sep: str = SEPARATOR,
    keep_all: bool = True,
) -> DataFrame:
    """Read a CSV with header, matching columns to ``schema`` by cleaned name.

    The header decides the order of columns; a text that does not parse becomes NULL,
    and so does a declared column that the file lacks. Undeclared columns follow as
    strings; without ``keep_all`` they are dropped.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    header = reader.csv(path).columns  # reads one line
    declared = {f.name.lower(): f for f in schema.fields}
    names = [clean_header(c) for c in header]
    check_unique(names)
    fields = [
        T.StructField(raw, declared[n.lower()].dataType if n.lower() in declared else T.StringType())
        for raw, n in zip(header, names)
    ]
    typed = (
        reader.schema(T.StructType(fields))
        .option("enforceSchema", False)
        .option("dateFormat", date_format)
        .csv(path)
        .toDF(*names)
    )
    extra = [n for n in names if n.lower() not in declared] if keep_all else []
    return project(typed, schema, extra)


def delivery_path(root: str, table: str, variant: str, market: str) -> str:
    return f"{root.rstrip('/')}/{market}-{table}-{variant}.csv"


def read_statement(
    spark: SparkSession,
    root: str,
    table: str,
    variant: str = VARIANT_STATEMENTS,
    market: str = MARKET,
    **csv_options,
) -> DataFrame:
    """One of the statements ``income``, ``balance`` and ``cashflow``."""
    if table not in schemas.STATEMENTS:
        raise ValueError(f"unknown statement {table!r}; one of {list(schemas.STATEMENTS)}")
    path = delivery_path(root, table, variant, market)
    return read_csv(spark, path, schemas.STATEMENTS[table], **csv_options)


def read_income(spark: SparkSession, root: str, **options) -> DataFrame:
    return read_statement(spark, root, "income", **options)


def read_balance(spark: SparkSession, root: str, **options) -> DataFrame:
    return read_statement(spark, root, "balance", **options)


def read_cashflow(spark: SparkSession, root: str, **options) -> DataFrame:
    return read_statement(spark, root, "cashflow", **options)


def read_prices(
    spark: SparkSession,
    root: str,
    variant: str = VARIANT_PRICES,
    market: str = MARKET,
    **csv_options,
) -> DataFrame:
    """Daily prices. ``Date`` stays text: ISO where it is a date, else as delivered.

    A date that cannot be read is then still there to be counted when it is served.
    """
    path = delivery_path(root, "shareprices", variant, market)
    prices = read_csv(spark, path, schemas.PRICES_RAW, **csv_options)
    read = F.try_to_timestamp("Date", F.lit(csv_options.get("date_format", DATE_FORMAT)))
    return prices.withColumn("Date", F.coalesce(read.cast("date").cast("string"), "Date"))


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Parquet files, directories or globs under clean headers.

    With ``schema`` only its columns, found by cleaned name, in its types; a column that
    the files lack is NULL, but a file without any of them is refused, and so is one
    without one of ``keys``. One footer stands for all files; see
    :func:`~barloom.sources.drift.read_drifting` for files that differ.
    """
    found = clean_headers(spark.read.parquet(path))
    lacking = [k for k in keys if not has_column(found, k)]
    if lacking:
        raise ValueError(f"{path} lacks the keys {lacking}")
    if schema is None:
        return found
    if not any(has_column(found, f.name) for f in schema.fields):
        raise ValueError(f"{path} has none of the declared columns {schema.fieldNames()}")
    return project(found, schema)
