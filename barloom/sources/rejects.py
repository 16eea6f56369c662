"""Deliveries whose unreadable cells and rows are kept beside the typed rows.

A delivery is read as text once. The typed rows and the rejects are two views of that
text, so that what one of them lacks is in the other.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import schemas
from barloom.functions.headers import check_unique, clean_header, has_column
from barloom.functions.projection import project
from barloom.sources import files

# Layout and reasons of rejects.
REJECTS = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("table", "file", "column", "value", "reason", "record")]
)
OTHER_FIELDS = "other number of fields"

_MALFORMED = "_malformed"
_FILE = "_file"


@dataclass(frozen=True)
class Delivery:
    """Typed ``rows``, NULL where a text cannot be read, and the ``rejects``.

    ``rejects`` has a row per cell that is not blank and not of its declared type, and one
    per row with more or fewer fields than the header: the ``table``, the ``file``, the
    ``column`` (NULL for a whole row), the ``value`` as delivered, the ``reason`` and the
    ``record``, which is the fields of the row.
    """

    rows: DataFrame
    rejects: DataFrame


def read_text(spark: SparkSession, path: str, sep: str = files.SEPARATOR) -> DataFrame:
    """A CSV with header as strings under clean names, with its file and malformed rows."""
    reader = spark.read.option("header", True).option("sep", sep)
    header = reader.csv(path).columns  # reads one line
    names = [clean_header(c) for c in header]
    check_unique(names)
    fields = [T.StructField(c, T.StringType()) for c in (*header, _MALFORMED)]
    # A pruned row would be parsed in part, and its number of fields would not be seen.
    text = (
        reader.schema(T.StructType(fields))
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("columnNameOfCorruptRecord", _MALFORMED)
        .csv(path)
    )
    return text.withColumn(_FILE, F.col("_metadata.file_path")).toDF(*names, _MALFORMED, _FILE)


def split_text(
    text: DataFrame,
    table: str,
    schema: T.StructType,
    date_format: str = files.DATE_FORMAT,
    sep: str = files.SEPARATOR,
    keep_all: bool = True,
) -> Delivery:
    """Typed rows and rejects of what :func:`read_text` gave; both read ``text``."""
    declared = {f.name.lower(): f for f in schema.fields}
    names = [c for c in text.columns if c not in (_MALFORMED, _FILE)]
    found = {c: declared[c.lower()] for c in names if c.lower() in declared}
    typed = {c: _typed(c, f.dataType, date_format) for c, f in found.items()}
    rows = text.select(*[typed.get(c, F.col(c)).alias(c) for c in names])
    extra = [c for c in names if c.lower() not in declared] if keep_all else []

    cells = [
        F.when(
            (F.trim(F.col(c)) != "") & typed[c].isNull(),
            _reject(F.lit(f.name), F.col(c), f"not a {f.dataType.simpleString()}"),
        )
        for c, f in found.items()
        if not isinstance(f.dataType, T.StringType)
    ]
    whole = F.when(
        F.col(_MALFORMED).isNotNull(), _reject(F.lit(None).cast("string"), F.col(_MALFORMED), OTHER_FIELDS)
    )
    record = F.concat_ws(sep, *[F.coalesce(F.col(c), F.lit("")) for c in names])
    rejects = text.select(
        F.lit(table).alias("table"),
        F.col(_FILE).alias("file"),
        F.explode(F.array_compact(F.array(whole, *cells))).alias("reject"),
        record.alias("record"),
    ).select("table", "file", "reject.column", "reject.value", "reject.reason", "record")
    return Delivery(project(rows, schema, extra), rejects)


def _typed(column: str, kind: T.DataType, date_format: str) -> Column:
    """The cell in its type, NULL where it is blank or cannot be read."""
    if isinstance(kind, T.StringType):
        return F.col(column)
    if isinstance(kind, T.DateType):
        return F.try_to_timestamp(F.trim(column), F.lit(date_format)).cast("date")
    return F.trim(column).try_cast(kind)


def _reject(column: Column, value: Column, reason: str) -> Column:
    return F.struct(column.alias("column"), value.alias("value"), F.lit(reason).alias("reason"))


def deliver_statement(
    spark: SparkSession,
    root: str,
    table: str,
    variant: str = files.VARIANT_STATEMENTS,
    market: str = files.MARKET,
    stage: str | None = None,
    **options,
) -> Delivery:
    """One of the statements, as :func:`~barloom.sources.files.read_statement`, with rejects.

    With ``stage``, a folder, the text is written there as Parquet and parsed only once.
    """
    if table not in schemas.STATEMENTS:
        raise ValueError(f"unknown statement {table!r}; one of {list(schemas.STATEMENTS)}")
    path = files.delivery_path(root, table, variant, market)
    return _deliver(spark, path, table, schemas.STATEMENTS[table], stage, options)


def deliver_prices(
    spark: SparkSession,
    root: str,
    variant: str = files.VARIANT_PRICES,
    market: str = files.MARKET,
    stage: str | None = None,
    **options,
) -> Delivery:
    """Daily prices, as :func:`~barloom.sources.files.read_prices`, with rejects.

    ``Date`` stays text in the rows: ISO where it is a date, else as delivered, and then a
    reject too.
    """
    path = files.delivery_path(root, "shareprices", variant, market)
    text = _text(spark, path, stage, options)
    found = split_text(text, "prices", schemas.PRICES, **options)
    if not has_column(text, "Date"):
        return Delivery(found.rows.withColumn("Date", F.col("Date").cast("string")), found.rejects)
    iso = _typed("Date", T.DateType(), options.get("date_format", files.DATE_FORMAT)).cast("string")
    dated = text.withColumn("Date", F.coalesce(iso, F.col("Date")))
    kept = split_text(dated, "prices", schemas.PRICES_RAW, **options)
    return Delivery(kept.rows, found.rejects)


def _deliver(spark, path: str, table: str, schema: T.StructType, stage: str | None, options: dict) -> Delivery:
    return split_text(_text(spark, path, stage, options), table, schema, **options)


def _text(spark: SparkSession, path: str, stage: str | None, options: dict) -> DataFrame:
    text = read_text(spark, path, options.get("sep", files.SEPARATOR))
    if stage is None:
        return text
    text.write.parquet(stage)
    return spark.read.schema(text.schema).parquet(stage)


def all_rejects(deliveries: Mapping[str, Delivery]) -> DataFrame:
    return reduce(DataFrame.unionByName, [d.rejects for d in deliveries.values()])


def reject_counts(rejects: DataFrame) -> DataFrame:
    """``table``, ``column``, ``reason`` and ``count``; combined before the shuffle."""
    return rejects.groupBy("table", "column", "reason").agg(F.count("*").alias("count"))
