"""Parquet deliveries whose files do not all have the same columns.

Vendors rename headers, add and drop columns, and change number types from one file to the
next. Files are grouped by the schema in their footer; each group is read with its own
schema, brought under clean headers and widened to common types, and the groups are stacked.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.headers import clean_header, clean_headers

#: Footers that are read at the same time.
FOOTERS = 16

# Types that widen into later ones of the same row.
_LADDERS = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()),
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.FloatType(), T.DoubleType()),
    (T.DateType(), T.TimestampType()),
)


def read_drifting(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """All Parquet files at ``path``, a directory or a glob, as one table.

    Columns are matched by cleaned name, without regard to case, and a column that a file
    lacks is NULL in its rows. With ``schema`` its columns come in its types; otherwise
    all columns come in the least type that holds every file's. Numbers widen (to double,
    where some file has doubles), dates become timestamps, and anything but nested values
    becomes text where a text is declared or met. A file that lacks one of ``keys``, or
    whose type does not fit the declared one, is refused by name: a key of NULLs or a cut
    number would pass for data.

    The footers are read by one small job per file, ``FOOTERS`` at a time. Keys in the
    names of directories are found below a ``path`` that is a directory.
    """
    groups = [
        (files, clean_headers(_reader(spark, path).schema(found).parquet(*files)))
        for found, files in footers(spark, path)
    ]
    wanted = schema or common_schema([df.schema for _, df in groups])
    for files, df in groups:
        _check(df.schema, wanted, keys, files)
    return reduce(DataFrame.unionByName, [_fitted(df, wanted) for _, df in groups])


def _reader(spark: SparkSession, path: str) -> DataFrameReader:
    single = path.endswith(".parquet") or any(c in path for c in "*?[{")
    return spark.read if single else spark.read.option("basePath", path)


def footers(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """Files at ``path`` by the schema in their footer, schemas of most columns first."""
    files = sorted(spark.read.parquet(path).inputFiles())
    with ThreadPoolExecutor(FOOTERS) as pool:
        found = list(pool.map(lambda f: _reader(spark, path).parquet(f).schema, files))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for file, schema in zip(files, found):
        groups.setdefault(schema.json(), (schema, []))[1].append(file)
    return [groups[k] for k in sorted(groups, key=lambda k: (-len(groups[k][0].fields), k))]


def common_schema(schemas: Sequence[T.StructType]) -> T.StructType:
    """The columns of all schemas, in order of appearance, each in its least common type.

    Of several spellings that differ in case the first in order of code points is taken.
    """
    found: dict[str, T.StructField] = {}
    for field in (f for s in schemas for f in s.fields):
        known = found.get(field.name.lower())
        kind = field.dataType if known is None else wider(known.dataType, field.dataType)
        name = field.name if known is None else min(known.name, field.name)
        found[field.name.lower()] = T.StructField(name, kind)
    return T.StructType(list(found.values()))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds both; text if there is no other."""
    if a == b:
        return a
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        return _wider_decimal(a, b)
    for ladder in _LADDERS:
        if a in ladder and b in ladder:
            return max(a, b, key=ladder.index)
    numbers = [kind for ladder in _LADDERS if T.DoubleType() in ladder for kind in ladder]
    return T.DoubleType() if a in numbers and b in numbers else T.StringType()


def _wider_decimal(a: T.DataType, b: T.DataType) -> T.DataType:
    digits = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
    sizes = []
    for kind in (a, b):
        if isinstance(kind, T.DecimalType):
            sizes.append((kind.precision - kind.scale, kind.scale))
        elif kind in digits:
            sizes.append((digits[kind], 0))
        else:
            return T.DoubleType() if isinstance(kind, (T.FloatType, T.DoubleType)) else T.StringType()
    whole, scale = max(s[0] for s in sizes), max(s[1] for s in sizes)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def _fits(kind: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of ``kind`` has a place in ``wanted``; decimals may end in doubles."""
    if isinstance(wanted, T.StringType):
        return not isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.BinaryType))
    if isinstance(kind, T.DecimalType) and wanted == T.DoubleType():
        return True
    return wider(kind, wanted) == wanted


def _check(found: T.StructType, wanted: T.StructType, keys: Sequence[str], files: list[str]) -> None:
    kinds = {f.name.lower(): f.dataType for f in found.fields}
    lacking = [k for k in keys if clean_header(k).lower() not in kinds]
    if lacking:
        raise ValueError(f"{files[0]} and {len(files) - 1} files like it lack the keys {lacking}")
    narrow = [
        f"{f.name}: {kinds[f.name.lower()].simpleString()} to {f.dataType.simpleString()}"
        for f in wanted.fields
        if f.name.lower() in kinds and not _fits(kinds[f.name.lower()], f.dataType)
    ]
    if narrow:
        raise ValueError(f"{files[0]} and {len(files) - 1} files like it do not fit: {narrow}")


def _fitted(df: DataFrame, wanted: T.StructType) -> DataFrame:
    names = {c.lower(): c for c in df.columns}

    def column(field: T.StructField) -> Column:
        own = names.get(field.name.lower())
        value = F.lit(None) if own is None else F.col(own)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in wanted.fields])
