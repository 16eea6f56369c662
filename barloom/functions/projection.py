"""Projection on a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project(df: DataFrame, schema: T.StructType, extra: Sequence[str] = ()) -> DataFrame:
    """The declared columns in declared order and type, then ``extra`` ones.

    A missing column is NULL, and a value that does not fit its type becomes NULL. A
    column that has its type already is passed on as it is, so filters on it still
    reach the scan.
    """
    present = {f.name.lower(): f for f in df.schema.fields}
    columns = []
    for field in schema.fields:
        have = present.get(field.name.lower())
        if have is None:
            column = F.lit(None).cast(field.dataType)
        elif have.dataType == field.dataType:
            column = F.col(have.name)
        else:
            column = F.col(have.name).try_cast(field.dataType)
        columns.append(column.alias(field.name))
    return df.select(*columns, *extra)
