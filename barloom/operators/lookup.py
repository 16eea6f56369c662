"""Company names as an optional dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.headers import has_column


def attach_company(
    df: DataFrame, companies: DataFrame | None, key: str = "Ticker", name: str = "Company_Name"
) -> DataFrame:
    """Left join of the company name; NULL where it is unknown or no table is given.

    A name that ``df`` has already, in whatever case, is kept if no table is given. Of
    several names of one ticker the first in order is taken, so no fact is multiplied.

    There is no broadcast hint, because the dimension grows with the data: Spark
    broadcasts it only while it measures below its own threshold, and splits a skewed
    ``key`` of ``df`` at run time otherwise.
    """
    if companies is None:
        return df if has_column(df, name) else df.withColumn(name, F.lit(None).cast("string"))
    # Grouped with a hash, so that the join deals the names out itself: a side whose
    # partitioning it could reuse would keep Spark from splitting a skewed key.
    names = companies.groupBy(F.xxhash64(key).alias("_hash"), key).agg(F.min(name).alias(name))
    return df.drop(name).join(names.drop("_hash"), key, "left")
