"""Header cleaning: raw vendor headers to names every engine accepts."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame

_OUTSIDE = re.compile(r"[^0-9A-Za-z]+")


def clean_header(name: str) -> str:
    """``"Pretax Income (Loss), Adj."`` becomes ``"Pretax_Income_Loss_Adj"``."""
    cleaned = _OUTSIDE.sub("_", str(name)).strip("_")
    if not cleaned:
        raise ValueError(f"header {name!r} has no letter or digit")
    return cleaned


def check_unique(names: list[str]) -> None:
    """Raise if two names are equal without regard to case, as Spark compares them."""
    counts = Counter(n.lower() for n in names)
    twice = [n for n in names if counts[n.lower()] > 1]
    if twice:
        raise ValueError(f"column names collide: {sorted(twice)}")


def clean_headers(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`clean_header`; metadata only, no data is touched."""
    names = [clean_header(c) for c in df.columns]
    check_unique(names)
    return df if names == df.columns else df.toDF(*names)


def has_column(df: DataFrame, name: str) -> bool:
    return name.lower() in (c.lower() for c in df.columns)
