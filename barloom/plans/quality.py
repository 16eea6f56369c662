"""Data-quality counts of the served tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.sources.rejects import reject_counts

# Names of the checks.
FUNDAMENTALS_ROWS = "Fundamentals row count"
PRICES_ROWS = "Prices row count"
FUNDAMENTALS_TICKERS = "Unique tickers in fundamentals"
PRICES_TICKERS = "Unique tickers in prices"
REJECTED_DATES = "Rejected price dates"


def quality_summary(
    fundamentals: DataFrame,
    prices: DataFrame,
    prices_external: DataFrame | None = None,
    approximate: bool = False,
    rejects: DataFrame | None = None,
) -> DataFrame:
    """One row ``(check, count)`` per check, from one pass over each table.

    ``approximate`` replaces the exact distinct counts by sketches. With
    ``prices_external`` the dates that are present but no dates are counted too. With
    ``rejects`` of a delivery there is one more check per table, column and reason found.
    """
    checks = [
        _counts(fundamentals, FUNDAMENTALS_ROWS, FUNDAMENTALS_TICKERS, approximate),
        _counts(prices, PRICES_ROWS, PRICES_TICKERS, approximate),
    ]
    summary = checks[0].unionByName(checks[1])
    if prices_external is not None:
        summary = summary.unionByName(rejected_dates(prices_external))
    if rejects is not None:
        summary = summary.unionByName(rejected_cells(rejects))
    return summary


def rejected_cells(rejects: DataFrame) -> DataFrame:
    """A check ``Rejected <table>.<column>: <reason>`` for all that was rejected."""
    place = F.concat_ws(".", "table", "column")
    name = F.concat(F.lit("Rejected "), place, F.lit(": "), "reason")
    return reject_counts(rejects).select(name.alias("check"), "count")


def rejected_dates(prices_external: DataFrame) -> DataFrame:
    date = F.col("Date")
    lost = date.isNotNull() & date.try_cast("date").isNull()
    return prices_external.agg(F.count_if(lost).alias("count")).select(
        F.lit(REJECTED_DATES).alias("check"), "count"
    )


def _counts(df: DataFrame, rows: str, tickers: str, approximate: bool) -> DataFrame:
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    totals = df.agg(F.count("*").alias("rows"), distinct("Ticker").alias("tickers"))
    return totals.select(
        F.inline(
            F.array(
                F.struct(F.lit(rows).alias("check"), F.col("rows").alias("count")),
                F.struct(F.lit(tickers).alias("check"), F.col("tickers").alias("count")),
            )
        )
    )
