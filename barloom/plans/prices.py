"""Daily prices: moving average, returns and the served table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from barloom import schemas
from barloom.functions import metrics
from barloom.functions.headers import clean_headers
from barloom.functions.projection import project
from barloom.operators.history import Measures, over_history
from barloom.operators.saved import over_saved_history, save_history
from barloom.operators.skew import HOT_ROWS

SMA_ROWS = 20


def _average(window: WindowSpec, value: str, n: int) -> Column:
    return F.avg(value).over(window.rowsBetween(1 - n, 0))


def _return(window: WindowSpec, value: str) -> Column:
    return metrics.simple_return(value, F.lag(value, 1).over(window))


def moving_average(
    df: DataFrame, n: int = SMA_ROWS, value: str = "Close", name: str | None = None, **options
) -> DataFrame:
    """Mean of the last ``n`` rows (not days) per ticker; fewer at the start.

    NULL values are skipped but use up a row of the frame.
    """
    _check_rows(n)
    name = name or f"SMA_{n}"
    return over_history(
        df, lambda w: {name: _average(w, value, n)}, depth=max(n - 1, 1), reads=[value], **options
    )


def daily_return(
    df: DataFrame, value: str = "Close", name: str = "Daily_Return", **options
) -> DataFrame:
    """Simple return on the previous row, as a fraction; NULL after 0 or NULL."""
    return over_history(df, lambda w: {name: _return(w, value)}, depth=1, reads=[value], **options)


def enrich_prices(raw: DataFrame, n: int = SMA_ROWS, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Raw prices with moving average, return, volume in millions, year and month.

    Both windows run over all raw rows in one pass; invalid closes are dropped only
    later, in :func:`stock_prices`, because dropping them first would change both.
    """
    _check_rows(n)
    df = clean_headers(raw)
    return dated(over_history(df, price_windows(n), depth=max(n - 1, 1), hot_rows=hot_rows))


def save_prices(raw: DataFrame, name: str, buckets: int | None = None, hot_rows: int | None = HOT_ROWS) -> None:
    """Save raw prices by ticker, sorted by date, for :func:`enrich_saved_prices`."""
    save_history(clean_headers(raw), name, buckets=buckets, hot_rows=hot_rows)


def enrich_saved_prices(
    spark: SparkSession, name: str, n: int = SMA_ROWS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """:func:`enrich_prices` of saved prices, which moves and sorts nothing."""
    _check_rows(n)
    windows = over_saved_history(spark, name, price_windows(n), max(n - 1, 1), hot_rows=hot_rows)
    return dated(windows)


def price_windows(n: int) -> Measures:
    """Moving average and return, as measures of one window."""
    return lambda w: {f"SMA_{n}": _average(w, "Close", n), "Daily_Return": _return(w, "Close")}


def dated(windows: DataFrame) -> DataFrame:
    """Rows with both measures, and the columns that need no other row."""
    return windows.withColumns(
        {
            "Volume_Millions": metrics.volume_millions(),
            "Year": metrics.calendar_year("Date"),
            "Month": metrics.calendar_month("Date"),
        }
    )


def stock_prices(enriched: DataFrame) -> DataFrame:
    """The served columns of the rows with a positive close; ``Date`` may be text."""
    return project(enriched, schemas.STOCK_PRICES).where(F.col("Close") > 0)


def _check_rows(n: int) -> None:
    if n < 1:
        raise ValueError("a moving average needs at least one row")
