"""Analytical results over the served tables.

Each report exists as a DataFrame function and as SQL text for a catalog view; both
are built from the same measures. Reports carry no ORDER BY, which would cost every
reader a sort: use :func:`newest_first` where rows are shown.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.headers import has_column
from barloom.operators.ranking import percent_ranks
from barloom.sinks.catalog import quoted

# Names and defaults of the reports.
ANNUAL_KEYS = ("Ticker", "Company_Name", "Year")
ANNUAL_METRICS = (
    "Revenue",
    "Net_Income",
    "Profit_Margin",
    "ROE",
    "ROA",
    "Debt_to_Equity",
    "Current_Ratio",
)
MONTHLY_KEYS = ("Ticker", "Year", "Month")
MONTHLY_MEASURES = {
    "Trading_Days": "count(*)",
    "Avg_Close_Price": "avg(Close)",
    "Month_Low": "min(Low)",
    "Month_High": "max(High)",
    "Total_Volume_Millions": "sum(Volume_Millions)",
    "Avg_Daily_Return": "avg(Daily_Return)",
}
# Newest year (and month) first, then by ticker, as ``newest_first`` sorts.
ANNUAL_ORDER = ("Year desc", "Ticker")
MONTHLY_ORDER = ("Year desc", "Month desc", "Ticker")
PERFORMER_COLUMNS = (
    "Ticker",
    "Company_Name",
    "Year",
    "Revenue",
    "Net_Income",
    "Profit_Margin",
    "ROE",
    "ROA",
)
MIN_REVENUE = 1_000_000_000
MIN_MARGIN = 10
TOP_ROWS = 50

ANNUAL_MEASURES = {f"Avg_{m}": f"avg({m})" for m in ANNUAL_METRICS}


def annual_company_metrics(fundamentals: DataFrame) -> DataFrame:
    """Mean of each metric per ticker, company name and year."""
    return _grouped(fundamentals, ANNUAL_KEYS, ANNUAL_MEASURES)


def monthly_price_stats(prices: DataFrame) -> DataFrame:
    """Trading days, mean close, low, high, volume and mean return per ticker and month."""
    return _grouped(prices, MONTHLY_KEYS, MONTHLY_MEASURES)


def latest_year(fundamentals: DataFrame) -> DataFrame:
    return fundamentals.agg(F.max("Year").alias("max_year"))


def top_performers(
    fundamentals: DataFrame,
    min_revenue: float = MIN_REVENUE,
    min_margin: float = MIN_MARGIN,
    n: int = TOP_ROWS,
) -> DataFrame:
    """The ``n`` companies with most revenue among the profitable ones of the last year.

    The last year is a scalar subquery, so on a table partitioned by ``Year`` only
    that partition is read. Equal revenues are ordered by ticker.
    """
    return (
        fundamentals.where(
            (F.col("Year") == latest_year(fundamentals).scalar())
            & (F.col("Revenue") > min_revenue)
            & (F.col("Profit_Margin") > min_margin)
        )
        .select(*PERFORMER_COLUMNS)
        .orderBy(F.desc("Revenue"), F.asc("Ticker"))
        .limit(n)
    )


def newest_first(report: DataFrame) -> DataFrame:
    """Newest year (and month) first, then by ticker."""
    periods = [c for c in ("Year", "Month") if has_column(report, c)]
    return report.orderBy(*[F.desc(c) for c in periods], F.asc("Ticker"))


def ticker_score(
    fundamentals: DataFrame, years: tuple[int, int] | None = None, **options
) -> DataFrame:
    """Mean percent rank, within a year, of return on equity and current ratio.

    Rows lacking either metric have no score. ``years`` keeps an inclusive range.
    """
    df = fundamentals.select("Ticker", "Company_Name", "Year", "ROE", "Current_Ratio")
    if years is not None:
        df = df.where(F.col("Year").between(*years))
    ranked = percent_ranks(
        df, "Year", {"ROE": "ROE_Rank", "Current_Ratio": "Current_Ratio_Rank"}, **options
    )
    score = (F.col("ROE_Rank") + F.col("Current_Ratio_Rank")) / F.lit(2.0)
    return ranked.withColumn("Score", score)


def annual_company_metrics_sql(fundamentals: str) -> str:
    return _grouped_sql(fundamentals, ANNUAL_KEYS, ANNUAL_MEASURES)


def monthly_price_stats_sql(prices: str) -> str:
    return _grouped_sql(prices, MONTHLY_KEYS, MONTHLY_MEASURES)


def top_performers_sql(
    fundamentals: str,
    min_revenue: float = MIN_REVENUE,
    min_margin: float = MIN_MARGIN,
    n: int = TOP_ROWS,
) -> str:
    table = quoted(fundamentals)
    return (
        f"SELECT {', '.join(PERFORMER_COLUMNS)} FROM {table} "
        f"WHERE Year = (SELECT max(Year) FROM {table}) "
        f"AND Revenue > {min_revenue} AND Profit_Margin > {min_margin} "
        f"ORDER BY Revenue DESC, Ticker ASC LIMIT {n}"
    )


def _grouped(df: DataFrame, keys: tuple[str, ...], measures: dict[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.expr(e).alias(name) for name, e in measures.items()])


def _grouped_sql(table: str, keys: tuple[str, ...], measures: dict[str, str]) -> str:
    columns = [*keys, *(f"{e} AS {name}" for name, e in measures.items())]
    return (
        f"SELECT {', '.join(columns)} FROM {quoted(table)} GROUP BY {', '.join(keys)}"
    )
