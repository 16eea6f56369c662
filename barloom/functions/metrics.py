"""Financial metrics as column expressions.

All of them are built-in JVM expressions, so they stay inside whole-stage codegen.
A zero or NULL denominator gives NULL in ANSI mode too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Fraction; NULL where the denominator is 0 or either side is NULL."""
    return F.try_divide(_col(numerator), _col(denominator))


def percent(numerator: str | Column, denominator: str | Column) -> Column:
    return F.lit(100.0) * ratio(numerator, denominator)


def total_debt(
    short_term: str = "Short_Term_Debt", long_term: str = "Long_Term_Debt"
) -> Column:
    """Sum of both debts; a missing one counts as zero."""
    zero = F.lit(0.0)
    return F.coalesce(F.col(short_term), zero) + F.coalesce(F.col(long_term), zero)


def net_margin(income: str = "Net_Income", revenue: str = "Revenue") -> Column:
    """Fraction of revenue kept as income."""
    return ratio(income, revenue)


def profit_margin(income: str = "Net_Income", revenue: str = "Revenue") -> Column:
    """:func:`net_margin` in percent."""
    return percent(income, revenue)


def current_ratio(
    assets: str = "Total_Current_Assets", liabilities: str = "Total_Current_Liabilities"
) -> Column:
    return ratio(assets, liabilities)


def debt_to_equity(debt: str = "Total_Debt", equity: str = "Total_Equity") -> Column:
    return ratio(debt, equity)


def return_on_equity(income: str = "Net_Income", equity: str = "Total_Equity") -> Column:
    """Percent."""
    return percent(income, equity)


def return_on_assets(income: str = "Net_Income", assets: str = "Total_Assets") -> Column:
    """Percent."""
    return percent(income, assets)


def volume_millions(volume: str = "Volume") -> Column:
    return F.col(volume) / F.lit(1e6)


def simple_return(current: str | Column, previous: str | Column) -> Column:
    """Fraction; NULL after a previous value of 0 or NULL."""
    return ratio(current, previous) - F.lit(1.0)


def calendar_year(date: str) -> Column:
    return F.year(F.col(date).try_cast("date")).cast("long")


def calendar_month(date: str) -> Column:
    return F.month(F.col(date).try_cast("date")).cast("long")


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
