"""Column names and types of every table the library reads or serves."""

from __future__ import annotations

from pyspark.sql import types as T

# The table layouts, in natural column order.
STATEMENT_KEYS = ("Ticker", "Report_Date")
PRICE_KEYS = ("Ticker", "Date")


_TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
}


def _schema(text: str) -> T.StructType:
    """A schema from ``"name type, name type"``, without needing a session."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


INCOME = _schema(
    "Ticker string, Report_Date date, Revenue double, Net_Income double, "
    "Pretax_Income_Loss_Adj double"
)
BALANCE = _schema(
    "Ticker string, Report_Date date, Short_Term_Debt double, Long_Term_Debt double, "
    "Total_Current_Assets double, Total_Current_Liabilities double, "
    "Total_Equity double, Total_Assets double"
)
CASHFLOW = _schema(
    "Ticker string, Report_Date date, Net_Cash_from_Operating_Activities double"
)
PRICES = _schema(
    "Ticker string, Date date, Open double, High double, Low double, Close double, "
    "Adj_Close double, Volume bigint"
)
# As delivered and landed: dates that cannot be read are kept as text.
PRICES_RAW = T.StructType(
    [T.StructField(f.name, T.StringType()) if f.name == "Date" else f for f in PRICES.fields]
)
COMPANIES = _schema("Ticker string, Company_Name string")

STATEMENTS = {"income": INCOME, "balance": BALANCE, "cashflow": CASHFLOW}

# The columns the warehouse keeps of the enriched tables ("partial schema").
FUNDAMENTALS_EXTERNAL = _schema(
    "Ticker string, Company_Name string, Revenue double, Net_Income double, "
    "Pretax_Income_Loss_Adj double, Profit_Margin double, ROE double, ROA double, "
    "Debt_to_Equity double, Current_Ratio double"
)
PRICES_EXTERNAL = _schema(
    "Ticker string, Date string, Open double, High double, Low double, Close double, "
    "Adj_Close double, Volume bigint, Volume_Millions double, Daily_Return double"
)
STOCK_FUNDAMENTALS = T.StructType(
    FUNDAMENTALS_EXTERNAL.fields + _schema("Year bigint").fields
)
STOCK_PRICES = T.StructType(
    PRICES.fields
    + _schema("Volume_Millions double, Daily_Return double, Year bigint, Month bigint").fields
)
