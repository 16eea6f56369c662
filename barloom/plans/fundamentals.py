"""Company fundamentals: ratios and the served table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom import schemas
from barloom.functions import metrics
from barloom.functions.headers import clean_headers, has_column
from barloom.functions.projection import project
from barloom.operators.lookup import attach_company


def enrich_fundamentals(raw: DataFrame, companies: DataFrame | None = None) -> DataFrame:
    """Raw merged statements with all ratios, the company name and the calendar year.

    Scan, project, write: no shuffle unless a company table has to be joined.
    ``net_margin`` is a fraction; ``Profit_Margin``, ``ROE`` and ``ROA`` are percent.
    """
    df = clean_headers(raw)
    income = "Net_Income"
    roa = (
        metrics.return_on_assets()
        if has_column(df, "Total_Assets")
        else F.lit(None).cast("double")
    )
    enriched = df.withColumn("Total_Debt", metrics.total_debt()).withColumns(
        {
            "net_margin": metrics.net_margin(income),
            "Profit_Margin": metrics.profit_margin(income),
            "Current_Ratio": metrics.current_ratio(),
            "Debt_to_Equity": metrics.debt_to_equity(),
            "ROE": metrics.return_on_equity(income),
            "ROA": roa,
            "Year": metrics.calendar_year("Report_Date"),
        }
    )
    return attach_company(enriched, companies)


def stock_fundamentals(enriched: DataFrame) -> DataFrame:
    """The served columns of the rows that report revenue."""
    return project(enriched, schemas.STOCK_FUNDAMENTALS).where(F.col("Revenue").isNotNull())
