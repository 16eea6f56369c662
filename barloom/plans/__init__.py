"""Composite tables, reports and the batch pipeline."""

from barloom.plans.fundamentals import enrich_fundamentals, stock_fundamentals
from barloom.plans.incremental import add_prices
from barloom.plans.metadata import (
    latest_partition,
    stored_latest_year,
    stored_row_counts,
    stored_top_performers,
)
from barloom.plans.pipeline import (
    create_views,
    extract,
    load,
    run_pipeline,
    run_transform,
)
from barloom.plans.prices import (
    daily_return,
    enrich_prices,
    enrich_saved_prices,
    moving_average,
    save_prices,
    stock_prices,
)
from barloom.plans.quality import quality_summary, rejected_dates
from barloom.plans.reports import (
    annual_company_metrics,
    latest_year,
    monthly_price_stats,
    newest_first,
    ticker_score,
    top_performers,
)
from barloom.plans.rollups import Rollup, refresh, report, stored_quality
from barloom.plans.statements import merge_saved_statements, merge_statements, save_statements

__all__ = [
    "Rollup",
    "add_prices",
    "annual_company_metrics",
    "create_views",
    "daily_return",
    "enrich_fundamentals",
    "enrich_prices",
    "enrich_saved_prices",
    "extract",
    "latest_partition",
    "latest_year",
    "load",
    "merge_saved_statements",
    "merge_statements",
    "monthly_price_stats",
    "moving_average",
    "newest_first",
    "quality_summary",
    "refresh",
    "rejected_dates",
    "report",
    "run_pipeline",
    "run_transform",
    "save_prices",
    "save_statements",
    "stock_fundamentals",
    "stock_prices",
    "stored_latest_year",
    "stored_quality",
    "stored_row_counts",
    "stored_top_performers",
    "ticker_score",
    "top_performers",
]
