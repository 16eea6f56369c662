"""The whole batch job: extract, transform, load.

Phases hand over through Parquet, so a run can be repeated from any phase and a
lost executor never reaches further back than the last table written.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schemas
from barloom.plans import reports
from barloom.plans.fundamentals import enrich_fundamentals, stock_fundamentals
from barloom.plans.prices import SMA_ROWS, enrich_prices, stock_prices
from barloom.plans.quality import quality_summary
from barloom.plans.statements import merge_statements
from barloom.scratch import path_exists, scratch_dir
from barloom.session import sized
from barloom.sinks import catalog, lake as lake_sink
from barloom.sinks.versions import replace_table
from barloom.sources import files
from barloom.sources.rejects import REJECTS, Delivery, all_rejects, deliver_prices, deliver_statement

# Names of tables and modes.
FUNDAMENTALS = "fundamentals"
PRICES = "prices"
REJECTED = "rejects"
PARTITION_KEYS = {FUNDAMENTALS: ("Year",), PRICES: ("Year", "Month")}


@dataclass(frozen=True)
class Loaded:
    """Names of the catalog objects of a load, and its quality counts."""

    fundamentals: str
    prices: str
    views: tuple[str, ...]
    quality: DataFrame


def stage(spark: SparkSession, lake: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Land delivered tables as Parquet under ``raw`` and read them back.

    The merge looks at its inputs more than once (skew, keys, rows), mostly at the
    keys only. Staging makes that a column scan; text would be parsed each time.
    """
    return {
        name: files.read_parquet(spark, lake_sink.write_raw(df, lake, name))
        for name, df in tables.items()
    }


def extract(
    lake: str,
    income: DataFrame,
    balance: DataFrame,
    cashflow: DataFrame,
    prices: DataFrame,
    rejects: DataFrame | None = None,
    **merge_options,
) -> None:
    """Stage the statements, merge them, and land both raw tables and the rejects."""
    if rejects is None:
        rejects = income.sparkSession.createDataFrame([], REJECTS)
    lake_sink.write_raw(rejects, lake, REJECTED)
    delivered = {"income": income, "balance": balance, "cashflow": cashflow}
    staged = stage(income.sparkSession, lake, delivered)
    merged = merge_statements(**staged, **merge_options)
    lake_sink.write_raw(merged, lake, FUNDAMENTALS)
    lake_sink.write_raw(prices, lake, PRICES)


def extract_deliveries(lake: str, deliveries: Mapping[str, Delivery], **merge_options) -> None:
    """:func:`extract` of ``income``, ``balance``, ``cashflow`` and ``prices`` with their rejects."""
    rows = {name: d.rows for name, d in deliveries.items()}
    extract(lake, **rows, rejects=all_rejects(deliveries), **merge_options)


def deliveries(spark: SparkSession, root: str, **options) -> dict[str, Delivery]:
    """The four tables delivered below ``root``; their text is parsed once, into scratch."""
    staged = scratch_dir(spark, "delivered")
    found = {
        name: deliver_statement(spark, root, name, stage=f"{staged}/{name}", **options)
        for name in schemas.STATEMENTS
    }
    return {**found, PRICES: deliver_prices(spark, root, stage=f"{staged}/{PRICES}", **options)}


def run_transform(
    spark: SparkSession,
    lake: str,
    mode: str,
    companies: DataFrame | None = None,
    n: int = SMA_ROWS,
    overwrite: str = lake_sink.OVERWRITE_ALL,
) -> str:
    """Enrich one raw table, ``fundamentals`` or ``prices``, and write it partitioned."""
    if mode not in PARTITION_KEYS:
        raise ValueError(f"unknown mode {mode!r}; one of {list(PARTITION_KEYS)}")
    raw = files.read_parquet(spark, lake_sink.raw_path(lake, mode))
    if mode == FUNDAMENTALS:
        enriched = enrich_fundamentals(raw, companies)
    else:
        # Text, as the external table declares it: what is no date stays visible.
        enriched = enrich_prices(raw, n).withColumn("Date", F.col("Date").cast("string"))
    path = lake_sink.transformed_path(lake, mode)
    # The join of the company names and the directories move all rows; footers count them.
    moved = [raw, companies] if mode == FUNDAMENTALS and companies is not None else [raw]
    with sized(spark, sum(df.count() for df in moved)):
        return lake_sink.write_partitioned(enriched, path, PARTITION_KEYS[mode], overwrite)


def load(
    spark: SparkSession,
    lake: str,
    database: str,
    location: str | None = None,
    key_typing: str = catalog.KEYS_AS_STRINGS,
) -> Loaded:
    """Register the transformed files, replace the served tables, create the views.

    Readers of the served tables and views see the rows of the last load or of this one
    at any time.
    """
    catalog.create_database(spark, database, location)
    external = {
        table: catalog.register_external(
            spark,
            f"{database}.stock_{table}_external",
            lake_sink.transformed_path(lake, table),
            PARTITION_KEYS[table],
            schema,
            key_typing,
        )
        for table, schema in (
            (FUNDAMENTALS, schemas.FUNDAMENTALS_EXTERNAL),
            (PRICES, schemas.PRICES_EXTERNAL),
        )
    }
    fundamentals = f"{database}.stock_fundamentals"
    prices = f"{database}.stock_prices"
    # The external tables lie in directories by year already: nothing has to move.
    replace_table(stock_fundamentals(external[FUNDAMENTALS]), fundamentals, cluster=False)
    replace_table(stock_prices(external[PRICES]), prices, cluster=False)
    views = create_views(spark, database, fundamentals, prices)
    rejects = lake_sink.raw_path(lake, REJECTED)
    quality = quality_summary(
        spark.table(fundamentals),
        spark.table(prices),
        external[PRICES],
        rejects=spark.read.parquet(rejects) if path_exists(spark, rejects) else None,
    )
    return Loaded(fundamentals, prices, views, quality)


def create_views(
    spark: SparkSession, database: str, fundamentals: str, prices: str
) -> tuple[str, ...]:
    """Create or replace the three report views in ``database``."""
    queries = {
        "annual_company_metrics": reports.annual_company_metrics_sql(fundamentals),
        "monthly_price_stats": reports.monthly_price_stats_sql(prices),
        "top_performers": reports.top_performers_sql(fundamentals),
    }
    for name, query in queries.items():
        catalog.create_view(spark, f"{database}.{name}", query)
    return tuple(f"{database}.{name}" for name in queries)


def run_pipeline(
    spark: SparkSession,
    lake: str,
    database: str,
    income: DataFrame,
    balance: DataFrame,
    cashflow: DataFrame,
    prices: DataFrame,
    companies: DataFrame | None = None,
    location: str | None = None,
    rejects: DataFrame | None = None,
    **merge_options,
) -> Loaded:
    """Extract, transform and load in one Spark application."""
    extract(lake, income, balance, cashflow, prices, rejects, **merge_options)
    run_transform(spark, lake, FUNDAMENTALS, companies)
    run_transform(spark, lake, PRICES)
    return load(spark, lake, database, location)
