"""Registered queries: one per operator, over the driver's tables."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import barloom  # noqa: E402
import oracle_queries  # noqa: E402
from barloom import schemas  # noqa: E402
from barloom.functions import metrics  # noqa: E402
from barloom.operators import attach_company  # noqa: E402
from barloom.plans import rollups  # noqa: E402
from barloom.sinks import (  # noqa: E402
    catalog,
    lake,
    ordered_between,
    ordered_head,
    replace_table,
    save_ordered,
    scratch_dir,
)
from barloom.sources import Delivery, all_rejects, deliver_prices, files, read_drifting  # noqa: E402
from derived_inputs import landed  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# Vendor spelling of the headers, where cleaning changes it.
RAW_HEADERS = {
    "Report_Date": "Report Date",
    "Net_Income": "Net Income",
    "Pretax_Income_Loss_Adj": "Pretax Income (Loss), Adj.",
    "Short_Term_Debt": "Short Term Debt",
    "Long_Term_Debt": "Long Term Debt",
    "Total_Current_Assets": "Total Current Assets",
    "Total_Current_Liabilities": "Total Current Liabilities",
    "Total_Equity": "Total Equity",
    "Total_Assets": "Total Assets",
    "Net_Cash_from_Operating_Activities": "Net Cash from Operating Activities",
    "Adj_Close": "Adj. Close",
}
DELIVERED_DATES = "dd/MM/yyyy"
STATEMENTS = ("income", "balance", "cashflow")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.round(c, 6) for c in df.columns if c in oracle_queries.ROUNDED}
    )


def _statements(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [landed(spark, sf_dir, name) for name in STATEMENTS]


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = landed(spark, sf_dir, "companies")
    return barloom.enrich_fundamentals(landed(spark, sf_dir, "merged"), companies)


def _fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barloom.stock_fundamentals(_enriched(spark, sf_dir))


def _windows(spark: SparkSession, sf_dir: str, prices: str = "prices") -> DataFrame:
    return barloom.enrich_prices(landed(spark, sf_dir, prices))


def _average(spark: SparkSession, sf_dir: str, prices: str = "prices") -> DataFrame:
    closes = landed(spark, sf_dir, prices).select("Ticker", "Date", "Close")
    return _rounded(barloom.moving_average(closes))


def _monthly_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = barloom.stock_prices(_windows(spark, sf_dir, "part_prices"))
    return _rounded(barloom.monthly_price_stats(served))


def _prices_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _windows(spark, sf_dir).withColumn("Date", F.col("Date").cast("string"))


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barloom.stock_prices(_prices_external(spark, sf_dir))


def _metric(name: str) -> Query:
    """One ratio of the merged statements under its usual column name."""
    columns = {
        "total_debt": {"Total_Debt": metrics.total_debt},
        "net_margin": {"net_margin": metrics.net_margin},
        "current_ratio": {"Current_Ratio": metrics.current_ratio},
        "debt_to_equity": {
            "Debt_to_Equity": lambda: metrics.ratio(metrics.total_debt(), "Total_Equity")
        },
        "return_ratios": {
            "Profit_Margin": metrics.profit_margin,
            "ROE": metrics.return_on_equity,
            "ROA": metrics.return_on_assets,
        },
    }[name]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        merged = landed(spark, sf_dir, "merged")
        return merged.select(
            "Ticker", "Report_Date", *[make().alias(c) for c, make in columns.items()]
        )

    return query


def _raw_headers(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in RAW_HEADERS.items() if k in df.columns})


def _company_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = landed(spark, sf_dir, "merged")
    named = attach_company(merged, landed(spark, sf_dir, "companies"))
    return named.select(
        "Ticker", "Report_Date", "Company_Name", metrics.calendar_year("Report_Date").alias("Year")
    )


def _raw_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw_headers(landed(spark, sf_dir, "prices"))
    path = lake.write_raw(raw, scratch_dir(spark, "lake"), "prices")
    return files.read_parquet(spark, f"{path}/*.parquet", schemas.PRICES)


def _raw_headers_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet under the vendor's own headers, read with the declared schema."""
    path = scratch_dir(spark, "vendor")
    _raw_headers(landed(spark, sf_dir, "prices")).write.parquet(path)
    return files.read_parquet(spark, path, schemas.PRICES)


def _deliver(df: DataFrame, root: str, table: str, variant: str) -> None:
    """Write ``df`` as a vendor would: raw headers, semicolons, other date format."""
    path = files.delivery_path(root, table, variant, files.MARKET)
    writer = _raw_headers(df).write.option("header", True).option("sep", files.SEPARATOR)
    writer.option("dateFormat", DELIVERED_DATES).csv(path)


def _csv_source_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "delivery")
    _deliver(landed(spark, sf_dir, "prices"), root, "shareprices", files.VARIANT_PRICES)
    read = files.read_prices(spark, root, date_format=DELIVERED_DATES)
    return read.withColumn("Date", F.col("Date").try_cast("date"))


def _quality_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a whole run whose price delivery has dates that are none."""
    prices = landed(spark, sf_dir, "prices")
    text = F.date_format("Date", DELIVERED_DATES)
    bad = F.concat(F.lit("no "), text)
    root = scratch_dir(spark, "delivery")
    delivered = prices.withColumn("Date", F.when(F.col("Volume") % 23 == 0, bad).otherwise(text))
    _deliver(delivered, root, "shareprices", files.VARIANT_PRICES)
    read = files.read_prices(spark, root, date_format=DELIVERED_DATES)
    return _run_pipeline(spark, sf_dir, read).quality


def _malformed(df: DataFrame) -> DataFrame:
    """Prices as text, some of whose dates, closes and volumes are none; some opens are blank."""
    lots = F.col("Volume")
    date = F.date_format("Date", DELIVERED_DATES)
    return df.withColumns(
        {
            "Date": F.when(lots % 23 == 0, F.concat(F.lit("no "), date)).otherwise(date),
            "Open": F.when(lots % 7 != 0, F.col("Open").cast("string")),
            "Close": F.when(lots % 13 == 0, F.concat(F.lit("n/a "), lots)).otherwise(F.col("Close").cast("string")),
            "Volume": F.when(lots % 11 == 0, F.concat(lots, F.lit(" pcs"))).otherwise(lots.cast("string")),
        }
    )


def _malformed_prices(spark: SparkSession, sf_dir: str) -> Delivery:
    root = scratch_dir(spark, "delivery")
    _deliver(_malformed(landed(spark, sf_dir, "prices")), root, "shareprices", files.VARIANT_PRICES)
    stage = scratch_dir(spark, "delivered")
    return deliver_prices(spark, root, date_format=DELIVERED_DATES, stage=stage)


def _csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _malformed_prices(spark, sf_dir).rejects.select("table", "column", "value", "reason")


def _csv_rejects_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _malformed_prices(spark, sf_dir).rows.withColumnRenamed("Date", "Delivered_Date")
    return rows.withColumn("Volume", F.col("Volume").cast("double"))


def _pipeline_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of a run over deliveries with malformed numbers and dates."""
    root = scratch_dir(spark, "delivery")
    number = F.substring("Ticker", 2, 12).cast("long")
    for name, df in zip(STATEMENTS, _statements(spark, sf_dir)):
        if name == "income":
            unknown = F.when(number % 9 == 0, "unknown").otherwise(F.col("Revenue").cast("string"))
            df = df.withColumn("Revenue", unknown)
        _deliver(df, root, name, files.VARIANT_STATEMENTS)
    prices = _malformed(landed(spark, sf_dir, "prices"))
    _deliver(prices, root, "shareprices", files.VARIANT_PRICES)
    found = barloom.plans.pipeline.deliveries(spark, root, date_format=DELIVERED_DATES)
    location = scratch_dir(spark, "warehouse")
    loaded = barloom.run_pipeline(
        spark,
        scratch_dir(spark, "lake"),
        "scratch_" + location.rsplit("-", 1)[1],
        **{name: d.rows for name, d in found.items()},
        location=location,
        rejects=all_rejects(found),
    )
    return loaded.quality


def _all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements with a column that no schema declares, and that they share."""
    root = scratch_dir(spark, "delivery")
    delivered = {}
    for name, df in zip(STATEMENTS, _statements(spark, sf_dir)):
        shared = df.withColumn("Fiscal Year", F.year("Report_Date"))
        _deliver(shared, root, name, files.VARIANT_STATEMENTS)
        delivered[name] = files.read_statement(spark, root, name, date_format=DELIVERED_DATES)
    staged = barloom.plans.pipeline.stage(spark, scratch_dir(spark, "lake"), delivered)
    return barloom.merge_statements(**staged)


def _enrich_saved(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    name = f"{_scratch_database(spark)}.prices"
    barloom.save_prices(landed(spark, sf_dir, "prices"), name, **options)
    return _rounded(barloom.enrich_saved_prices(spark, name, **options))


def _merge_saved(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The merge of statements with NULL and repeated keys that lie alike."""
    database = _scratch_database(spark)
    barloom.save_statements(*_statements_repeated(spark, sf_dir), database=database, **options)
    return barloom.merge_saved_statements(spark, database, **options)


def _repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barloom.merge_statements(*_statements_repeated(spark, sf_dir))


def _incremental_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries, the last of which is late, and the second of which comes twice."""
    prices = landed(spark, sf_dir, "prices")
    lake_dir = scratch_dir(spark, "lake")
    is_late = F.col("Volume") % 10 == 3
    early = F.col("Date") < "1998-06-20"
    second = prices.where(~early & ~is_late)
    for delivery in (prices.where(early & ~is_late), second, prices.where(is_late), second):
        path = barloom.add_prices(spark, lake_dir, delivery)
    back = spark.read.parquet(path).withColumn("Date", F.col("Date").cast("date"))
    return _rounded(back.withColumns({k: F.col(k).cast("long") for k in ("Year", "Month")}))


def _served_by_month(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = lake.write_partitioned(df, scratch_dir(spark, "lake"), ["Year", "Month"])
    return spark.read.parquet(path)


def _monthly_states(spark: SparkSession, sf_dir: str) -> str:
    """States of prices that were served in two parts, the second of which corrects the first."""
    served = _prices(spark, sf_dir)
    path = scratch_dir(spark, "states")
    wrong = served.where("Year <= 1996").withColumn("Low", F.when(F.col("Year") < 1996, F.col("Low")))
    rollups.refresh(rollups.MONTHLY, _served_by_month(spark, wrong), path)
    whole = _served_by_month(spark, served)
    months = whole.where("Year >= 1996").select("Year", "Month").distinct().collect()
    return rollups.refresh(rollups.MONTHLY, whole, path, [tuple(m) for m in months])


def _annual_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    served = _fundamentals(spark, sf_dir)
    path = lake.write_partitioned(served, scratch_dir(spark, "lake"), ["Year"])
    states = scratch_dir(spark, "states")
    rollups.refresh(rollups.ANNUAL, served.where("Year < 1998"), states)
    table = spark.read.parquet(path)
    years = [tuple(y) for y in table.where("Year >= 1998").select("Year").distinct().collect()]
    rollups.refresh(rollups.ANNUAL, table, states, years)
    return _rounded(barloom.report(spark, rollups.ANNUAL, states))


def _yearly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States by month, merged at the coarser key."""
    states = _monthly_states(spark, sf_dir)
    return _rounded(barloom.report(spark, rollups.MONTHLY, states, ["Ticker", "Year"]))


def _stored_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks from stored counts; estimates are compared with exact numbers."""
    fundamentals, prices = _fundamentals(spark, sf_dir), _prices(spark, sf_dir)
    stored = barloom.stored_quality(
        spark,
        rollups.refresh(rollups.FUNDAMENTALS_COUNTS, fundamentals, scratch_dir(spark, "states")),
        rollups.refresh(rollups.PRICES_COUNTS, prices, scratch_dir(spark, "states")),
    )
    exact = barloom.quality_summary(fundamentals, prices).withColumnRenamed("count", "exact")
    near = F.abs(F.col("count") - F.col("exact")) <= F.ceil(rollups.SKETCH_ERROR * F.col("exact"))
    return stored.join(exact, "check").select("check", F.col("exact").alias("count"), near.alias("near"))


def _saved_fundamentals(spark: SparkSession, sf_dir: str) -> str:
    name = f"{_scratch_database(spark)}.stock_fundamentals"
    replace_table(_fundamentals(spark, sf_dir), name)
    return name


def _stored_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fundamentals = _saved_fundamentals(spark, sf_dir)
    prices = fundamentals.replace("stock_fundamentals", "stock_prices")
    replace_table(_prices(spark, sf_dir), prices)
    checks = {"Fundamentals row count": fundamentals, "Prices row count": prices}
    return barloom.stored_row_counts(spark, checks)


def _registered_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table whose files, columns and partitions change between registrations."""
    database = _scratch_database(spark)
    path = scratch_dir(spark, "lake")
    keys = ["Year", "Month"]
    whole = _prices_external(spark, sf_dir)
    for df in (whole.where("Year <= 1996").drop("SMA_20").withColumn("Extra", F.lit(1)), whole):
        lake.write_partitioned(df, path, keys)
        table = catalog.register_external(
            spark, f"{database}.stock_prices_external", path, keys, None, catalog.KEYS_TYPED
        )
        table.count()
    return _rounded(table.withColumn("Date", F.col("Date").try_cast("date")))


def _drifting(spark: SparkSession, sf_dir: str) -> str:
    """Prices of three vendors' versions: other headers, other types, other columns."""
    prices = landed(spark, sf_dir, "prices")
    path = scratch_dir(spark, "vendor")
    year = F.year("Date")
    old, middle, new = (prices.where(c) for c in (year < 1997, year.between(1997, 1998), year > 1998))
    plain = middle.withColumns({"Volume": F.col("Volume").cast("int"), "Low": F.col("Low").cast("decimal(18,2)")})
    versions = [
        _raw_headers(old),
        plain.toDF(*[c.lower() for c in plain.columns]),
        new.drop("Adj_Close").withColumn("Trading Currency", F.lit("USD")),
    ]
    for version in versions:
        version.write.mode("append").parquet(path)
    return path


def _ordered(spark: SparkSession, report: DataFrame, order: tuple[str, ...]) -> str:
    return save_ordered(_rounded(report), scratch_dir(spark, "ordered"), order, files=12)


def _null_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports without a date, written by year and served from the external table."""
    merged = landed(spark, sf_dir, "merged")
    number = F.substring("Ticker", 2, 12).cast("long")
    undated = merged.withColumn("Report_Date", F.when(number % 3 != 0, F.col("Report_Date")))
    enriched = barloom.enrich_fundamentals(undated, landed(spark, sf_dir, "companies"))
    path = lake.write_partitioned(enriched, scratch_dir(spark, "lake"), ["Year"])
    served = [
        barloom.stock_fundamentals(
            catalog.register_external(
                spark, f"{_scratch_database(spark)}.f", path, ["Year"], schemas.FUNDAMENTALS_EXTERNAL, typing
            )
        ).withColumn("Typing", F.lit(typing))
        for typing in (catalog.KEYS_AS_STRINGS, catalog.KEYS_TYPED)
    ]
    counts = served[0].union(served[1]).groupBy("Typing", "Year").agg(F.count("*").alias("n"))
    return counts.select("Typing", F.col("Year").cast("double").alias("Year"), "n")


def _statements_repeated(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Statements with NULL tickers and dates and with keys that occur several times."""
    changed = []
    for df in _statements(spark, sf_dir):
        number = F.substring("Ticker", 2, 12).cast("long")
        nothing = {"Ticker": F.lit(None).cast("string"), "Report_Date": F.lit(None).cast("date")}
        blank = df.where(number <= 3).withColumns(nothing)
        changed.append(df.union(df.where(number % 5 == 0)).union(blank))
    return changed


def _several_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annual metrics over two different reports of each ticker and year."""
    one = _fundamentals(spark, sf_dir)
    doubled = {c: F.col(c) * 2 for c in ("Revenue", "Net_Income", "ROE", "Current_Ratio")}
    return _rounded(barloom.annual_company_metrics(one.union(one.withColumns(doubled))))


def _some_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookup in a table that lacks some tickers and repeats others."""
    companies = landed(spark, sf_dir, "companies")
    number = F.substring("Ticker", 2, 12).cast("long")
    some = companies.where(number % 3 != 0)
    twice = some.where(number % 5 == 0).withColumn("Company_Name", F.concat(F.lit("Z "), "Company_Name"))
    named = attach_company(landed(spark, sf_dir, "merged"), twice.union(some))
    return named.select("Ticker", "Report_Date", "Company_Name")


def _csv_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "delivery")
    for name, df in zip(STATEMENTS, _statements(spark, sf_dir)):
        _deliver(df, root, name, files.VARIANT_STATEMENTS)
    delivered = {
        name: files.read_statement(spark, root, name, date_format=DELIVERED_DATES)
        for name in STATEMENTS
    }
    staged = barloom.plans.pipeline.stage(spark, scratch_dir(spark, "lake"), delivered)
    return barloom.merge_statements(**staged)


def _sanitized_csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = landed(spark, sf_dir, "merged")
    path = lake.export_csv(_raw_headers(merged), scratch_dir(spark, "export"))
    return files.read_csv(spark, path, merged.schema, sep=",")


def _roundtrip_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write by year and read the directory back with inferred keys."""
    enriched = barloom.enrich_fundamentals(landed(spark, sf_dir, "merged")).drop("Company_Name")
    path = lake.write_partitioned(enriched, scratch_dir(spark, "lake"), ["Year"])
    back = files.read_parquet(spark, path)
    return _rounded(back.withColumn("Year", F.col("Year").try_cast("long")))


def _external(spark: SparkSession, sf_dir: str, schema, key_typing: str) -> DataFrame:
    keys = ["Year", "Month"]
    path = lake.write_partitioned(_prices_external(spark, sf_dir), scratch_dir(spark, "lake"), keys)
    database = _scratch_database(spark)
    table = catalog.register_external(
        spark, f"{database}.stock_prices_external", path, keys, schema, key_typing
    )
    return table.withColumn("Date", F.col("Date").try_cast("date"))


def _scratch_database(spark: SparkSession) -> str:
    location = scratch_dir(spark, "warehouse")
    database = "scratch_" + location.rsplit("-", 1)[1]
    catalog.create_database(spark, database, location)
    return database


def _roundtrip_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared schema, keys as strings, cast when read."""
    table = _external(spark, sf_dir, schemas.PRICES_EXTERNAL, catalog.KEYS_AS_STRINGS)
    return _rounded(
        table.withColumns({k: F.col(k).try_cast("long") for k in ("Year", "Month")})
    )


def _external_auto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema of the files, typed keys."""
    return _rounded(_external(spark, sf_dir, None, catalog.KEYS_TYPED))


def _saved_table_and_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _scratch_database(spark)
    catalog.save_table(_fundamentals(spark, sf_dir), f"{database}.stock_fundamentals")
    query = barloom.plans.reports.annual_company_metrics_sql(f"{database}.stock_fundamentals")
    return _rounded(catalog.create_view(spark, f"{database}.annual_company_metrics", query))


def _replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader who started before two replacements, and one who comes after them."""
    name = f"{_scratch_database(spark)}.stock_fundamentals"
    rows = _fundamentals(spark, sf_dir)
    before = replace_table(rows.where("Year < 1996"), name, keep=2)
    replace_table(rows.where("Year >= 1996"), name, keep=2)
    after = replace_table(rows, name, keep=2)
    seen = before.withColumn("Seen", F.lit("before")).union(after.withColumn("Seen", F.lit("after")))
    return _rounded(seen.select("Ticker", "Year", "Revenue", "ROE", "Seen"))


def _run_pipeline(
    spark: SparkSession, sf_dir: str, prices: DataFrame | None = None
) -> barloom.plans.pipeline.Loaded:
    location = scratch_dir(spark, "warehouse")
    return barloom.run_pipeline(
        spark,
        scratch_dir(spark, "lake"),
        "scratch_" + location.rsplit("-", 1)[1],
        *_statements(spark, sf_dir),
        landed(spark, sf_dir, "prices") if prices is None else prices,
        companies=landed(spark, sf_dir, "companies"),
        location=location,
    )


def _pipeline_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _run_pipeline(spark, sf_dir)
    view = next(v for v in loaded.views if v.endswith(".top_performers"))
    return _rounded(spark.table(view))


def _annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barloom.annual_company_metrics(_fundamentals(spark, sf_dir))


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barloom.monthly_price_stats(_prices(spark, sf_dir))


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return barloom.top_performers(_fundamentals(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Monthly statistics of the enriched prices at the smallest scale."""
    return _rounded(_monthly(spark, "/root/testdata/sf0.001"))


def _corpus() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the corpus operators, where that subpackage is present."""
    try:
        import corpus_pipeline
        from barloom.llm import queries as corpus
    except ModuleNotFoundError as missing:
        if missing.name in ("barloom.llm", "corpus_pipeline"):
            return {}, {}
        raise
    sql = corpus.oracle_sql()
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {"pipeline": corpus_pipeline.run, **corpus.queries()}, sql


def queries() -> dict[str, Query]:
    return {**library_queries(), **_corpus()[0]}


def library_queries() -> dict[str, Query]:
    """The queries of statements and prices."""
    return {
        "merge_statements": lambda s, d: barloom.merge_statements(*_statements(s, d)),
        "merge_statements_unique": lambda s, d: barloom.merge_statements(
            *_statements(s, d), unique_keys=True
        ),
        "total_debt": _metric("total_debt"),
        "net_margin": lambda s, d: _rounded(_metric("net_margin")(s, d)),
        "current_ratio": lambda s, d: _rounded(_metric("current_ratio")(s, d)),
        "debt_to_equity": lambda s, d: _rounded(_metric("debt_to_equity")(s, d)),
        "return_ratios": lambda s, d: _rounded(_metric("return_ratios")(s, d)),
        "enrich_fundamentals": lambda s, d: _rounded(
            barloom.enrich_fundamentals(landed(s, d, "merged")).drop("Company_Name")
        ),
        "company_lookup": _company_lookup,
        "stock_fundamentals": lambda s, d: _rounded(_fundamentals(s, d)),
        "sma_20": _average,
        "daily_return": lambda s, d: _rounded(
            barloom.daily_return(landed(s, d, "prices").select("Ticker", "Date", "Close"))
        ),
        "enrich_prices": lambda s, d: _rounded(_windows(s, d)),
        "stock_prices": lambda s, d: _rounded(_prices(s, d)),
        "annual_company_metrics": lambda s, d: _rounded(_annual(s, d)),
        "annual_since": lambda s, d: _rounded(_annual(s, d).where("Year >= 1998")),
        "annual_sorted_head": lambda s, d: _rounded(
            barloom.newest_first(_annual(s, d)).limit(100)
        ),
        "monthly_price_stats": lambda s, d: _rounded(_monthly(s, d)),
        "monthly_in_year": lambda s, d: _rounded(_monthly(s, d).where("Year = 1998")),
        "monthly_sorted_head": lambda s, d: _rounded(
            barloom.newest_first(_monthly(s, d)).limit(100)
        ),
        "sma_20_by_part": lambda s, d: _average(s, d, "part_prices"),
        "enrich_prices_by_part": lambda s, d: _rounded(_windows(s, d, "part_prices")),
        "monthly_price_stats_by_part": _monthly_by_part,
        "latest_year": lambda s, d: barloom.latest_year(_fundamentals(s, d)),
        "top_performers": lambda s, d: _rounded(_top(s, d)),
        "top_performers_preview": lambda s, d: _rounded(
            _top(s, d).orderBy(F.desc("Revenue"), "Ticker").limit(10)
        ),
        "quality_summary": lambda s, d: barloom.quality_summary(
            _fundamentals(s, d), _prices(s, d), _prices_external(s, d)
        ),
        "ticker_score": lambda s, d: _rounded(barloom.ticker_score(_fundamentals(s, d))),
        "ticker_score_split": lambda s, d: _rounded(
            barloom.ticker_score(_fundamentals(s, d), hot_rows=50)
        ),
        "merge_statements_split": lambda s, d: barloom.merge_statements(
            *_statements(s, d), hot_rows=1
        ),
        "merge_statements_repeated_keys": _repeated_keys,
        "enrich_prices_split": lambda s, d: _rounded(
            barloom.enrich_prices(landed(s, d, "prices"), hot_rows=40)
        ),
        "enrich_prices_saved": _enrich_saved,
        "enrich_prices_saved_split": lambda s, d: _enrich_saved(s, d, hot_rows=1_300),
        "incremental_prices": _incremental_prices,
        "monthly_price_stats_stored": lambda s, d: _rounded(
            barloom.report(s, rollups.MONTHLY, _monthly_states(s, d))
        ),
        "annual_company_metrics_stored": _annual_states,
        "yearly_price_stats_stored": _yearly_prices,
        "quality_stored": _stored_quality,
        "latest_year_stored": lambda s, d: barloom.stored_latest_year(s, _saved_fundamentals(s, d)),
        "top_performers_stored": lambda s, d: _rounded(
            barloom.stored_top_performers(s, _saved_fundamentals(s, d))
        ),
        "row_counts_stored": _stored_counts,
        "null_years": _null_years,
        "external_registered_twice": _registered_twice,
        "drifting_headers": lambda s, d: read_drifting(
            s, _drifting(s, d), schemas.PRICES, schemas.PRICE_KEYS
        ),
        "drifting_headers_all_columns": lambda s, d: read_drifting(s, _drifting(s, d)),
        "annual_ordered_head": lambda s, d: ordered_head(
            s, _ordered(s, _annual(s, d), barloom.plans.reports.ANNUAL_ORDER), 100
        ),
        "monthly_ordered_head": lambda s, d: ordered_head(
            s, _ordered(s, _monthly(s, d), barloom.plans.reports.MONTHLY_ORDER), 100
        ),
        "annual_ordered_since": lambda s, d: ordered_between(
            s, _ordered(s, _annual(s, d), barloom.plans.reports.ANNUAL_ORDER), low=1998
        ),
        "merge_statements_saved": _merge_saved,
        "merge_statements_saved_split": lambda s, d: _merge_saved(s, d, hot_rows=2),
        "annual_several_reports": _several_reports,
        "company_lookup_partial": _some_companies,
        "quality_rejects": _quality_rejects,
        "csv_rejects": _csv_rejects,
        "csv_rejects_rows": _csv_rejects_rows,
        "pipeline_rejects": _pipeline_rejects,
        "csv_statements_all_columns": _all_columns,
        "raw_headers_declared": _raw_headers_declared,
        "raw_roundtrip": _raw_roundtrip,
        "csv_source_dates": _csv_source_dates,
        "csv_statements": _csv_statements,
        "sanitized_csv_export": _sanitized_csv_export,
        "partitioned_roundtrip_year": _roundtrip_year,
        "partitioned_roundtrip_month": _roundtrip_month,
        "external_auto_schema": _external_auto,
        "saved_table_and_view": _saved_table_and_view,
        "replaced_table": _replaced_table,
        "stock_pipeline": lambda s, d: _run_pipeline(s, d).quality,
        "pipeline_top_performers": _pipeline_top,
    }


def oracle_sql() -> dict[str, str]:
    return {**oracle_queries.oracle_sql(), **_corpus()[1]}
