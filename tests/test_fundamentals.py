import datetime as dt

import pytest
from pyspark.sql import functions as F

import barloom
from barloom import schemas
from barloom.operators import attach_company
from tests.helpers import plan, same

RAW = (
    "Ticker string, `Report Date` date, Revenue double, `Net Income` double, "
    "`Short Term Debt` double, `Long Term Debt` double, `Total Equity` double, "
    "`Total Assets` double, `Total Current Assets` double, `Total Current Liabilities` double"
)
DAY = dt.date(2023, 12, 31)
N = None
# revenue, income, short, long, equity, assets, current assets, current liabilities ->
# debt, net margin, profit margin, roe, roa, current ratio, debt to equity
CASES = {
    "plain": ((200, 50, 10, 30, 80, 400, 90, 45), (40, 0.25, 25, 62.5, 12.5, 2, 0.5)),
    "no debts": ((200, 50, N, N, 80, 400, 90, 45), (0, 0.25, 25, 62.5, 12.5, 2, 0)),
    "one debt": ((200, 50, N, 30, 80, 400, 90, 45), (30, 0.25, 25, 62.5, 12.5, 2, 0.375)),
    "zero": ((0, 50, 10, 30, 0, 0, 90, 0), (40, N, N, N, N, N, N)),
    "negative": ((200, -50, 10, 30, -80, 400, 90, 45), (40, -0.25, -25, 62.5, -12.5, 2, -0.5)),
    "no income": ((N, N, 10, 30, 80, 400, 90, 45), (40, N, N, N, N, 2, 0.5)),
}
METRICS = (
    "Total_Debt", "net_margin", "Profit_Margin", "ROE", "ROA", "Current_Ratio", "Debt_to_Equity",
)


def _raw(spark, values=None):
    values = values or {name: case[0] for name, case in CASES.items()}
    data = [
        (name, DAY, *[None if v is None else float(v) for v in row])
        for name, row in values.items()
    ]
    return spark.createDataFrame(data, RAW)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_ratios(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = {r.Ticker: r for r in barloom.enrich_fundamentals(_raw(spark)).collect()}
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    for name, (_, expected) in CASES.items():
        assert same([got[name][m] for m in METRICS], list(expected)), name
        assert got[name].Year == 2023


def test_other_columns_pass_through_and_debt_is_replaced(spark):
    raw = _raw(spark).selectExpr("*", "1.0D as `Total Debt`", "'x' as `Other (1)`")
    out = barloom.enrich_fundamentals(raw)
    assert [c.lower() for c in out.columns].count("total_debt") == 1
    row = out.where("Ticker = 'plain'").first()
    assert row.Total_Debt == 40 and row.Other_1 == "x" and row.Company_Name is None


def test_missing_total_assets_leaves_roa_empty(spark):
    out = barloom.enrich_fundamentals(_raw(spark).drop("Total Assets"))
    assert {r.ROA for r in out.collect()} == {None}


def test_enrichment_has_no_shuffle(spark):
    assert "Exchange" not in plan(barloom.enrich_fundamentals(_raw(spark)))


def test_served_table_keeps_rows_with_revenue(spark):
    out = barloom.stock_fundamentals(barloom.enrich_fundamentals(_raw(spark)))
    assert out.schema == schemas.STOCK_FUNDAMENTALS
    assert {r.Ticker for r in out.collect()} == set(CASES) - {"no income"}


def test_company_lookup(spark):
    companies = spark.createDataFrame(
        [("plain", "Plain Inc"), ("zero", "Zero A"), ("zero", "Zero B")], schemas.COMPANIES
    )
    out = barloom.enrich_fundamentals(_raw(spark), companies)
    names = sorted((r.Ticker, r.Company_Name or "") for r in out.collect())
    assert ("plain", "Plain Inc") in names and ("negative", "") in names
    assert [n for t, n in names if t == "zero"] == ["Zero A"]


def test_a_hot_ticker_is_split_by_the_lookup_join(spark):
    """Beyond the broadcast threshold the join is split where one ticker dominates."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    ids = spark.range(60_000, numPartitions=8)
    hot = F.when(F.col("id") % 3 == 0, F.lit("T1")).otherwise(F.concat(F.lit("T"), "id"))
    facts = ids.select(hot.alias("Ticker"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    companies = ids.selectExpr("concat('T', id) as Ticker", "'n' as Company_Name")
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        named = attach_company(facts, companies)
        assert len(named.collect()) == 60_000
        assert "skew=true" in named._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in settings:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
