import barloom
from barloom import schemas
from barloom.plans import reports
from tests.helpers import optimized, plan, rows

FUND = {
    "Ticker": "A", "Company_Name": None, "Revenue": 2e9, "Net_Income": 1e9,
    "Pretax_Income_Loss_Adj": None, "Profit_Margin": 50.0, "ROE": 5.0, "ROA": 2.0,
    "Debt_to_Equity": 1.0, "Current_Ratio": 1.0, "Year": 2024,
}
PRICE = {
    "Ticker": "A", "Date": None, "Open": 1.0, "High": 9.0, "Low": 1.0, "Close": 4.0,
    "Adj_Close": 4.0, "Volume": 10, "Volume_Millions": 1.5, "Daily_Return": None,
    "Year": 2024, "Month": 1,
}


def _table(spark, base, schema, changes):
    data = [tuple({**base, **c}[f] for f in schema.fieldNames()) for c in changes]
    return spark.createDataFrame(data, schema)


def _fundamentals(spark, *changes):
    return _table(spark, FUND, schemas.STOCK_FUNDAMENTALS, changes)


def _prices(spark, *changes):
    return _table(spark, PRICE, schemas.STOCK_PRICES, changes)


def test_annual_metrics_skip_nulls_and_group_null_names(spark):
    df = _fundamentals(spark, {}, {"Revenue": 4e9, "ROE": None}, {"Year": 2023, "ROA": None})
    got = {r.Year: r for r in barloom.annual_company_metrics(df).collect()}
    assert len(got) == 2
    assert got[2024].Avg_Revenue == 3e9 and got[2024].Avg_ROE == 5.0
    assert got[2023].Avg_ROA is None


def test_monthly_stats(spark):
    df = _prices(
        spark,
        {},
        {"Close": 8.0, "Low": 0.5, "High": None, "Daily_Return": 0.5},
        {"Month": 2},
    )
    got = {r.Month: r for r in barloom.monthly_price_stats(df).collect()}
    jan = got[1]
    assert (jan.Trading_Days, jan.Avg_Close_Price, jan.Month_Low, jan.Month_High) == (2, 6, 0.5, 9)
    assert (jan.Total_Volume_Millions, jan.Avg_Daily_Return) == (3.0, 0.5)
    assert got[2].Trading_Days == 1


def test_top_performers(spark):
    df = _fundamentals(
        spark,
        {"Ticker": "Z", "Revenue": 3e9},
        {"Ticker": "B", "Revenue": 3e9},
        {"Ticker": "C", "Revenue": 5e9},
        {"Ticker": "at revenue", "Revenue": 1e9},
        {"Ticker": "at margin", "Profit_Margin": 10.0},
        {"Ticker": "no margin", "Profit_Margin": None},
        {"Ticker": "old", "Year": 2023, "Revenue": 9e9},
        {"Ticker": "no year", "Year": None, "Revenue": 9e9},
    )
    got = barloom.top_performers(df)
    assert got.columns == list(reports.PERFORMER_COLUMNS)
    assert [r.Ticker for r in got.collect()] == ["C", "B", "Z"]
    assert [r.Ticker for r in barloom.top_performers(df, n=2).collect()] == ["C", "B"]
    loose = barloom.top_performers(df, min_revenue=0, min_margin=5)
    assert {r.Ticker for r in loose.collect()} == {"C", "B", "Z", "at revenue", "at margin"}
    assert "TakeOrderedAndProject" in plan(barloom.top_performers(df))


def test_latest_year(spark):
    df = _fundamentals(spark, {}, {"Year": 2025}, {"Year": None})
    assert rows(barloom.latest_year(df)) == [(2025,)]
    assert rows(barloom.latest_year(df.where("false"))) == [(None,)]
    assert rows(barloom.top_performers(df.where("false"))) == []


def test_newest_first(spark):
    df = _prices(spark, {"Year": 2023, "Month": 7}, {"Ticker": "B"}, {}, {"Month": 5}, {"Year": None})
    got = barloom.newest_first(barloom.monthly_price_stats(df)).collect()
    assert [(r.Ticker, r.Year, r.Month) for r in got] == [
        ("A", 2024, 5), ("A", 2024, 1), ("B", 2024, 1), ("A", 2023, 7), ("A", None, 1),
    ]


def test_sql_views_equal_the_functions(spark):
    fundamentals = _fundamentals(
        spark, {}, {"Revenue": 4e9}, {"Ticker": "B", "Revenue": 3e9}, {"Year": 2023}
    )
    prices = _prices(spark, {}, {"Close": 8.0}, {"Month": 2})
    fundamentals.createOrReplaceTempView("f_test")
    prices.createOrReplaceTempView("p_test")
    pairs = [
        (reports.annual_company_metrics_sql("f_test"), barloom.annual_company_metrics(fundamentals)),
        (reports.monthly_price_stats_sql("p_test"), barloom.monthly_price_stats(prices)),
        (reports.top_performers_sql("f_test"), barloom.top_performers(fundamentals)),
    ]
    for query, df in pairs:
        view = spark.sql(query)
        assert view.columns == df.columns
        assert rows(view) == rows(df)


def test_aggregates_combine_before_the_shuffle(spark):
    text = plan(barloom.annual_company_metrics(_fundamentals(spark, {})))
    assert "partial_avg" in text and text.count("Exchange") == 1
    assert "Sort" not in optimized(barloom.annual_company_metrics(_fundamentals(spark, {})))


def test_quality_summary(spark):
    f = _fundamentals(spark, {}, {"Ticker": "B"}, {"Ticker": None})
    p = _prices(spark, {}, {})
    bad = spark.createDataFrame([("2024-01-02",), ("x",), (None,)], "Date string")
    expected = {
        "Fundamentals row count": 3,
        "Prices row count": 2,
        "Unique tickers in fundamentals": 2,
        "Unique tickers in prices": 1,
    }
    assert dict(rows(barloom.quality_summary(f, p))) == expected
    assert dict(rows(barloom.quality_summary(f, p, approximate=True))) == expected
    with_dates = barloom.quality_summary(f, p, bad)
    assert dict(rows(with_dates)) == {**expected, "Rejected price dates": 1}
