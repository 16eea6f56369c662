"""The registered queries in SQL for DuckDB, over the driver's tables."""

from __future__ import annotations

from derived_inputs import oracle_input

_MERGED = """
select Ticker, Report_Date, Revenue, Net_Income, Pretax_Income_Loss_Adj,
       Short_Term_Debt, Long_Term_Debt, Total_Current_Assets, Total_Current_Liabilities,
       Total_Equity, Total_Assets, Net_Cash_from_Operating_Activities
from income full outer join balance using (Ticker, Report_Date)
            full outer join cashflow using (Ticker, Report_Date)
"""

_RATIOS = """
select *, 100 * (Net_Income / nullif(Revenue, 0)) as Profit_Margin,
       Net_Income / nullif(Revenue, 0) as net_margin,
       Total_Current_Assets / nullif(Total_Current_Liabilities, 0) as Current_Ratio,
       Total_Debt / nullif(Total_Equity, 0) as Debt_to_Equity,
       100 * (Net_Income / nullif(Total_Equity, 0)) as ROE,
       100 * (Net_Income / nullif(Total_Assets, 0)) as ROA,
       cast(year(Report_Date) as bigint) as Year
from (select *, coalesce(Short_Term_Debt, 0) + coalesce(Long_Term_Debt, 0) as Total_Debt
      from merged)
"""

_ENRICHED = """
select ratios.*, c.Company_Name
from ratios left join companies c on ratios.Ticker = c.Ticker
"""

_FUNDAMENTALS = """
select Ticker, Company_Name, Revenue, Net_Income, Pretax_Income_Loss_Adj, Profit_Margin,
       ROE, ROA, Debt_to_Equity, Current_Ratio, Year
from enriched where Revenue is not null
"""

_WINDOWS = """
select *, avg(Close) over (partition by Ticker order by Date
                           rows between 19 preceding and current row) as SMA_20,
       Close / nullif(lag(Close) over (partition by Ticker order by Date), 0) - 1 as Daily_Return,
       Volume / 1e6 as Volume_Millions,
       cast(year(Date) as bigint) as Year, cast(month(Date) as bigint) as Month
from prices
"""

_STOCK_PRICES = """
select Ticker, Date, Open, High, Low, Close, Adj_Close, Volume, Volume_Millions,
       Daily_Return, Year, Month
from windows where Close > 0
"""

_ANNUAL = """
select Ticker, Company_Name, Year,
       avg(Revenue) as Avg_Revenue, avg(Net_Income) as Avg_Net_Income,
       avg(Profit_Margin) as Avg_Profit_Margin, avg(ROE) as Avg_ROE, avg(ROA) as Avg_ROA,
       avg(Debt_to_Equity) as Avg_Debt_to_Equity, avg(Current_Ratio) as Avg_Current_Ratio
from stock_fundamentals group by Ticker, Company_Name, Year
"""

_MONTHLY = """
select Ticker, Year, Month, count(*) as Trading_Days, avg(Close) as Avg_Close_Price,
       min(Low) as Month_Low, max(High) as Month_High,
       sum(Volume_Millions) as Total_Volume_Millions, avg(Daily_Return) as Avg_Daily_Return
from stock_prices group by Ticker, Year, Month
"""

_TOP = """
select Ticker, Company_Name, Year, Revenue, Net_Income, Profit_Margin, ROE, ROA
from stock_fundamentals
where Year = (select max(Year) from stock_fundamentals)
  and Revenue > 1000000000 and Profit_Margin > 10
order by Revenue desc nulls last, Ticker asc nulls first limit 50
"""

# Each step and the steps it reads.
_STEPS = {
    "income": ((), oracle_input("income")),
    "balance": ((), oracle_input("balance")),
    "cashflow": ((), oracle_input("cashflow")),
    "prices": ((), oracle_input("prices")),
    "companies": ((), oracle_input("companies")),
    "merged": (("income", "balance", "cashflow"), _MERGED),
    "ratios": (("merged",), _RATIOS),
    "enriched": (("ratios", "companies"), _ENRICHED),
    "stock_fundamentals": (("enriched",), _FUNDAMENTALS),
    "windows": (("prices",), _WINDOWS),
    "stock_prices": (("windows",), _STOCK_PRICES),
    "annual": (("stock_fundamentals",), _ANNUAL),
    "monthly": (("stock_prices",), _MONTHLY),
    "top": (("stock_fundamentals",), _TOP),
}

# Columns that hold quotients or means; both engines round them to six places.
ROUNDED = (
    "net_margin", "Profit_Margin", "Current_Ratio", "Debt_to_Equity", "ROE", "ROA",
    "SMA_20", "Daily_Return", "Volume_Millions", "Avg_Revenue", "Avg_Net_Income",
    "Avg_Profit_Margin", "Avg_ROE", "Avg_ROA", "Avg_Debt_to_Equity", "Avg_Current_Ratio",
    "Avg_Close_Price", "Total_Volume_Millions", "Avg_Daily_Return", "ROE_Rank",
    "Current_Ratio_Rank", "Score",
)
_MERGED_COLUMNS = (
    "Ticker", "Report_Date", "Revenue", "Net_Income", "Pretax_Income_Loss_Adj",
    "Short_Term_Debt", "Long_Term_Debt", "Total_Current_Assets", "Total_Current_Liabilities",
    "Total_Equity", "Total_Assets", "Net_Cash_from_Operating_Activities",
)
_RATIO_COLUMNS = (
    "Total_Debt", "net_margin", "Profit_Margin", "Current_Ratio", "Debt_to_Equity", "ROE",
    "ROA", "Year",
)
_FUNDAMENTAL_COLUMNS = (
    "Ticker", "Company_Name", "Revenue", "Net_Income", "Pretax_Income_Loss_Adj",
    "Profit_Margin", "ROE", "ROA", "Debt_to_Equity", "Current_Ratio", "Year",
)
_PRICE_COLUMNS = ("Ticker", "Date", "Open", "High", "Low", "Close", "Adj_Close", "Volume")
_WINDOW_COLUMNS = (
    *_PRICE_COLUMNS, "SMA_20", "Daily_Return", "Volume_Millions", "Year", "Month",
)
_STOCK_PRICE_COLUMNS = tuple(c for c in _WINDOW_COLUMNS if c != "SMA_20")
_ANNUAL_COLUMNS = (
    "Ticker", "Company_Name", "Year", "Avg_Revenue", "Avg_Net_Income", "Avg_Profit_Margin",
    "Avg_ROE", "Avg_ROA", "Avg_Debt_to_Equity", "Avg_Current_Ratio",
)
_MONTHLY_COLUMNS = (
    "Ticker", "Year", "Month", "Trading_Days", "Avg_Close_Price", "Month_Low", "Month_High",
    "Total_Volume_Millions", "Avg_Daily_Return",
)
_TOP_COLUMNS = (
    "Ticker", "Company_Name", "Year", "Revenue", "Net_Income", "Profit_Margin", "ROE", "ROA",
)

_SCORES = """
select s.Ticker, s.Company_Name, s.Year, s.ROE, s.Current_Ratio, r.ROE_Rank,
       r.Current_Ratio_Rank, (r.ROE_Rank + r.Current_Ratio_Rank) / 2 as Score
from stock_fundamentals s left join (
    select Ticker, Year,
           percent_rank() over (partition by Year order by ROE) as ROE_Rank,
           percent_rank() over (partition by Year order by Current_Ratio) as Current_Ratio_Rank
    from stock_fundamentals where ROE is not null and Current_Ratio is not null
) r on s.Ticker = r.Ticker and s.Year = r.Year
"""
_SCORE_COLUMNS = (
    "Ticker", "Company_Name", "Year", "ROE", "Current_Ratio", "ROE_Rank",
    "Current_Ratio_Rank", "Score",
)

_CHECKS = """
select 'Fundamentals row count' as "check", count(*) as "count" from stock_fundamentals
union all select 'Prices row count', count(*) from stock_prices
union all select 'Unique tickers in fundamentals', count(distinct Ticker) from stock_fundamentals
union all select 'Unique tickers in prices', count(distinct Ticker) from stock_prices
"""
# The names are the fixed values of ``barloom.plans.quality``.
_REJECTED = """
union all select 'Rejected price dates', count(*) from windows
where Date is not null and try_cast(cast(Date as varchar) as date) is null
"""


_REJECTED_DELIVERY = """
union all select 'Rejected price dates', count(*) from prices where Date is not null and Volume % 23 = 0
"""

_NULL_YEARS = """
select Typing, cast(case when cast(substr(Ticker, 2) as bigint) % 3 <> 0 then Year end as double) as Year, count(*) as n
from stock_fundamentals cross join (select unnest(['STRINGS', 'AUTO']) as Typing)
group by all
"""
_VERSIONS = """
select Ticker, Year, Revenue, round(ROE, 6) as ROE, 'before' as Seen from stock_fundamentals where Year < 1996
union all select Ticker, Year, Revenue, round(ROE, 6), 'after' from stock_fundamentals
"""
_DRIFTED = """
select Ticker, Date, Open, High, Low, Close, case when year(Date) <= 1998 then Adj_Close end as Adj_Close, Volume
from prices
"""
# Cells of the delivered prices that cannot be read, by what the delivery did to them.
_REJECTED_CELLS = """
select 'prices' as "table", 'Date' as "column", 'no ' || strftime(Date, '%d/%m/%Y') as "value", 'not a date' as reason
from prices where Volume % 23 = 0
union all select 'prices', 'Close', 'n/a ' || Volume, 'not a double' from prices where Volume % 13 = 0
union all select 'prices', 'Volume', Volume || ' pcs', 'not a bigint' from prices where Volume % 11 = 0
"""
_READ_PRICES = """
select Ticker, case when Volume % 23 = 0 then 'no ' || strftime(Date, '%d/%m/%Y') else cast(Date as varchar) end as Delivered_Date,
       case when Volume % 7 <> 0 then Open end as Open, High, Low,
       case when Volume % 13 <> 0 then Close end as Close, Adj_Close,
       cast(case when Volume % 11 <> 0 then Volume end as double) as Volume
from prices
"""
_REJECTED_RUN = """
select 'Fundamentals row count' as "check", count(*) as "count" from stock_fundamentals
where cast(substr(Ticker, 2) as bigint) % 9 <> 0
union all select 'Prices row count', count(*) from prices where Close > 0 and Volume % 13 <> 0
union all select 'Unique tickers in fundamentals', count(distinct Ticker) from stock_fundamentals
where cast(substr(Ticker, 2) as bigint) % 9 <> 0
union all select 'Unique tickers in prices', count(distinct Ticker) from prices where Close > 0 and Volume % 13 <> 0
union all select 'Rejected price dates', count(*) from prices where Volume % 23 = 0
union all select 'Rejected prices.Date: not a date', count(*) from prices where Volume % 23 = 0 having count(*) > 0
union all select 'Rejected prices.Close: not a double', count(*) from prices where Volume % 13 = 0 having count(*) > 0
union all select 'Rejected prices.Volume: not a bigint', count(*) from prices where Volume % 11 = 0 having count(*) > 0
union all select 'Rejected income.Revenue: not a double', count(*) from income
where cast(substr(Ticker, 2) as bigint) % 9 = 0 having count(*) > 0
"""

_ALL_COLUMNS = """
select coalesce(i.Ticker, b.Ticker, c.Ticker) as Ticker,
       coalesce(i.Report_Date, b.Report_Date, c.Report_Date) as Report_Date,
       Revenue, Net_Income, Pretax_Income_Loss_Adj,
       cast(year(i.Report_Date) as varchar) as Fiscal_Year_income,
       Short_Term_Debt, Long_Term_Debt, Total_Current_Assets, Total_Current_Liabilities,
       Total_Equity, Total_Assets, cast(year(b.Report_Date) as varchar) as Fiscal_Year_balance,
       Net_Cash_from_Operating_Activities,
       cast(year(c.Report_Date) as varchar) as Fiscal_Year_cashflow
from income i full outer join balance b on i.Ticker = b.Ticker and i.Report_Date = b.Report_Date
full outer join cashflow c on coalesce(i.Ticker, b.Ticker) = c.Ticker
  and coalesce(i.Report_Date, b.Report_Date) = c.Report_Date
"""

# One side of a merge with repeated and NULL keys; ``mark`` tells a row from none.
_CHANGED = """
{0}_changed as (
  select *, true as mark from {0}
  union all select *, true from {0} where cast(substr(Ticker, 2) as bigint) % 5 = 0
  union all select * replace (null as Ticker, null as Report_Date), true from {0}
            where cast(substr(Ticker, 2) as bigint) <= 3
)"""
_REPEATED = """
, two as (
  select case when i.mark then i.Ticker else b.Ticker end as Ticker,
         case when i.mark then i.Report_Date else b.Report_Date end as Report_Date,
         Revenue, Net_Income, Pretax_Income_Loss_Adj, Short_Term_Debt, Long_Term_Debt,
         Total_Current_Assets, Total_Current_Liabilities, Total_Equity, Total_Assets, true as mark
  from income_changed i full outer join balance_changed b
    on i.Ticker is not distinct from b.Ticker and i.Report_Date is not distinct from b.Report_Date
)
select case when t.mark then t.Ticker else c.Ticker end as Ticker,
       case when t.mark then t.Report_Date else c.Report_Date end as Report_Date,
       Revenue, Net_Income, Pretax_Income_Loss_Adj, Short_Term_Debt, Long_Term_Debt,
       Total_Current_Assets, Total_Current_Liabilities, Total_Equity, Total_Assets,
       Net_Cash_from_Operating_Activities
from two t full outer join cashflow_changed c
  on t.Ticker is not distinct from c.Ticker and t.Report_Date is not distinct from c.Report_Date
"""

_TWO_REPORTS = """
select * from stock_fundamentals
union all
select * replace (Revenue * 2 as Revenue, Net_Income * 2 as Net_Income, ROE * 2 as ROE,
                  Current_Ratio * 2 as Current_Ratio)
from stock_fundamentals
"""

_SOME_COMPANIES = """
select m.Ticker, m.Report_Date, c.Company_Name
from merged m left join companies c
  on m.Ticker = c.Ticker and cast(substr(c.Ticker, 2) as bigint) % 3 <> 0
"""


def _repeated_keys() -> str:
    """Statements with NULL keys and repeated keys, merged with NULL equal to NULL."""
    names = ("income", "balance", "cashflow")
    steps = [f"{n} as ({oracle_input(n)})" for n in names]
    steps += [_CHANGED.format(n).strip() for n in names]
    return "with " + ",\n".join(steps) + _REPEATED


def _with(steps: tuple[str, ...], query: str) -> str:
    needed: list[str] = []

    def visit(step: str) -> None:
        for earlier in _STEPS[step][0]:
            visit(earlier)
        if step not in needed:
            needed.append(step)

    for step in steps:
        visit(step)
    ctes = ",\n".join(f"{step} as ({_STEPS[step][1].strip()})" for step in needed)
    return f"with {ctes}\n{query.strip()}"


def _select(step: str, columns: tuple[str, ...], tail: str = "") -> str:
    chosen = ", ".join(f"round({c}, 6) as {c}" if c in ROUNDED else c for c in columns)
    return _with((step,), f"select {chosen} from {step} {tail}")


def _per_part(sql: str) -> str:
    """The same query over the daily bars of parts instead of brands."""
    return sql.replace(oracle_input("prices"), oracle_input("part_prices"))


def oracle_sql() -> dict[str, str]:
    merged = _select("merged", _MERGED_COLUMNS)
    keys = ("Ticker", "Report_Date")
    fundamentals = _select("stock_fundamentals", _FUNDAMENTAL_COLUMNS)
    prices = _select("prices", _PRICE_COLUMNS)
    scores = ", ".join(f"round({c}, 6) as {c}" if c in ROUNDED else c for c in _SCORE_COLUMNS)
    return {
        "merge_statements": merged,
        "merge_statements_unique": merged,
        "total_debt": _select("ratios", (*keys, "Total_Debt")),
        "net_margin": _select("ratios", (*keys, "net_margin")),
        "current_ratio": _select("ratios", (*keys, "Current_Ratio")),
        "debt_to_equity": _select("ratios", (*keys, "Debt_to_Equity")),
        "return_ratios": _select("ratios", (*keys, "Profit_Margin", "ROE", "ROA")),
        "enrich_fundamentals": _select("ratios", (*_MERGED_COLUMNS, *_RATIO_COLUMNS)),
        "company_lookup": _select("enriched", ("Ticker", "Report_Date", "Company_Name", "Year")),
        "stock_fundamentals": fundamentals,
        "sma_20": _select("windows", ("Ticker", "Date", "Close", "SMA_20")),
        "daily_return": _select("windows", ("Ticker", "Date", "Close", "Daily_Return")),
        "enrich_prices": _select("windows", _WINDOW_COLUMNS),
        "stock_prices": _select("stock_prices", _STOCK_PRICE_COLUMNS),
        "annual_company_metrics": _select("annual", _ANNUAL_COLUMNS),
        "annual_since": _select("annual", _ANNUAL_COLUMNS, "where Year >= 1998"),
        "annual_sorted_head": _select(
            "annual",
            _ANNUAL_COLUMNS,
            "order by Year desc nulls last, Ticker asc nulls first limit 100",
        ),
        "monthly_price_stats": _select("monthly", _MONTHLY_COLUMNS),
        "monthly_in_year": _select("monthly", _MONTHLY_COLUMNS, "where Year = 1998"),
        "monthly_sorted_head": _select(
            "monthly",
            _MONTHLY_COLUMNS,
            "order by Year desc nulls last, Month desc nulls last, "
            "Ticker asc nulls first limit 100",
        ),
        "sma_20_by_part": _per_part(_select("windows", ("Ticker", "Date", "Close", "SMA_20"))),
        "enrich_prices_by_part": _per_part(_select("windows", _WINDOW_COLUMNS)),
        "monthly_price_stats_by_part": _per_part(_select("monthly", _MONTHLY_COLUMNS)),
        "latest_year": _with(
            ("stock_fundamentals",), "select max(Year) as max_year from stock_fundamentals"
        ),
        "top_performers": _select("top", _TOP_COLUMNS),
        "top_performers_preview": _select(
            "top",
            _TOP_COLUMNS,
            "order by Revenue desc nulls last, Ticker asc nulls first limit 10",
        ),
        "quality_summary": _with(("stock_fundamentals", "stock_prices"), _CHECKS + _REJECTED),
        "ticker_score": _with(
            ("stock_fundamentals",), f"select {scores} from ({_SCORES.strip()})"
        ),
        "ticker_score_split": _with(
            ("stock_fundamentals",), f"select {scores} from ({_SCORES.strip()})"
        ),
        "merge_statements_split": merged,
        "merge_statements_repeated_keys": _repeated_keys(),
        "enrich_prices_split": _select("windows", _WINDOW_COLUMNS),
        "enrich_prices_saved": _select("windows", _WINDOW_COLUMNS),
        "enrich_prices_saved_split": _select("windows", _WINDOW_COLUMNS),
        "incremental_prices": _select("windows", _WINDOW_COLUMNS),
        "monthly_price_stats_stored": _select("monthly", _MONTHLY_COLUMNS),
        "annual_company_metrics_stored": _select("annual", _ANNUAL_COLUMNS),
        "yearly_price_stats_stored": _select(
            "monthly", tuple(c for c in _MONTHLY_COLUMNS if c != "Month")
        ).replace("select Ticker, Year, Month, count(*)", "select Ticker, Year, count(*)").replace(
            "group by Ticker, Year, Month", "group by Ticker, Year"
        ),
        "quality_stored": _with(
            ("stock_fundamentals", "stock_prices"),
            f'select "check", "count", true as near from ({_CHECKS.strip()})',
        ),
        "latest_year_stored": _with(
            ("stock_fundamentals",), "select max(Year) as max_year from stock_fundamentals"
        ),
        "top_performers_stored": _select("top", _TOP_COLUMNS),
        "row_counts_stored": _with(
            ("stock_fundamentals", "stock_prices"), _CHECKS.split("union all select 'Unique")[0]
        ),
        "null_years": _with(("stock_fundamentals",), _NULL_YEARS),
        "external_registered_twice": _select("windows", _WINDOW_COLUMNS),
        "drifting_headers": _with(("prices",), _DRIFTED),
        "drifting_headers_all_columns": _with(
            ("prices",),
            "select *, case when year(Date) > 1998 then 'USD' end as Trading_Currency "
            f"from ({_DRIFTED.strip()})",
        ),
        "annual_ordered_head": _select(
            "annual",
            _ANNUAL_COLUMNS,
            "order by Year desc nulls last, Ticker asc nulls first limit 100",
        ),
        "monthly_ordered_head": _select(
            "monthly",
            _MONTHLY_COLUMNS,
            "order by Year desc nulls last, Month desc nulls last, "
            "Ticker asc nulls first limit 100",
        ),
        "annual_ordered_since": _select("annual", _ANNUAL_COLUMNS, "where Year >= 1998"),
        "merge_statements_saved": _repeated_keys(),
        "merge_statements_saved_split": _repeated_keys(),
        "annual_several_reports": _select("annual", _ANNUAL_COLUMNS).replace(
            "from stock_fundamentals group by", f"from ({_TWO_REPORTS.strip()}) group by"
        ),
        "company_lookup_partial": _with(("merged", "companies"), _SOME_COMPANIES),
        "quality_rejects": _with(
            ("stock_fundamentals", "stock_prices"), _CHECKS + _REJECTED_DELIVERY
        ),
        "csv_rejects": _with(("prices",), _REJECTED_CELLS),
        "csv_rejects_rows": _with(("prices",), _READ_PRICES),
        "pipeline_rejects": _with(("stock_fundamentals", "prices", "income"), _REJECTED_RUN),
        "csv_statements_all_columns": _with(("income", "balance", "cashflow"), _ALL_COLUMNS),
        "raw_headers_declared": prices,
        "raw_roundtrip": prices,
        "csv_source_dates": prices,
        "csv_statements": merged,
        "sanitized_csv_export": merged,
        "partitioned_roundtrip_year": _select(
            "ratios", (*_MERGED_COLUMNS, *_RATIO_COLUMNS)
        ),
        "partitioned_roundtrip_month": _select("windows", _STOCK_PRICE_COLUMNS),
        "external_auto_schema": _select("windows", _WINDOW_COLUMNS),
        "saved_table_and_view": _select("annual", _ANNUAL_COLUMNS),
        "replaced_table": _with(("stock_fundamentals",), _VERSIONS),
        "stock_pipeline": _with(("stock_fundamentals", "stock_prices"), _CHECKS + _REJECTED),
        "pipeline_top_performers": _select("top", _TOP_COLUMNS),
    }
