"""Raw statements and prices derived from the driver's tables (see FIXTURES.md §4).

The library's inputs are delivered files. Here Spark derives them from the given
tables over all rows and lands them as Parquet, once per application and scale.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import merge_statements
from barloom.sinks import scratch_dir

# The derivations, in SQL common to Spark and DuckDB. Names in braces
# are the driver's tables.
INPUT_SQL = {
    "income": """
select concat('C', cast(o_custkey as string)) as Ticker,
       make_date(cast(year(o_orderdate) as int), 12, 31) as Report_Date,
       cast(10000 * sum(case when o_orderstatus <> 'P' then cast(o_totalprice as decimal(18,2)) else 0 end) as double) as Revenue,
       cast(500 * sum(cast(o_totalprice as decimal(18,2)) * case o_orderstatus when 'F' then 6 when 'O' then -2 else -1 end) as double) as Net_Income,
       cast(500 * sum(cast(o_totalprice as decimal(18,2)) * case o_orderstatus when 'F' then 8 when 'O' then -2 else -1 end) as double) as Pretax_Income_Loss_Adj
from {orders}
group by o_custkey, year(o_orderdate)
""",
    "balance": """
select concat('C', cast(o_custkey as string)) as Ticker,
       make_date(cast(year(l_shipdate) as int), 12, 31) as Report_Date,
       cast(10000 * sum(case when l_returnflag = 'N' then cast(l_extendedprice as decimal(18,2)) end) as double) as Short_Term_Debt,
       cast(10000 * sum(case when l_returnflag = 'R' then cast(l_extendedprice as decimal(18,2)) end) as double) as Long_Term_Debt,
       cast(10000 * sum(case when l_linestatus = 'O' then cast(l_extendedprice as decimal(18,2)) end) as double) as Total_Current_Assets,
       cast(10000 * sum(case when l_linestatus = 'F' then cast(l_extendedprice as decimal(18,2)) end) as double) as Total_Current_Liabilities,
       cast(10000 * sum(case when l_returnflag = 'A' then cast(l_extendedprice as decimal(18,2)) else 0 end) as double) as Total_Equity,
       cast(10000 * sum(cast(l_extendedprice as decimal(18,2))) as double) as Total_Assets
from {lineitem} join {orders} on l_orderkey = o_orderkey
group by o_custkey, year(l_shipdate)
""",
    "cashflow": """
select concat('C', cast(o_custkey as string)) as Ticker,
       make_date(cast(year(o_orderdate) as int), 12, 31) as Report_Date,
       cast(10000 * sum(cast(o_totalprice as decimal(18,2))) as double) as Net_Cash_from_Operating_Activities
from {orders}
where o_orderstatus = 'F'
group by o_custkey, year(o_orderdate)
""",
    "prices": """
select p_brand as Ticker,
       cast(l_shipdate as date) as Date,
       cast(min(l_extendedprice) as double) as Open,
       cast(max(l_extendedprice) as double) as High,
       cast(min(l_extendedprice) as double) as Low,
       case when cast(sum(l_quantity) as bigint) % 19 = 0 then null
            when cast(sum(l_quantity) as bigint) % 17 = 0 then cast(0 as double)
            else cast(max(l_extendedprice) as double) end as Close,
       cast(max(l_extendedprice) as double) as Adj_Close,
       cast(sum(l_quantity) as bigint) as Volume
from {lineitem} join {part} on l_partkey = p_partkey
group by p_brand, cast(l_shipdate as date)
""",
    # Brands are few, so their daily bars stop growing; bars per part grow with the data.
    "part_prices": """
select concat('P', cast(l_partkey as string)) as Ticker,
       cast(l_shipdate as date) as Date,
       cast(min(l_extendedprice) as double) as Open,
       cast(max(l_extendedprice) as double) as High,
       cast(min(l_extendedprice) as double) as Low,
       case when cast(sum(l_quantity) as bigint) % 19 = 0 then null
            when cast(sum(l_quantity) as bigint) % 17 = 0 then cast(0 as double)
            else cast(max(l_extendedprice) as double) end as Close,
       cast(max(l_extendedprice) as double) as Adj_Close,
       cast(sum(l_quantity) as bigint) as Volume
from {lineitem}
group by l_partkey, cast(l_shipdate as date)
""",
    "companies": """
select concat('C', cast(c_custkey as string)) as Ticker, c_name as Company_Name
from {customer}
""",
}
_TABLES = ("orders", "lineitem", "part", "customer")

# Rows and compressed bytes that a task of a landing is to get.
_TASK_ROWS = 250_000
_TASK_BYTES = "16m"
# The rows that a derivation groups, by a key with about as many groups as rows, with just
# what its SQL makes of them. They are dealt out by the key as they are: partial sums would
# be about as many and several times as wide.
_JOINED = "{lineitem} join {orders} on l_orderkey = o_orderkey"
_ORDERS = (
    "o_custkey",
    "o_orderstatus",
    "cast(o_totalprice as decimal(18,2)) as o_totalprice",
    "trunc(o_orderdate, 'year') as o_orderdate",
)
_LINES = (
    "l_orderkey",
    "l_returnflag",
    "l_linestatus",
    "cast(l_extendedprice as decimal(18,2)) as l_extendedprice",
    "trunc(l_shipdate, 'year') as l_shipdate",
)
_BARS = ("l_partkey", "l_quantity", "l_extendedprice", "cast(l_shipdate as date) as l_shipdate")

_landed: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}
_lock = threading.RLock()


def oracle_input(name: str) -> str:
    """The derivation of ``name`` for an engine that knows the tables by name."""
    return INPUT_SQL[name].format(**{t: t for t in _TABLES}).strip()


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The derivation of ``name`` as a lazy DataFrame over the given tables."""
    sql = INPUT_SQL[name]
    tables = _given(spark, sf_dir, name)
    if name in ("income", "cashflow"):
        tables["orders"] = tables["orders"].selectExpr(*_ORDERS).repartition("o_custkey")
    elif name == "part_prices":
        tables["lineitem"] = tables["lineitem"].selectExpr(*_BARS).repartition("l_partkey")
    elif name == "balance":
        sql = sql.replace(_JOINED, "{joined}")
        customers = tables["orders"].select("o_orderkey", "o_custkey")
        joined = tables["lineitem"].selectExpr(*_LINES).join(customers, F.expr("l_orderkey = o_orderkey"))
        tables = {"joined": joined.drop("l_orderkey", "o_orderkey").repartition("o_custkey")}
    return spark.sql(sql, **tables)


def _given(spark: SparkSession, sf_dir: str, name: str) -> dict[str, DataFrame]:
    used = [t for t in _TABLES if "{" + t + "}" in INPUT_SQL[name]]
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}


def landed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of the raw layer; ``merged`` is the merge of the statements."""
    with _lock:
        key = (spark.sparkContext.applicationId, str(sf_dir), name)
        if key not in _landed or not _exists(spark, _landed[key][0]):
            path = scratch_dir(spark, f"raw-{name}")
            with _sized(spark, _rows(spark, sf_dir, name)):
                _land(spark, sf_dir, name).write.parquet(path)
            _landed[key] = (path, spark.read.parquet(path))
        return _landed[key][1]


def _land(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name != "merged":
        return derive(spark, sf_dir, name)
    return merge_statements(*_statements(spark, sf_dir))


def _statements(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [landed(spark, sf_dir, t) for t in ("income", "balance", "cashflow")]


def _rows(spark: SparkSession, sf_dir: str, name: str) -> int:
    """The rows that ``name`` is made of, counted in the footers of their files."""
    tables = _statements(spark, sf_dir) if name == "merged" else _given(spark, sf_dir, name).values()
    return sum(df.count() for df in tables)


@contextmanager
def _sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """As many shuffle partitions as ``rows`` call for, whatever number the session has.

    With a fixed number the memory of a task would grow with the tables, up to spilling.
    """
    wanted = {
        "spark.sql.shuffle.partitions": lambda now: max(int(now), math.ceil(rows / _TASK_ROWS)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": lambda now: _TASK_BYTES,
        "spark.sql.files.maxPartitionBytes": lambda now: _TASK_BYTES,
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value(before[key]))
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
