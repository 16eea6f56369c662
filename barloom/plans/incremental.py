"""Prices that arrive in deliveries, each added to the table without redoing the rest.

A ticker's measures look a few rows back. Its last rows are kept as a state, one small
table, so that a delivery that goes on where the last one ended needs no history. Rows
that come late, or again, take the stored rows around them. Only the months of rows that
change are written; files of other months stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.headers import clean_headers
from barloom.operators.history import over_history
from barloom.operators.skew import HOT_ROWS
from barloom.plans.pipeline import PARTITION_KEYS, PRICES
from barloom.plans.prices import SMA_ROWS, dated, price_windows
from barloom.scratch import path_exists, scratch_dir
from barloom.sinks import lake as lake_sink

_STATE = ["Ticker", "Date", "Close"]
_NEW = "_new"
_NEAR = "_near"
_FROM = "_from"
_LATE = "_late"


def add_prices(
    spark: SparkSession,
    lake: str,
    delivery: DataFrame,
    n: int = SMA_ROWS,
    hot_rows: int | None = HOT_ROWS,
) -> str:
    """Add raw prices to the transformed table of ``lake``; returns its path.

    Afterwards the table holds what :func:`~barloom.plans.pipeline.run_transform` of all
    deliveries together would have written, whatever their order. A delivered row replaces
    the stored one of the same ticker and date, so a delivery may be added again. Tickers
    and dates should be unique within a delivery. Adding is not safe against another
    writer of the same table at the same time; after a crash, add the delivery again.
    """
    depth = max(n - 1, 1)
    path = lake_sink.transformed_path(lake, PRICES)
    states = f"{lake.rstrip('/')}/state/{PRICES}_{n}"
    new = clean_headers(delivery)
    new = _staged(new.withColumn("Date", F.col("Date").cast("string")), "delivery")
    if path_exists(spark, path):
        stored = spark.read.parquet(path)
        state = _state(spark, states, stored, depth)
        pool = _pool(new, stored, state, depth)
    else:
        stored, state = None, None
        pool = new.withColumn(_NEW, F.lit(True))
    pool = _staged(pool, "pool")

    windows = lambda w: {
        **price_windows(n)(w),
        _NEAR: F.max(_NEW).over(w.rowsBetween(-depth, 0)),
    }
    changed = over_history(pool, windows, depth, hot_rows=hot_rows).where(F.col(_NEAR))
    changed = _staged(dated(changed.drop(_NEW, _NEAR)), "changed")
    result = changed if stored is None else _with_kept(stored, changed)
    lake_sink.write_partitioned(result, path, PARTITION_KEYS[PRICES], lake_sink.OVERWRITE_TOUCHED)

    last = _last(pool.select(*_STATE), depth)
    if state is not None:
        last = last.unionByName(_matching(state, pool.select("Ticker").distinct(), ["Ticker"], "left_anti"))
    lake_sink.write_version(last, states)
    return path


def _state(spark: SparkSession, states: str, stored: DataFrame, depth: int) -> DataFrame:
    """The last rows of each ticker, read from the table itself where no state was written."""
    found = lake_sink.latest_version(spark, states)
    if found is not None:
        return spark.read.parquet(found)
    return _staged(_last(stored.select(*_STATE), depth), "state")


def _last(rows: DataFrame, depth: int) -> DataFrame:
    """At most ``depth`` rows of each ticker leave a task before the shuffle."""
    newest = Window.partitionBy("Ticker").orderBy(F.desc("Date"), F.desc("Close"))
    ranked = rows.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= depth)
    return ranked.drop("_back")


def _pool(new: DataFrame, stored: DataFrame, state: DataFrame, depth: int) -> DataFrame:
    """The delivered rows, flagged, with the rows that their measures or followers need."""
    first = new.groupBy("Ticker").agg(F.min(_place()).alias(_FROM))
    ends = state.groupBy(F.col("Ticker").alias("_of")).agg(F.max(_place()).alias("_end"))
    known = first.join(ends, F.col("Ticker").eqNullSafe(F.col("_of")), "left")
    tickers = _staged(known.select("Ticker", _FROM, F.coalesce(F.col(_FROM) <= F.col("_end"), F.lit(False)).alias(_LATE)), "tickers")
    late = tickers.where(F.col(_LATE))

    flagged = new.withColumn(_NEW, F.lit(True))
    before = _matching(state, tickers.where(~F.col(_LATE)), ["Ticker"], "left_semi").withColumn(_NEW, F.lit(False))
    pool = flagged.unionByName(before, allowMissingColumns=True)
    if late.isEmpty():
        return pool
    # Rows of late tickers: all from the first late row on, and the last ones before it.
    raw = [c for c in stored.columns if c in new.columns]
    on = F.col("Ticker").eqNullSafe(F.col("_of"))
    old = stored.select(*raw).join(late.select(F.col("Ticker").alias("_of"), _FROM), on).drop("_of")
    after = _matching(old.where(_place() >= F.col(_FROM)), new, ["Ticker", "Date"], "left_anti")
    lead = old.where(_place() < F.col(_FROM))
    newest = Window.partitionBy("Ticker").orderBy(F.desc("Date"), F.desc("Close"))
    lead = lead.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= depth).drop("_back")
    around = after.unionByName(lead).drop(_FROM).withColumn(_NEW, F.lit(False))
    return pool.unionByName(around, allowMissingColumns=True)


def _with_kept(stored: DataFrame, changed: DataFrame) -> DataFrame:
    """The changed rows and, of the months they lie in, the stored rows that stay."""
    months = changed.select("Year", "Month").distinct().collect()  # a calendar's worth
    years: dict[int | None, list[int | None]] = {}
    for row in months:
        years.setdefault(row["Year"], []).append(row["Month"])
    touched = F.lit(False)
    for year, its in years.items():
        touched |= _is("Year", [year]) & _is("Month", its)
    kept = _matching(stored.where(touched), changed, ["Ticker", "Date"], "left_anti")
    return changed.unionByName(kept, allowMissingColumns=True)


def _is(column: str, values: list[int | None]) -> Column:
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known


def _matching(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Rows of ``df`` with or without a match in ``other``; NULL keys match each other."""
    names = {k: f"_other_{k}" for k in keys}
    few = other.select(*[F.col(k).alias(o) for k, o in names.items()])
    on = [F.col(k).eqNullSafe(F.col(o)) for k, o in names.items()]
    return df.join(few, on, how)


def _place() -> Column:
    """Dates as they are ordered: NULL before all."""
    return F.coalesce("Date", F.lit(""))


def _staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` in scratch: what follows overwrites what it was read from."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
