"""Row-frame windows over a key's ordered history."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.operators.skew import HOT_ROWS, PARTS, hot_keys_and_rows, mark_hot, spread
from barloom.scratch import scratch_dir

_BLOCK = "_block"
_TIE = "_tie"
_LEAD_IN = "_lead_in"

Measures = Callable[[WindowSpec], dict[str, Column]]


def over_history(
    df: DataFrame,
    measures: Measures,
    depth: int,
    key: str = "Ticker",
    order: str = "Date",
    reads: Sequence[str] = ("Close",),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add window ``measures`` that look at most ``depth`` rows back.

    ``measures`` gets the window (one ``key``, ascending ``order``) and returns the
    new columns. ``reads`` names every column that they read. ``(key, order)`` should
    be unique; ties are ordered by ``reads``.

    The rows are shuffled once, by ``key``, to tasks of about equal size however many rows
    there are. Only keys that are too big for a task,
    which are looked for first, take another way: :func:`_over_blocks`.
    """
    hot, rows = hot_keys_and_rows({"": df}, [key], hot_rows)
    reads = list(reads)
    window = Window.partitionBy(key).orderBy(order, *reads)
    if hot is None:
        return spread(df, rows, [key]).withColumns(measures(window))
    big = hot.select(key)
    others = spread(mark_hot(df, big, [key], "left_anti"), rows, [key]).withColumns(measures(window))
    histories = mark_hot(df, big, [key], "left_semi")
    blocks = sum(row[PARTS] for row in hot.collect())
    return others.unionByName(
        _over_blocks(histories, measures, depth, blocks, key, order, reads)
    )


def _over_blocks(
    df: DataFrame,
    measures: Measures,
    depth: int,
    blocks: int,
    key: str,
    order: str,
    reads: list[str],
) -> DataFrame:
    """Windows over histories that are cut into ordered blocks of about equal size.

    Each block is led in by copies of the last ``depth`` rows before it, so every frame
    holds the same values in the same order as in one long window. The blocks are
    ranges of the sort order and are written down, because the lead-ins and the rows
    themselves must see the same cuts. The input partition, which a retried task does
    not change, breaks ties: it lets the cuts fall between rows with the same key,
    order and read values, and such rows are alike to the measures.
    """
    sort = [order, *reads, _TIE]
    ranged = (
        df.withColumn(_TIE, F.spark_partition_id())
        .repartitionByRange(blocks, key, *sort)
        .withColumn(_BLOCK, F.spark_partition_id())
    )
    path = scratch_dir(df.sparkSession, "history")
    ranged.write.parquet(path)
    cut = df.sparkSession.read.parquet(path)

    rows = cut.withColumn(_LEAD_IN, F.lit(False)).unionByName(
        _lead_in(cut, depth, key, sort), allowMissingColumns=True
    )
    windows = rows.withColumns(measures(Window.partitionBy(key, _BLOCK).orderBy(*sort)))
    return windows.where(~F.col(_LEAD_IN)).drop(_BLOCK, _TIE, _LEAD_IN)


def _lead_in(cut: DataFrame, depth: int, key: str, sort: list[str]) -> DataFrame:
    """For every block the last ``depth`` rows of the blocks before it.

    A row at place ``_back`` from the end of its block belongs to a later block if the
    blocks in between leave room for it. Which blocks can be reached at all is found on
    one row per block, so a block gets ``depth`` rows however long or short the others
    are.
    """
    newest = Window.partitionBy(key, _BLOCK).orderBy(*[F.desc(c) for c in sort])
    ends = (
        cut.select(key, _BLOCK, *sort)
        .withColumn("_back", F.row_number().over(newest))
        .where(F.col("_back") <= depth)
    )
    until = Window.partitionBy(key).orderBy(_BLOCK)
    sizes = cut.groupBy(key, _BLOCK).agg(F.count("*").alias("_n"))
    sums = sizes.withColumn("_end", F.sum("_n").over(until))
    # The blocks that follow one, with the rows between: those that ``depth`` reaches.
    after = until.rowsBetween(1, depth)
    following = F.collect_list(F.struct(F.col(_BLOCK).alias("to"), (F.col("_end") - F.col("_n")).alias("start")))
    reach = sums.select(
        F.col(key).alias("_of"),
        F.col(_BLOCK).alias("_from"),
        F.filter(following.over(after), lambda b: b["start"] - F.col("_end") < depth).alias("_next"),
        "_end",
    )
    same = F.col(key).eqNullSafe(F.col("_of")) & (F.col(_BLOCK) == F.col("_from"))
    room = lambda b: b["start"] - F.col("_end") + F.col("_back") <= depth
    moved = ends.join(reach, same).select(
        key, F.explode(F.filter("_next", room)).alias("_to"), *sort
    )
    return moved.select(key, F.col("_to.to").alias(_BLOCK), *sort, F.lit(True).alias(_LEAD_IN))
