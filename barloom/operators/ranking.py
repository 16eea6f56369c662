"""Exact percent ranks inside large groups."""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.skew import HOT_ROWS

_MAX_SIDE = 64
_SPREAD = 4096
_MAX_GROUPS = 1000
_PRESENT = "_present"


def percent_ranks(
    df: DataFrame, group: str, ranks: Mapping[str, str], hot_rows: int | None = HOT_ROWS
) -> DataFrame:
    """Add ``percent_rank`` columns, ``{metric: new column}``, within each ``group``.

    Only rows with all metrics present are ranked; the others get NULL. ``group`` must
    have calendar cardinality (years): a few numbers per group are broadcast while there
    are at most ``_MAX_GROUPS`` groups, and joined otherwise. While every group fits a task, plain windows do the work; their size is counted
    first, unless ``hot_rows`` is None, which says that every group does.
    """
    present = reduce(lambda a, b: a & b, [F.col(m).isNotNull() for m in ranks])
    marked = df.withColumn(_PRESENT, present)
    sizes = marked.groupBy(group, _PRESENT).agg(F.count("*").alias("_n"))
    if hot_rows is None:
        return _plain_ranks(marked, group, ranks).select(*df.columns, *ranks.values())
    seen = sizes.agg(F.max("_n").alias("most"), F.count_distinct(group).alias("groups")).first()
    largest, few = seen["most"] or 0, seen["groups"] <= _MAX_GROUPS
    if largest <= hot_rows:
        ranked = _plain_ranks(marked, group, ranks)
    else:
        side = min(_MAX_SIDE, math.ceil(math.sqrt(largest / max(hot_rows, 1))))
        ranked = _bucketed_ranks(marked, group, ranks, side, few)
    return ranked.select(*df.columns, *ranks.values())


def _plain_ranks(df: DataFrame, group: str, ranks: Mapping[str, str]) -> DataFrame:
    return df.withColumns(
        {name: _if_present(_plain_rank(group, m)) for m, name in ranks.items()}
    )


def _plain_rank(group: str, metric: str) -> Column:
    return F.percent_rank().over(Window.partitionBy(group, _PRESENT).orderBy(metric))


def _if_present(rank: Column) -> Column:
    return F.when(F.col(_PRESENT), rank)


def _bucketed_ranks(
    df: DataFrame, group: str, ranks: Mapping[str, str], side: int, few: bool
) -> DataFrame:
    """Ranks without a group ever being in one task.

    ``side * side`` quantiles cut each metric into buckets. A bucket between two cuts
    holds a small share of the group and is ranked by a window; its offset is the
    number of rows in lower buckets. All rows equal to a cut are a bucket of their own
    and tie, so they are spread by input partition, like the rows without a rank. The
    ranks are exact wherever the cuts fall.
    """
    metrics = list(ranks)
    cuts = _cuts(df.where(_PRESENT), group, metrics, side)
    cut = _with_buckets(df, cuts, group, metrics, side, few)
    below = _rows_below(cut.where(_PRESENT), cuts, group, metrics, side)
    # Only numbers, not the arrays they come from, travel through the shuffles.
    lower = {
        f"_lower_{m}": F.element_at(F.col(f"_below_{m}"), F.col(f"_bucket_{m}") + 1)
        for m in metrics
    }
    # By the row, as all rows of a group may come from one task, and by the input
    # partition, which parts copies of a row.
    row = F.xxhash64(*[c for c in df.columns if c != _PRESENT])
    spread = F.pmod(row + F.spark_partition_id(), F.lit(_SPREAD))
    out = (
        _join_group(cut, below, group, few)
        .withColumns({**lower, "_spread": spread})
        .drop(*[f"_below_{m}" for m in metrics])
    )
    for m, name in ranks.items():
        between = F.col(_PRESENT) & (F.col(f"_bucket_{m}") % 2 == 0)
        window = Window.partitionBy(group, f"_bucket_{m}", _PRESENT, "_salt").orderBy(m)
        before = F.col(f"_lower_{m}") + F.rank().over(window) - F.lit(1)
        share = F.try_divide(before.cast("double"), F.col("_rows") - F.lit(1))
        out = out.withColumn("_salt", F.when(~between, F.col("_spread"))).withColumn(
            name, _if_present(F.coalesce(share, F.lit(0.0)))
        )
    return out


def _cuts(df: DataFrame, group: str, metrics: list[str], side: int) -> DataFrame:
    """Per group and metric ``side * side`` sorted quantiles, as rows of ``side``."""
    n = side * side
    shares = F.lit(np.arange(1, n + 1) / (n + 1))
    flat = df.groupBy(group).agg(
        *[F.percentile_approx(m, shares, 10_000).alias(f"_cuts_{m}") for m in metrics]
    )
    return flat.select(group, *[_in_rows(f"_cuts_{m}", side) for m in metrics])


def _in_rows(cuts: str, side: int) -> Column:
    starts = F.sequence(F.lit(1), F.lit(side * side), F.lit(side))
    return F.transform(starts, lambda at: F.slice(F.col(cuts), at, side)).alias(cuts)


def _with_buckets(
    df: DataFrame, cuts: DataFrame, group: str, metrics: list[str], side: int, few: bool
) -> DataFrame:
    return _join_group(df, cuts, group, few).withColumns(
        {f"_bucket_{m}": _bucket(F.col(m), F.col(f"_cuts_{m}"), side) for m in metrics}
    ).drop(*[f"_cuts_{m}" for m in metrics])


def _bucket(value: Column, cuts: Column, side: int) -> Column:
    """Even, ``2 * (number of cuts below)``, between two cuts; one more on a cut."""
    row = F.size(F.filter(cuts, lambda r: F.element_at(r, side) < value))
    cells = F.when(row < side, F.element_at(cuts, row + 1)).otherwise(
        F.array().cast("array<double>")
    )
    lower = row * side + F.size(F.filter(cells, lambda c: c < value))
    return lower * 2 + F.array_contains(cells, value).cast("int")


def _rows_below(
    df: DataFrame, cuts: DataFrame, group: str, metrics: list[str], side: int
) -> DataFrame:
    """Per group its row count and, per metric, the rows below bucket 0, 1, ... as array."""
    entries = [
        F.struct(F.lit(m).alias("_metric"), F.col(f"_bucket_{m}").alias("_bucket"))
        for m in metrics
    ]
    filled = df.select(group, F.inline(F.array(*entries)), F.lit(1).alias("_n"))
    empty = cuts.select(
        group, F.explode(F.array(*[F.lit(m) for m in metrics])).alias("_metric")
    ).select(
        group,
        "_metric",
        F.explode(F.sequence(F.lit(0), F.lit(2 * side * side))).alias("_bucket"),
        F.lit(0).alias("_n"),
    )
    sizes = filled.unionByName(empty).groupBy(group, "_metric", "_bucket").agg(
        F.sum("_n").alias("_n")
    )
    lower = Window.partitionBy(group, "_metric").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sums = sizes.withColumn("_below", F.coalesce(F.sum("_n").over(lower), F.lit(0)))
    entry = F.struct("_bucket", "_below")
    return sums.groupBy(group).agg(
        F.sum(F.when(F.col("_metric") == metrics[0], F.col("_n"))).alias("_rows"),
        *[
            F.sort_array(F.collect_list(F.when(F.col("_metric") == m, entry)))
            .getField("_below")
            .alias(f"_below_{m}")
            for m in metrics
        ],
    )


def _join_group(df: DataFrame, small: DataFrame, group: str, few: bool) -> DataFrame:
    other = small.withColumnRenamed(group, "_group")
    other = F.broadcast(other) if few else other
    return df.join(other, F.col(group).eqNullSafe(F.col("_group")), "left").drop("_group")
