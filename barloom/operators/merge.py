"""Full outer merge of several tables on common keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.headers import check_unique
from barloom.operators.skew import HOT_ROWS, PARTS, TABLE, hot_keys_and_rows, mark_hot, spread

_MAX_CELLS = 8192
# Measured: below this many columns the chain of joins is faster.
_WIDE = 32
_KEY = ["_hash", "_key"]
_CELL = "_cell"


def suffix_overlaps(
    tables: Mapping[str, DataFrame], keys: Sequence[str]
) -> dict[str, DataFrame]:
    """Give non-key columns that occur in several tables the suffix ``_<table name>``."""
    seen: dict[str, int] = {}
    for df in tables.values():
        for c in _measures(df, keys):
            seen[c.lower()] = seen.get(c.lower(), 0) + 1
    renamed = {
        name: df.withColumnsRenamed(
            {c: f"{c}_{name}" for c in _measures(df, keys) if seen[c.lower()] > 1}
        )
        for name, df in tables.items()
    }
    check_unique([*keys, *(c for df in renamed.values() for c in _measures(df, keys))])
    return renamed


def outer_merge(
    tables: Mapping[str, DataFrame],
    keys: Sequence[str],
    null_safe: bool = True,
    unique_keys: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Full outer join of all ``tables`` on ``keys``, one coalesced copy of each key.

    Duplicate keys multiply rows. With ``null_safe`` NULL keys match each other,
    otherwise a row with a NULL key stays alone. ``unique_keys`` promises that no
    table repeats a key; the merge is then a single grouping.
    """
    keys = list(keys)
    tables = suffix_overlaps(tables, keys)
    columns = [*keys, *(c for df in tables.values() for c in _measures(df, keys))]
    parts = []
    if not null_safe:
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        parts = [df.where(~whole) for df in tables.values()]
        tables = {name: df.where(whole) for name, df in tables.items()}
    if unique_keys:
        merged = _merge_unique(tables, keys)
    else:
        hot, size = hot_keys_and_rows(tables, keys, hot_rows)
        if hot is not None:
            few = hot.select(*keys).distinct()
            parts.append(_merge_hot(tables, keys, hot))
            tables = {n: mark_hot(df, few, keys, "left_anti") for n, df in tables.items()}
        merged = _merge(tables, keys, size)
    return _stack([merged, *parts]).select(*columns)


def _merge_unique(tables: Mapping[str, DataFrame], keys: list[str]) -> DataFrame:
    names = {n: f"_rows_{n}" for n in tables}
    stacked = _stack([df.withColumn(names[n], F.lit(1)) for n, df in tables.items()])
    measures = [c for c in _measures(stacked, keys) if c not in names.values()]
    merged = stacked.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in measures], *[F.sum(c).alias(c) for c in names.values()]
    )
    # A broken promise must not pass: the larger of two values would be a made-up row.
    most = F.greatest(*[F.coalesce(c, F.lit(0)) for c in names.values()], F.lit(0))
    broken = F.when(most > 1, F.raise_error(F.lit("unique_keys: a table repeats a key")))
    return merged.where(broken.cast("string").isNull()).drop(*names.values())


def _merge(tables: Mapping[str, DataFrame], keys: list[str], size: int) -> DataFrame:
    """Full outer joins one after the other, or left joins from the list of all keys.

    A chain of full outer joins shuffles and sorts its growing intermediate result
    again at every further step. The list of keys keeps its partitioning and order
    through all left joins, so each table moves once, at the price of moving the keys
    too: that pays once the intermediate rows are wide.

    Where ``size``, the rows of all tables, is too much for the session's number of shuffle
    partitions, the rows are dealt out beforehand, to as many tasks as they call for.
    """
    keyed = [_with_key(df, keys) for df in tables.values()]
    # A side that lies in fewer partitions than the session has would be shuffled again.
    enough = int(keyed[0].sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = [spread(df.drop(*keys), size, _KEY, enough) for df in keyed]
    carried = sum(len(_measures(df, keys)) for df in list(tables.values())[:-1])
    if len(rows) > 2 and carried >= _WIDE:
        spine = spread(_stack([df.select(*_KEY) for df in keyed]), size, _KEY, enough).distinct()
        merged = reduce(lambda a, b: a.join(b, _KEY, "left"), rows, spine)
    else:
        merged = reduce(lambda a, b: a.join(b, _KEY, "full_outer"), rows)
    return merged.select(*_keys_back(keys), *_all_measures(tables, keys))


def _merge_hot(
    tables: Mapping[str, DataFrame], keys: list[str], hot: DataFrame
) -> DataFrame:
    """Merge the rows of hot keys, each key's rows dealt over a grid of cells.

    The grid has one dimension per table: a row sits at one coordinate of its own
    dimension and is repeated along the others, so each combination of rows meets in
    exactly one cell. The cells are left-joined like the list of keys above, since
    Spark can split neither side of a skewed full outer join.
    """
    names = list(tables)
    grid = _grid(hot, names, keys)
    keyed = {
        n: _with_key(mark_hot(df, grid, keys, "inner"), keys) for n, df in tables.items()
    }
    join = [*_KEY, _CELL]

    spine = _stack(
        [
            keyed[n].select(
                *_KEY,
                F.explode(_cells(names)).alias(_CELL),
                *[F.lit(n == m).alias(f"_has_{m}") for m in names],
            )
            for n in names
        ]
    )
    merged = spine.groupBy(*join).agg(*[F.max(f"_has_{n}").alias(f"_has_{n}") for n in names])
    for n in names:
        # A hash of the row is the coordinate, so that a key whose rows all come from
        # one task is spread; the input partition is added to split copies of a row.
        # Both are the same on a retried task.
        row = F.xxhash64(*keys, *_measures(tables[n], keys))
        at = F.pmod(row + F.spark_partition_id(), F.col(f"_parts_{n}"))
        dealt = keyed[n].withColumn("_at", at).select(
            *_KEY,
            F.explode(_cells(names, n)).alias(_CELL),
            *_measures(tables[n], keys),
            F.lit(True).alias(f"_in_{n}"),
        )
        merged = merged.join(dealt, join, "left")
    # A table that has the key has it in some cells; the other cells are no results.
    for n in names:
        merged = merged.where(F.col(f"_in_{n}").isNotNull() | ~F.col(f"_has_{n}"))
    return merged.select(*_keys_back(keys), *_all_measures(tables, keys))


def _grid(hot: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """Hot keys with the size ``_parts_<table>`` of their grid in each dimension."""
    sized = hot.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(TABLE) == n, F.col(PARTS)).otherwise(1)).alias(f"_parts_{n}")
            for n in names
        ],
        F.count("*").alias("_dimensions"),
    )
    # A key that is hot in several tables shares the cells between the dimensions.
    side = F.floor(F.pow(F.lit(float(_MAX_CELLS)), 1.0 / F.col("_dimensions")) + 1e-9)
    return sized.select(
        *keys,
        *[F.least(f"_parts_{n}", side).cast("int").alias(f"_parts_{n}") for n in names],
    )


def _cells(names: list[str], own: str | None = None) -> Column:
    """All cells of a key's grid, or those at coordinate ``_at`` of dimension ``own``."""
    sizes = {n: F.col(f"_parts_{n}") for n in names}
    total = _product(list(sizes.values()))
    cells = F.sequence(F.lit(0), total - 1)
    if own is not None:
        stride = _product([sizes[n] for n in names[: names.index(own)]])
        cells = F.filter(
            cells,
            lambda c: F.floor(c / stride).cast("int") % sizes[own] == F.col("_at"),
        )
    return cells


def _product(factors: list[Column]) -> Column:
    return reduce(lambda a, b: a * b, factors, F.lit(1))


def _with_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Add the keys as a struct, in which NULL equals NULL, and its hash, which sorts fast."""
    return df.withColumns({"_hash": F.xxhash64(*keys), "_key": F.struct(*keys)})


def _keys_back(keys: list[str]) -> list[Column]:
    return [F.col("_key").getField(k).alias(k) for k in keys]


def _all_measures(tables: Mapping[str, DataFrame], keys: list[str]) -> list[str]:
    return [c for df in tables.values() for c in _measures(df, keys)]


def _measures(df: DataFrame, keys: Sequence[str]) -> list[str]:
    names = {k.lower() for k in keys}
    return [c for c in df.columns if c.lower() not in names]


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
