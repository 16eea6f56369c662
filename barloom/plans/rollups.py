"""Reports from stored partial aggregates, one set per partition of the table they cover.

A partition's rows are reduced once to states that can be merged: sums, counts, least and
greatest values, and sketches of distinct values. A report merges states when it is read,
at the keys they were stored by or at coarser ones. When partitions change, their states
are made again and no other row of the table is read.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.plans.quality import FUNDAMENTALS_ROWS, FUNDAMENTALS_TICKERS, PRICES_ROWS, PRICES_TICKERS
from barloom.plans.reports import ANNUAL_KEYS, ANNUAL_MEASURES, MONTHLY_KEYS, MONTHLY_MEASURES
from barloom.sinks import lake

#: Buckets of a distinct sketch as a power of two. The standard error is 1.04 / 2**(this / 2).
SKETCH_BITS = 14
#: An estimate is within this part of the exact number but for 3 of 1,000 cases.
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_BITS / 2)

_CALL = re.compile(r"(avg|sum|min|max|count|distinct)\((\*|\w+)\)")
_ROWS = "_rows"


@dataclass(frozen=True)
class Rollup:
    """Measures by name over ``keys``; ``parts`` are the keys that name a partition.

    A measure is ``avg``, ``sum``, ``min``, ``max`` or ``distinct`` (an estimate) of a
    column, or ``count(*)``.
    """

    keys: Sequence[str]
    measures: Mapping[str, str]
    parts: Sequence[str]
    _calls: dict[str, tuple[str, str]] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        calls = {name: _CALL.fullmatch(text) for name, text in self.measures.items()}
        wrong = [self.measures[name] for name, call in calls.items() if call is None]
        if wrong or not set(self.parts) <= set(self.keys):
            raise ValueError(f"no measures of a rollup: {wrong}; parts must be keys")
        object.__setattr__(self, "_calls", {name: call.groups() for name, call in calls.items()})

    def states(self, rows: DataFrame) -> DataFrame:
        """One row of mergeable states per combination of keys."""
        made = {_ROWS: F.count("*")}
        for kind, column in self._calls.values():
            made.update(_states(kind, column))
        return rows.groupBy(*self.keys).agg(*[c.alias(name) for name, c in made.items()])

    def merged(self, states: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
        """The measures by ``keys``, some of the rollup's own, from stored states."""
        keys = list(self.keys if keys is None else keys)
        final = [_merged(kind, column).alias(name) for name, (kind, column) in self._calls.items()]
        present = states.where(F.col(_ROWS) > 0)
        return present.groupBy(*keys).agg(*final) if keys else present.agg(*final)


def _states(kind: str, column: str) -> dict[str, Column]:
    if column == "*":
        return {}
    if kind == "avg":
        return {f"_sum_{column}": F.sum(column), f"_count_{column}": F.count(column)}
    if kind == "distinct":
        return {f"_distinct_{column}": F.hll_sketch_agg(column, F.lit(SKETCH_BITS))}
    return {f"_{kind}_{column}": getattr(F, kind)(column)}


def _merged(kind: str, column: str) -> Column:
    if column == "*":
        return F.sum(_ROWS)
    if kind == "avg":
        return F.try_divide(F.sum(f"_sum_{column}").cast("double"), F.sum(f"_count_{column}"))
    if kind == "count":
        return F.sum(f"_count_{column}")
    if kind == "distinct":
        return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"_distinct_{column}")), F.lit(0))
    return getattr(F, kind)(f"_{kind}_{column}")


ANNUAL = Rollup(ANNUAL_KEYS, ANNUAL_MEASURES, ("Year",))
MONTHLY = Rollup(MONTHLY_KEYS, MONTHLY_MEASURES, ("Year", "Month"))
_COUNTS = {"rows": "count(*)", "tickers": "distinct(Ticker)"}
FUNDAMENTALS_COUNTS = Rollup(("Year",), _COUNTS, ("Year",))
PRICES_COUNTS = Rollup(("Year", "Month"), _COUNTS, ("Year", "Month"))


def refresh(
    rollup: Rollup, table: DataFrame, path: str, changed: Sequence[tuple] | None = None
) -> str:
    """Store the states of the partitions ``changed`` of ``table``, or of all of them.

    ``changed`` holds values of ``rollup.parts``. Only those partitions are read, and only
    their states are replaced. A partition that has no rows any more leaves an empty state.
    """
    if changed is None:
        # A state of no row, so that there is something to read of an empty table too.
        nothing = table.sparkSession.range(1).select(F.lit(0).cast("long").alias(_ROWS))
        written = rollup.states(table).unionByName(nothing, allowMissingColumns=True)
        return lake.write_partitioned(written, path, rollup.parts)
    changed = sorted(set(changed), key=lambda values: [(v is not None, v) for v in values])
    if not changed:
        return path
    states = rollup.states(table.where(_named(rollup.parts, changed)))
    kinds = {f.name: f.dataType for f in states.schema.fields}
    every = table.sparkSession.createDataFrame(
        changed, ", ".join(f"`{p}` {kinds[p].simpleString()}" for p in rollup.parts)
    )
    empty = every.withColumn(_ROWS, F.lit(0).cast("long"))
    written = states.unionByName(empty, allowMissingColumns=True)
    return lake.write_partitioned(written, path, rollup.parts, lake.OVERWRITE_TOUCHED)


def report(
    spark: SparkSession, rollup: Rollup, path: str, keys: Sequence[str] | None = None
) -> DataFrame:
    """The measures of stored states; reads nothing but those states."""
    states = spark.read.parquet(path)
    whole = [f.name for f in states.schema.fields if f.name in rollup.parts and f.dataType == T.IntegerType()]
    return rollup.merged(states.withColumns({c: F.col(c).cast("long") for c in whole}), keys)


def stored_quality(spark: SparkSession, fundamentals: str, prices: str) -> DataFrame:
    """Row counts, exact, and numbers of tickers, estimated, from stored counts.

    As ``quality_summary(..., approximate=True)``, but the served tables are not read. An
    estimate is within ``SKETCH_ERROR`` of the exact number but for 3 of 1,000 cases.
    """
    names = {fundamentals: (FUNDAMENTALS_COUNTS, FUNDAMENTALS_ROWS, FUNDAMENTALS_TICKERS),
             prices: (PRICES_COUNTS, PRICES_ROWS, PRICES_TICKERS)}
    parts = []
    for path, (rollup, rows, tickers) in names.items():
        totals = report(spark, rollup, path, [])
        pair = lambda label, c: F.struct(F.lit(label).alias("check"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("count"))
        parts.append(totals.select(F.inline(F.array(pair(rows, "rows"), pair(tickers, "tickers")))))
    return parts[0].unionByName(parts[1])


def _named(parts: Sequence[str], changed: Sequence[tuple]) -> Column:
    """Rows of the named partitions, as a condition that prunes directories."""
    found = F.lit(False)
    if len(parts) == 1:
        return _one_of(parts[0], [v for (v,) in changed])
    first: dict = {}
    for value, *rest in changed:
        first.setdefault(value, []).append(tuple(rest))
    for value, rest in first.items():
        found |= _one_of(parts[0], [value]) & _named(parts[1:], rest)
    return found


def _one_of(column: str, values: Sequence) -> Column:
    known = F.col(column).isin([v for v in values if v is not None])
    return known | F.col(column).isNull() if None in values else known
