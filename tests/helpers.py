"""Comparison and plan helpers for the tests."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame


def rows(df: DataFrame) -> list[tuple]:
    """Rows in a stable order; NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=_order)


def _order(row: tuple) -> list:
    return [(v is not None, str(type(v)), v if v is not None else 0) for v in row]


def same(left, right, tolerance: float = 1e-9) -> bool:
    """Equal values, doubles within a relative tolerance; nested sequences allowed."""
    if isinstance(left, (list, tuple)) and isinstance(right, (list, tuple)):
        return len(left) == len(right) and all(same(a, b, tolerance) for a, b in zip(left, right))
    if isinstance(left, float) and isinstance(right, (int, float)):
        return math.isclose(left, right, rel_tol=tolerance, abs_tol=tolerance)
    return left == right


def plan(df: DataFrame) -> str:
    """The physical plan as first made, before adaptive execution changes it."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def optimized(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
