"""Merging the three statements into one row per ticker and report date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom import schemas
from barloom.functions.headers import clean_headers
from barloom.operators.merge import outer_merge
from barloom.operators.saved import merge_saved, save_statements as save_alike


def merge_statements(
    income: DataFrame, balance: DataFrame, cashflow: DataFrame, **options
) -> DataFrame:
    """Full outer merge on ticker and report date; options as in ``outer_merge``."""
    tables = {"income": income, "balance": balance, "cashflow": cashflow}
    cleaned = {name: clean_headers(df) for name, df in tables.items()}
    return outer_merge(cleaned, schemas.STATEMENT_KEYS, **options)


def save_statements(
    income: DataFrame, balance: DataFrame, cashflow: DataFrame, database: str, **options
) -> None:
    """Save the statements in ``database`` for :func:`merge_saved_statements`."""
    tables = {"income": income, "balance": balance, "cashflow": cashflow}
    cleaned = {name: clean_headers(df) for name, df in tables.items()}
    save_alike(cleaned, database, schemas.STATEMENT_KEYS, **options)


def merge_saved_statements(spark: SparkSession, database: str, **options) -> DataFrame:
    """:func:`merge_statements` of saved statements, without a shuffle."""
    return merge_saved(spark, list(schemas.STATEMENTS), database, schemas.STATEMENT_KEYS, **options)
