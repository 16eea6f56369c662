"""Readers."""

from barloom.sources.drift import read_drifting
from barloom.sources.files import (
    read_balance,
    read_cashflow,
    read_csv,
    read_income,
    read_parquet,
    read_prices,
    read_statement,
)
from barloom.sources.rejects import (
    Delivery,
    all_rejects,
    deliver_prices,
    deliver_statement,
    reject_counts,
)

__all__ = [
    "Delivery",
    "all_rejects",
    "deliver_prices",
    "deliver_statement",
    "read_balance",
    "read_cashflow",
    "read_csv",
    "read_drifting",
    "read_income",
    "read_parquet",
    "read_prices",
    "read_statement",
    "reject_counts",
]
