"""Column-level functions."""

from barloom.functions import metrics
from barloom.functions.headers import check_unique, clean_header, clean_headers, has_column
from barloom.functions.projection import project

__all__ = [
    "check_unique",
    "clean_header",
    "clean_headers",
    "has_column",
    "metrics",
    "project",
]
