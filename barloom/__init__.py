"""Batch analysis of company statements and daily prices on Spark."""

from barloom.plans import *  # noqa: F401,F403
from barloom.plans import __all__  # noqa: F401
