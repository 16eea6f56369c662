"""DataFrame-to-DataFrame operators."""

from barloom.operators.history import over_history
from barloom.operators.lookup import attach_company
from barloom.operators.merge import outer_merge, suffix_overlaps
from barloom.operators.ranking import percent_ranks
from barloom.operators.skew import hot_keys

__all__ = [
    "attach_company",
    "hot_keys",
    "outer_merge",
    "over_history",
    "percent_ranks",
    "suffix_overlaps",
]
