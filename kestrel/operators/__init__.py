"""Reusable relational operators (DataFrame in, DataFrame out)."""

from kestrel.operators.dedupe import keep_best
from kestrel.operators.joins import (
    anti_any_key, band_join, conditional_key_join, equi_join, full_outer_null_safe, overlay,
)
from kestrel.operators.stack import align_to, stack_tagged, union_all, union_distinct
from kestrel.operators.rollup import subgroup_counts

__all__ = [
    "keep_best", "anti_any_key", "band_join", "conditional_key_join", "full_outer_null_safe", "overlay",
    "equi_join",
    "align_to", "stack_tagged", "union_all", "union_distinct", "subgroup_counts",
]
