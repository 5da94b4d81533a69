"""Operators: plain functions from DataFrames to a DataFrame."""

from terracelake.operators.aggregates import cube_count
from terracelake.operators.buckets import ntile
from terracelake.operators.joins import fanout_counts, join_to_unique, safe_key_join
from terracelake.operators.ordering import top_k
from terracelake.operators.predicates import (
    contains_any, date_between, epoch_between, is_one_of, not_like_any,
)
from terracelake.operators.unions import union_all

__all__ = [
    "contains_any", "cube_count", "date_between", "epoch_between", "fanout_counts", "is_one_of",
    "join_to_unique", "not_like_any", "ntile", "safe_key_join", "top_k", "union_all",
]
