"""Unions of many DataFrames."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Stacks by position and keeps duplicates; types widen (int, double: double).

    For many files of one shape prefer ``sources.read_tagged_csv``: one scan.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("union_all needs at least one DataFrame")
    return reduce(DataFrame.union, frames)
