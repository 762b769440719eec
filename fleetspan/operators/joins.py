"""Joins in which null is a key like any other."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal keys, nulls included. ``how`` is left, inner, left_semi or left_anti; the left side's keys stay."""
    named = {k: f"_right_{i}" for i, k in enumerate(keys)}
    other = right.select(*[F.col(k).alias(n) for k, n in named.items()], *[c for c in right.columns if c not in named])
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[n]) for k, n in named.items()])
    return left.join(other, same, how).drop(*named.values())
