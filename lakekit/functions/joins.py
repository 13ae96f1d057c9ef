"""Joins on keys that may be null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_same(df: DataFrame, other: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns of equal names; null keys match each other."""
    renamed = other.withColumnsRenamed({key: f"_same_{key}" for key in on})
    same = reduce(Column.__and__, [F.col(key).eqNullSafe(F.col(f"_same_{key}")) for key in on])
    return df.join(renamed, same, how).drop(*[f"_same_{key}" for key in on])
