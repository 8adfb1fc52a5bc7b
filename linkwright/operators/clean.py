"""Joins of the raw tables and defaults for missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def blank_defaults(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null becomes the empty text in the named columns."""
    return rows.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in columns})


def left_chain(first: DataFrame, *steps: tuple[DataFrame, str]) -> DataFrame:
    """Left equi-joins on same-named keys, one after the other; the join key of each step stays."""
    joined = first
    for right, key in steps:
        joined = joined.join(right, key, "left")
    return joined


def null_safe_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join in which a null key matches null keys; rows fan out over all matches."""
    other = right.withColumnRenamed(key, f"_right_{key}")
    return left.join(other, F.col(key).eqNullSafe(F.col(f"_right_{key}")), "left").drop(f"_right_{key}")


def in_states(rows: DataFrame, column: str, states: Sequence[str]) -> DataFrame:
    return rows.filter(F.col(column).isin(*states))
