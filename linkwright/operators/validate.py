"""Key checks, orphan reports and placeholder parents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the row count. Counts are combined map-side."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose reference is set but has no parent row."""
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return child.filter(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("_parent"), "left_anti")


def placeholder_parents(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str, title: str, **fixed: Column
) -> DataFrame:
    """The parent table with one stub row per missing key; the rest of a stub's columns are null."""
    missing = child.select(F.col(key).alias(parent_key)).filter(F.col(parent_key).isNotNull()).distinct()
    missing = missing.join(parent.select(parent_key), parent_key, "left_anti")
    text = F.concat(F.lit("Placeholder for "), F.col(parent_key).cast("string"))
    stubs = missing.select(parent_key, text.alias(title), *[v.alias(n) for n, v in fixed.items()])
    return parent.unionByName(stubs, allowMissingColumns=True)
