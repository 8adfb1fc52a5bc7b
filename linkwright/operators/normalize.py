"""Normal tables from the wide raw ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkwright.functions.text import split_list
from linkwright.operators.skew import first_row


def entity_core(rows: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per business key, the first in order, without the repeated link columns."""
    picked = rows.select(*dict.fromkeys([key, *columns, *order]))
    return first_row(picked, [key], order).select(key, *[c for c in columns if c != key])


def link_rows(rows: DataFrame, source: str, target: str, kind: str) -> DataFrame:
    """Distinct (source, target, kind) where target and kind are both set."""
    return (
        rows.filter(F.col(target).isNotNull() & F.col(kind).isNotNull())
        .select(source, target, kind).distinct()
    )


def watcher_rows(rows: DataFrame, key: str, user: str) -> DataFrame:
    """Distinct (key, user) where a user is set."""
    return rows.filter(F.col(user).isNotNull()).select(key, user).distinct()


def status_log(rows: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Every status row of every key."""
    return rows.select(key, *columns)


def current_state(rows: DataFrame, key: str, created: str, order: Sequence[str]) -> DataFrame:
    """The latest status row per key; of several on the same date, the last in order."""
    return first_row(rows, [key], [F.col(created).desc_nulls_last(), *[F.col(c).desc() for c in order]])


def value_rows(rows: DataFrame, key: str, column: str, sep: str = ";") -> DataFrame:
    """Child table of a delimited column: key, 1-based ordinal, value."""
    return (
        rows.select(key, F.posexplode(split_list(F.col(column), sep)).alias("ordinal", "value"))
        .withColumn("ordinal", (F.col("ordinal") + 1).cast("bigint"))
    )


def listed_values(parts: DataFrame, keys: Sequence[str], column: str, out: str, sep: str = ";") -> DataFrame:
    """Values of delimited texts that come in parts (keys, part_no, column): keys, 1-based ordinal in the whole text, value."""
    values = parts.withColumn("_values", split_list(F.col(column), sep))
    before = Window.partitionBy(*keys).orderBy("part_no").rowsBetween(Window.unboundedPreceding, -1)
    counted = values.withColumn("_before", F.coalesce(F.sum(F.size("_values")).over(before), F.lit(0)))
    return counted.select(*keys, "_before", F.posexplode("_values").alias("_at", out)).select(
        *keys, (F.col("_before") + F.col("_at") + 1).cast("bigint").alias("ordinal"), out)
