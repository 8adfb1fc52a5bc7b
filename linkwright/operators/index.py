"""Keyed stores of documents and chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.operators.skew import first_row
from linkwright.operators.validate import duplicate_keys


def upsert(stored: DataFrame, batch: DataFrame, key: str, newest: Sequence[Column | str]) -> DataFrame:
    """Stored rows whose key is not in the batch, plus the newest batch row per key.

    Only the batch is ranked; the store is read once past an anti-join on the batch keys.
    """
    rows = first_row(batch, [key], newest)
    kept = stored.join(batch.select(F.col(key).alias("_new")), F.col(key) == F.col("_new"), "left_anti")
    return kept.select(*stored.columns).unionByName(rows.select(*stored.columns))


def insert_only(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The rows to append; a key repeated in the batch or already stored is an error."""
    clash = duplicate_keys(batch, [key]).select(key).unionByName(
        batch.select(key).join(stored.select(key), key, "left_semi"))
    example = clash.limit(1).collect()
    if example:
        raise ValueError(f"duplicate key {example[0][key]!r}")
    return batch


def document_rows(rows: DataFrame, key: str, text: str, metadata: Sequence[str]) -> DataFrame:
    """Documents as (_id, text, metadata map)."""
    pairs = [p for c in metadata for p in (F.lit(c), F.col(c).cast("string"))]
    return rows.select(F.col(key).alias("_id"), F.col(text).alias("text"), F.create_map(*pairs).alias("metadata"))
