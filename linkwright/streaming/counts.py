"""Running counts by label over a stream of element states: what changes a label takes one from the old and gives one to the new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from linkwright.streaming.capture import capture_changes
from linkwright.streaming.feed import run, write_batch

_ROWS = "kind string, label string, change bigint, batch_id bigint"


def count_steps(steps: DataFrame) -> DataFrame:
    """(kind, label, change): what captured steps of elements add to and take from every count; zeros are left out.

    A null kind or label is counted as such. LATE steps change nothing, since a newer state of the element is counted.
    """
    had, has = F.col("action").isin("UPDATE", "DELETE"), F.col("action").isin("INSERT", "UPDATE")
    one = F.array(
        F.struct(F.col("old_kind").alias("kind"), F.col("old_label").alias("label"), F.when(had, -1).alias("change")),
        F.struct(F.col("new_kind").alias("kind"), F.col("new_label").alias("label"), F.when(has, 1).alias("change")))
    return (steps.select(F.inline(one)).filter(F.col("change").isNotNull())
            .groupBy("kind", "label").agg(F.sum("change").cast("bigint").alias("change")).filter("change <> 0"))


def count_feed(stream: DataFrame, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Follow a stream of (id, seq, deleted, kind, label); every batch writes one row per count that it changes.

    The stream's state holds the last kind and label of each id, so no batch reads what earlier ones wrote, and an element
    delivered again counts once. A repeated batch replaces its first try. ``id`` tells all elements apart, of whatever kind.
    Needs the RocksDB state store.
    """
    steps = capture_changes(stream, "id", ("kind", "label"))
    return run(steps, lambda rows, batch: write_batch(count_steps(rows), out, batch), checkpoint, **options)


def counts_after(spark: SparkSession, out: str, batch: int | None = None) -> DataFrame:
    """(kind, label, n) after a batch, or after the last one; labels without elements are left out."""
    rows = spark.read.schema(_ROWS).parquet(out)
    if batch is not None:
        rows = rows.filter(F.col("batch_id") <= batch)
    return rows.groupBy("kind", "label").agg(F.sum("change").alias("n")).filter("n <> 0")
