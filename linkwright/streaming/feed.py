"""Change feeds: a file stream with stored progress, handled batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from linkwright.operators import notify
from linkwright.operators.skew import first_row

POLL = "5 seconds"
AUDIT_POLL = "5 minutes"


def read_feed(
    spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
    files_per_trigger: int = 1000, name_filter: str | None = None,
) -> DataFrame:
    """A stream over the files of a folder; ``files_per_trigger`` bounds the size of a batch."""
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_trigger)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def run(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    every: str = POLL, drain: bool = False,
) -> StreamingQuery:
    """Start ``handle`` on every batch. ``drain`` works off what is there and stops."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=every)).start()


def batch_folder(path: str, batch: int) -> str:
    return f"{path}/batch_id={batch}"


def write_batch(rows: DataFrame, path: str, batch: int) -> None:
    """Write one batch to its own folder. A repeated batch replaces its first try."""
    rows.write.mode("overwrite").parquet(batch_folder(path, batch))


def copy_feed(stream: DataFrame, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Store every changed document as it comes."""
    return run(stream, lambda rows, batch: write_batch(rows, out, batch), checkpoint, **options)


def classify_feed(stream: DataFrame, document: str, key: str, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Changed graph documents to an outbox; unreadable ones to a dead-letter table, the rest go on."""

    def handle(rows: DataFrame, batch: int) -> None:
        done = notify.classify(rows, document).persist()
        try:
            write_batch(notify.outbox_rows(done, key), f"{out}/outbox", batch)
            write_batch(notify.dead_letters(done), f"{out}/dead_letters", batch)
        finally:
            done.unpersist()

    return run(stream, handle, checkpoint, **options)


def audit_feed(stream: DataFrame, key: str, out: str, checkpoint: str, **options) -> StreamingQuery:
    """Audit rows not yet notified to an outbox of mails, each once.

    The stream's state keeps the keys that were sent, so a row delivered again, in the same batch or a later one, is left
    out and no batch reads what earlier ones wrote. A repeated batch finds the state as it was before its first try, and
    replaces what that wrote.
    """
    def handle(rows: DataFrame, batch: int) -> None:
        mails = notify.with_table_message(notify.with_subject(rows), "body").selectExpr(
            f"CAST({key} AS STRING) AS message_key", "'mail' AS channel", "subject", "body")
        write_batch(mails, f"{out}/outbox", batch)

    options.setdefault("every", AUDIT_POLL)
    return run(stream.filter("NOT IsNotified").dropDuplicates([key]), handle, checkpoint, **options)


def index_feed(stream: DataFrame, key: str, newest: list, store: str, checkpoint: str, **options) -> StreamingQuery:
    """Append batches of chunks to an index log, one row per key and batch.

    The cost of a batch is that of its own rows; readers take the newest row per key.
    """
    return run(stream, lambda rows, batch: write_batch(first_row(rows, [key], newest), store, batch), checkpoint, **options)


def current_index(spark: SparkSession, store: str, key: str) -> DataFrame:
    """The newest row per key of an index log."""
    rows = spark.read.parquet(store)
    return first_row(rows, [key], [F.col("batch_id").desc()]).drop("batch_id")
