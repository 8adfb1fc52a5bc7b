"""An outbox that shows whole batches only: files are written by the tasks, and one manifest per batch makes them count."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from linkwright.streaming.places import opened

SINK = "committed_parquet"
#: Bytes of rows that a task holds to write them as one row group.
GROUP_BYTES = 16 * 1024 * 1024
MANIFEST = "batch_id bigint, file string, rows bigint"


@dataclass
class TaskFile(WriterCommitMessage):
    """What a task wrote; no file for a task without rows."""

    file: str | None
    rows: int


class CommittedWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str) -> None:
        self._path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> TaskFile:
        """One file per task, under a name of its own, so that a task tried twice leaves a file that nothing names."""
        system, folder = opened(self._path)
        name = f"{uuid.uuid4().hex}.parquet"
        hidden, writer, rows, held = f"{folder}/data/_{name}", None, 0, []
        try:
            for batch in iterator:
                if batch.num_rows:
                    writer = writer or pq.ParquetWriter(hidden, batch.schema, filesystem=system, compression="zstd")
                    held.append(batch)
                    rows += batch.num_rows
                if sum(b.nbytes for b in held) >= GROUP_BYTES:
                    writer.write_table(pa.Table.from_batches(held))
                    held = []
            if held:
                writer.write_table(pa.Table.from_batches(held))
        finally:
            if writer:
                writer.close()
        if writer is None:
            return TaskFile(None, 0)
        system.move(hidden, f"{folder}/data/{name}")
        return TaskFile(name, rows)

    def commit(self, messages: list[TaskFile | None], batchId: int) -> None:
        """Name the files of a batch in one step. A repeated batch replaces the manifest of its first try."""
        system, folder = opened(self._path)
        entries = [{"batch_id": batchId, "file": m.file, "rows": m.rows} for m in messages if m and m.file]
        hidden = f"{folder}/commits/_{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as out:
            out.write("".join(json.dumps(e) + "\n" for e in entries).encode())
        system.move(hidden, f"{folder}/commits/{batchId:012d}.json")

    def abort(self, messages: list[TaskFile | None], batchId: int) -> None:
        """Take away what the tasks that ended have written."""
        system, folder = opened(self._path)
        for m in messages:
            if m and m.file:
                system.delete_file(f"{folder}/data/{m.file}")


class CommittedParquet(DataSource):
    """Option: ``path``, a folder made by ``prepare``."""

    @classmethod
    def name(cls) -> str:
        return SINK

    def streamWriter(self, schema: StructType, overwrite: bool) -> CommittedWriter:
        return CommittedWriter(self.options["path"])


def prepare(path: str) -> str:
    """Make the two folders of an outbox where they are missing."""
    system, folder = opened(path)
    for part in ("data", "commits"):
        system.create_dir(f"{folder}/{part}", recursive=True)
    return path


def write_committed(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start a stream into an outbox; without ``every`` it works off what is there and stops.

    An outbox belongs to one checkpoint, since batches are told apart by their number. No batch reads what earlier ones
    wrote; the driver gets one file name per task.
    """
    stream.sparkSession.dataSource.register(CommittedParquet)
    writer = stream.writeStream.format(SINK).option("path", prepare(path)).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def read_committed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all committed batches, with ``batch_id``; files that no manifest names are left out.

    Before the first commit there are no rows.
    """
    named = spark.read.schema(MANIFEST).json(f"{prepare(path)}/commits").select(F.col("file").alias("_file"), "batch_id")
    rows = spark.read.schema(schema).parquet(f"{path}/data").select("*", F.col("_metadata.file_name").alias("_file"))
    return rows.join(named, "_file").drop("_file")
