"""An index log in sorted runs: a batch adds one run, and runs of a level are merged into one of the next.

With F runs to a merge there are at most F - 1 runs per level and a level more for F times the batches, so a read touches
few runs however many batches came; a row is rewritten once per level. A manifest names the runs that count, with the
range of keys in each of their files; it is put in place in one step after the files, so a batch that was stopped leaves only
files that nothing names, and a repeated batch is told by its number.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from linkwright.operators.skew import first_row
from linkwright.streaming.feed import run
from linkwright.streaming.places import opened, visible

FAN = 8
BATCH = "_batch_id"
#: Manifests kept for readers that have just looked one up.
KEPT_MANIFESTS = 10


@dataclass
class Run:
    """A folder of rows sorted by key; ``files`` are (name, smallest key, largest key), without keys where all are null."""

    name: str
    level: int
    files: list[tuple]


@dataclass
class Manifest:
    """The runs that count, oldest first, and the last batch in them."""

    version: int = 0
    last_batch: int = -1
    schema: str | None = None
    runs: list[Run] = field(default_factory=list)


def _versions(store: str) -> list[str]:
    system, folder = opened(store)
    system.create_dir(f"{folder}/manifests", recursive=True)
    found = system.get_file_info(fs.FileSelector(f"{folder}/manifests"))
    return sorted(f.path for f in found if visible(f.base_name))


def manifest(store: str) -> Manifest:
    """The newest manifest; an empty one for a new store."""
    found = _versions(store)
    if not found:
        return Manifest()
    with opened(store)[0].open_input_stream(found[-1]) as stream:
        stored = json.loads(stream.read())
    return Manifest(**{**stored, "runs": [Run(r["name"], r["level"], [tuple(f) for f in r["files"]]) for r in stored["runs"]]})


def _commit(store: str, new: Manifest) -> None:
    system, folder = opened(store)
    hidden = f"{folder}/manifests/_{uuid.uuid4().hex}"
    with system.open_output_stream(hidden) as out:
        out.write(json.dumps(asdict(new)).encode())
    system.move(hidden, f"{folder}/manifests/{new.version:012d}.json")
    for old in _versions(store)[:-KEPT_MANIFESTS]:
        system.delete_file(old)


def _sorted_run(rows: DataFrame, store: str, key: str, level: int) -> Run:
    """Write rows as a new run; the driver gets the key range of each of its files."""
    name = f"run-{uuid.uuid4().hex}"
    path = f"{store}/{name}"
    rows.repartitionByRange(key).sortWithinPartitions(key).write.parquet(path)
    stored = rows.sparkSession.read.schema(rows.schema).parquet(path)
    ranges = stored.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return Run(name, level, sorted((r["file"], r["low"], r["high"]) for r in ranges.collect()))


def _read(spark: SparkSession, store: str, schema: str, runs: Sequence[Run]) -> DataFrame:
    return spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(*[f"{store}/{r.name}" for r in runs])


def due(levels: Sequence[int], fan: int) -> int | None:
    """The lowest level with ``fan`` runs, which are then merged."""
    return min((level for level in set(levels) if list(levels).count(level) >= fan), default=None)


def add_batch(rows: DataFrame, batch: int, store: str, key: str, newest: Sequence[Column | str], fan: int = FAN) -> None:
    """Add the newest row per key of a batch; a batch that is in the store already changes nothing.

    The key is a number or a text; rows with a null key are one key. An empty batch only moves the number on. There
    is one writer per store.
    """
    state = manifest(store)
    if batch <= state.last_batch:
        return
    spark = rows.sparkSession
    own = first_row(rows, [key], newest).withColumn(BATCH, F.lit(batch).cast("bigint"))
    state.schema = state.schema or own.schema.json()
    fresh = _sorted_run(own, store, key, 0)
    if fresh.files:
        state.runs.append(fresh)
    while (level := due([r.level for r in state.runs], fan)) is not None:
        parts = [r for r in state.runs if r.level == level]
        merged = first_row(_read(spark, store, state.schema, parts), [key], [F.col(BATCH).desc()])
        # Higher levels are older, so the merged run stands behind them and before the lower ones.
        older = [r for r in state.runs if r.level > level]
        newer = [r for r in state.runs if r.level < level]
        state.runs = [*older, _sorted_run(merged, store, key, level + 1), *newer]
    state.version, state.last_batch = state.version + 1, batch
    _commit(store, state)


def index_runs(
    stream: DataFrame, key: str, newest: Sequence[Column | str], store: str, checkpoint: str, fan: int = FAN, **options
) -> StreamingQuery:
    """Feed a stream into the runs of a store; one store belongs to one checkpoint."""
    return run(stream, lambda rows, batch: add_batch(rows, batch, store, key, newest, fan), checkpoint, **options)


def current(spark: SparkSession, store: str, key: str) -> DataFrame:
    """The newest row per key. A store without rows cannot be read, since it has no schema yet."""
    state = manifest(store)
    if state.schema is None:
        raise ValueError(f"no batch has come to {store}")
    if not state.runs:
        return spark.createDataFrame([], StructType.fromJson(json.loads(state.schema))).drop(BATCH)
    return first_row(_read(spark, store, state.schema, state.runs), [key], [F.col(BATCH).desc()]).drop(BATCH)


def lookup(spark: SparkSession, store: str, key: str, values: Sequence) -> DataFrame:
    """The newest rows of some keys, read only from files whose range holds one of them."""
    state = manifest(store)
    if state.schema is None:
        raise ValueError(f"no batch has come to {store}")
    near = [f"{store}/{r.name}/{file}" for r in state.runs for file, low, high in r.files
            if low is not None and any(low <= v <= high for v in values)]
    schema = StructType.fromJson(json.loads(state.schema))
    if not near:
        return spark.createDataFrame([], schema).drop(BATCH)
    rows = spark.read.schema(schema).parquet(*near).filter(F.col(key).isin(list(values)))
    return first_row(rows, [key], [F.col(BATCH).desc()]).drop(BATCH)


def unnamed(store: str) -> list[str]:
    """Folders of runs that the newest manifest does not name: merged ones and those of stopped batches."""
    system, folder = opened(store)
    named = {r.name for r in manifest(store).runs}
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted(f.path for f in found if f.base_name.startswith("run-") and f.base_name not in named)
