"""Session settings and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_test_folders: dict[str, str] = {}


# Settings the operators count on. A skewed join is split even where a grouping on the same key
# follows (that grouping then gets its own shuffle, with a map-side combine before it), and a batch
# for a Python worker is bounded by its bytes, not only by its rows.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 * 1024 * 1024),
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that was started elsewhere."""
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def build_session(app: str = "linkwright", cores: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster job brings its own session."""
    cores = cores or os.cpu_count() or 1
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **RUNTIME,
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Run streams with the RocksDB state store, and leave the session's own choice as it was."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only for a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _test_folders:
        _test_folders[context.applicationId] = tempfile.mkdtemp(prefix="linkwright-")
    return _test_folders[context.applicationId]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of what is run inside as soon as it has run, not when the driver next collects its garbage.

    For steps that are written, whose shuffles nothing else reads. Spark before 4.1 does not know the setting and keeps the files.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def written(df: DataFrame, name: str = "step", codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the stored rows.

    Cuts the lineage, so lost executors never rerun what led here, and every later use reads the same
    rows. The size on disk is known to Spark, which then broadcasts the frame in a join if it is below
    the broadcast threshold and shuffles it if not. ``codec`` compresses a step that is large.
    """
    path = fresh_path(df.sparkSession, name)
    writer = df.write if codec is None else df.write.option("compression", codec)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package() -> None:
    """Send this package's functions to the tasks by value, for a session started without it on its path.

    Not needed where the package is installed or submitted with ``--py-files``.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
