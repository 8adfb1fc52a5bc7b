"""Change capture between two states of a table, and the audit rows that follow from it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.functions.values import real_change
from linkwright.session import written

CHECK_BUCKETS = 65_536
MOST_BUCKETS = 1 << 20


def snapshot_diff(
    before: DataFrame, after: DataFrame, key: str, columns: Sequence[str], only_changed: bool = False
) -> DataFrame:
    """One row per inserted, deleted or kept key: (key, old_*, new_*, action).

    A key in both states is an UPDATE even if nothing differs; ``only_changed`` leaves those out,
    with null and the empty text counted as the same. A changed key is a DELETE and an INSERT.
    """
    old = before.select(F.col(key).alias("_old"), *[F.col(c).alias(f"old_{c}") for c in columns])
    new = after.select(F.col(key).alias("_new"), *[F.col(c).alias(f"new_{c}") for c in columns])
    action = F.when(F.col("_old").isNull(), "INSERT").when(F.col("_new").isNull(), "DELETE").otherwise("UPDATE")
    rows = old.join(new, F.col("_old") == F.col("_new"), "full_outer").withColumn("action", action)
    if only_changed:
        changed = reduce(lambda a, b: a | b, [real_change(F.col(f"old_{c}"), F.col(f"new_{c}")) for c in columns])
        rows = rows.filter((F.col("action") != "UPDATE") | changed)
    pairs = [f"{side}_{c}" for c in columns for side in ("old", "new")]
    return rows.select(F.coalesce("_old", "_new").alias(key), *pairs, "action")


def checksums(rows: DataFrame, key: str, columns: Sequence[str], buckets: int = CHECK_BUCKETS) -> DataFrame:
    """What tells two snapshots apart, per bucket of keys: (bucket, n, total, mixed), at most ``buckets`` rows.

    Free of order, combined map-side: rows counted, one hash summed up, another one put together by exclusive or. Null and the
    empty text count as the same, as in ``snapshot_diff``. Small enough to be kept with a snapshot for the next diff.
    """
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    row = F.xxhash64(F.lit(0), F.col(key), *values).cast("decimal(20,0)")
    return rows.groupBy(_bucket(key, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(row).alias("total"), F.bit_xor(F.xxhash64(F.lit(1), F.col(key), *values)).alias("mixed"))


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets))


def differing(before: DataFrame, after: DataFrame) -> DataFrame:
    """The buckets whose checksums differ, or that only one of two snapshots has."""
    old = before.select("bucket", F.struct("n", "total", "mixed").alias("_old"))
    new = after.select("bucket", F.struct("n", "total", "mixed").alias("_new"))
    return old.join(new, "bucket", "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select("bucket")


def checked_diff(
    before: DataFrame, after: DataFrame, key: str, columns: Sequence[str], buckets: int = CHECK_BUCKETS,
    before_sums: DataFrame | None = None,
) -> DataFrame:
    """``snapshot_diff`` with ``only_changed``, comparing rows only where checksums per bucket of keys differ.

    Rows of buckets that are alike stay where they are read; with ``before_sums``, the stored ``checksums`` of the earlier
    snapshot by the same columns and buckets, that snapshot is read once. The buckets to open are at most ``buckets`` numbers
    and are sent to all tasks. Pays where changes are few: one changed key opens its bucket. Keys are unique within a
    snapshot; rows with a null key are always compared. Two different buckets pass as alike if a sum and an exclusive or of
    independent 64-bit hashes both agree.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"buckets are sent to all tasks: 1 to {MOST_BUCKETS}, not {buckets}")
    sums = checksums(before, key, columns, buckets) if before_sums is None else before_sums
    opened = written(differing(sums, checksums(after, key, columns, buckets)), "buckets")

    def touched(rows: DataFrame) -> DataFrame:
        picked = rows.select(key, *[c for c in columns if c != key])
        kept = picked.filter(F.col(key).isNotNull()).join(
            F.broadcast(opened.withColumnRenamed("bucket", "_bucket")), _bucket(key, buckets) == F.col("_bucket"), "left_semi")
        return kept.unionByName(picked.filter(F.col(key).isNull()))

    return snapshot_diff(touched(before), touched(after), key, columns, True)


def apply_diff(before: DataFrame, diff: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The later state: the earlier one without the touched keys, plus inserted and updated rows."""
    kept = before.select(key, *columns).join(diff.select(key), key, "left_anti")
    fresh = diff.filter(F.col("action") != "DELETE").select(key, *[F.col(f"new_{c}").alias(c) for c in columns])
    return kept.unionByName(fresh)


def audit_rows(diff: DataFrame, key: str, question: str, answer: str, time: Column | None = None,
               user: Column | None = None) -> DataFrame:
    """Audit rows of a diff over a question and an answer column, not yet notified."""
    return diff.select(
        F.col(key).alias("QuestionaireID"),
        F.col(f"old_{question}").alias("OldQuestion"), F.col(f"new_{question}").alias("NewQuestion"),
        F.col(f"old_{answer}").alias("OldAnswer"), F.col(f"new_{answer}").alias("NewAnswer"),
        F.col("action").alias("ActionTaken"),
        (F.current_timestamp() if time is None else time).alias("ActionTimestamp"),
        (F.current_user() if user is None else user).alias("ActionUser"),
        F.lit(False).alias("IsNotified"),
    )


def pending_batch(audit: DataFrame, key: str, size: int = 20, processed: DataFrame | None = None) -> DataFrame:
    """The next batch of rows not yet notified, oldest first: a top-k, not a sort.

    ``processed`` is a table with the keys of the batches worked off so far; it grows by a batch at a time, so the log
    itself is never rewritten.
    """
    open_ = audit.filter(~F.col("IsNotified"))
    if processed is not None:
        done = processed.select(F.col(key).alias("_done")).distinct()
        open_ = open_.join(done, F.col(key) == F.col("_done"), "left_anti")
    return open_.orderBy(key).limit(size)


def mark_notified(audit: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The audit table as a reader sees it: with the processed ids flagged."""
    ids = done.select(F.col(key).alias("_done")).distinct()
    return audit.join(ids, F.col(key) == F.col("_done"), "left").withColumn(
        "IsNotified", F.col("IsNotified") | F.col("_done").isNotNull()).drop("_done")
