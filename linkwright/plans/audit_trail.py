"""Two snapshots to audit log to mail outbox to processed marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.operators.changes import audit_rows, pending_batch, snapshot_diff
from linkwright.operators.notify import with_subject, with_table_message
from linkwright.operators.skew import surrogate_key
from linkwright.session import written


def audit_log(before: DataFrame, after: DataFrame, key: str, question: str, answer: str,
              only_changed: bool = False, time: Column | None = None, user: Column | None = None, first: int = 1) -> DataFrame:
    """Numbered audit rows for the changes between two states."""
    diff = snapshot_diff(before, after, key, [question, answer], only_changed)
    rows = audit_rows(diff, key, question, answer, time, user)
    return surrogate_key(rows, ["QuestionaireID"], "AuditLogID", first)


def mails(audit: DataFrame) -> DataFrame:
    """(message_key, channel, subject, body) for audit rows."""
    return with_table_message(with_subject(audit), "body").select(
        F.col("AuditLogID").cast("string").alias("message_key"), F.lit("mail").alias("channel"), "subject", "body")


def work_off(audit: DataFrame, processed: DataFrame | None = None, size: int = 20) -> tuple[DataFrame, DataFrame]:
    """The mails of the next batch, and the ids to append to the table of processed ones.

    The batch is stored first, so mails and ids are of the same rows.
    """
    batch = written(pending_batch(audit, "AuditLogID", size, processed), "batch")
    return mails(batch), batch.select("AuditLogID")
