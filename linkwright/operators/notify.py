"""Notification texts for audit rows and changed graph documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.functions import fixed_text as fixed
from linkwright.functions.values import first_present, first_printed, has_key, json_record, printed_fields, printed_flag, utc_text

FIELDS = ["OldQuestion", "NewQuestion", "OldAnswer", "NewAnswer"]
CHANGE_FIELDS = ["id", "label", "_isEdge", "inV", "outV", "inVLabel", "outVLabel", "_sink", "_vertexId"]


def _column_fields(audit: DataFrame) -> dict[str, Column]:
    """Printed values of the audit columns; a null prints as ``None``."""
    def shown(name: str) -> Column:
        value = F.col(name)
        if name == "ActionTimestamp" and audit.schema[name].dataType.typeName().startswith("timestamp"):
            value = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
        return F.coalesce(value.cast("string"), F.lit("None"))
    return {n: shown(n) for n in ["ActionTaken", "QuestionaireID", "ActionTimestamp", "ActionUser", *FIELDS]}


def _json_fields(record: Column, document: Column, absent: str) -> dict[str, Column]:
    head = {n: "N/A" for n in ["ActionTaken", "QuestionaireID", "ActionTimestamp", "ActionUser"]}
    return {n: first_present(record, [n], default) for n, default in {**head, **dict.fromkeys(FIELDS, absent)}.items()}


def _table(fields: dict[str, Column]) -> Column:
    head = fixed.render(fixed.TABLE_HEAD, action=fields["ActionTaken"], id=fields["QuestionaireID"],
                        time=utc_text(fields["ActionTimestamp"]), user=fields["ActionUser"])
    body = fixed.details(fixed.TABLE_ROW, fixed.TABLE_GROUP, fixed.TABLE_OTHER, fields["ActionTaken"], fields)
    return F.concat(head, body, F.lit(fixed.TABLE_TAIL))


def _list(fields: dict[str, Column]) -> Column:
    head = fixed.render(fixed.LIST_HEAD, action=fields["ActionTaken"], id=fields["QuestionaireID"],
                        time=fields["ActionTimestamp"], user=fields["ActionUser"])
    body = fixed.details(fixed.LIST_ROW, fixed.LIST_GROUP, "", fields["ActionTaken"], fields)
    return F.concat(head, body, F.lit(fixed.LIST_TAIL))


def with_table_message(audit: DataFrame, out: str = "generated_email_body") -> DataFrame:
    return audit.withColumn(out, _table(_column_fields(audit)))


def with_list_message(audit: DataFrame, out: str = "generated_email_body") -> DataFrame:
    return audit.withColumn(out, _list(_column_fields(audit)))


def with_subject(audit: DataFrame, out: str = "subject") -> DataFrame:
    fields = _column_fields(audit)
    return audit.withColumn(out, fixed.render(fixed.AUDIT_SUBJECT, action=fields["ActionTaken"], id=fields["QuestionaireID"]))


def json_messages(records: DataFrame, document: str, layout: str = "table") -> DataFrame:
    """Message for each audit record given as JSON text; a missing field differs from a null one."""
    record = F.col("_record")
    parsed = records.withColumn("_record", json_record(F.col(document)))
    if layout == "table":
        message = F.when(record.isNotNull(), _table(_json_fields(record, F.col(document), "N/A")))
    else:
        failed = fixed.render(fixed.LIST_ERROR, error="not a JSON object", record=F.coalesce(F.col(document), F.lit("None")))
        message = F.when(record.isNotNull(), _list(_json_fields(record, F.col(document), ""))).otherwise(failed)
    return parsed.withColumn("message", message).drop("_record")


# --- changed graph documents --------------------------------------------------------------------

def classify(documents: DataFrame, document: str) -> DataFrame:
    """Kind, ids, subject and message of each changed document; ``error`` for one that is no JSON object.

    A document is an edge if its edge flag is set or one of the two pairs of end fields is present.
    """
    record, unknown = F.col("_record"), fixed.UNKNOWN
    parsed = documents.withColumn("_record", printed_fields(json_record(F.col(document)), CHANGE_FIELDS))
    edge = printed_flag(record, "_isEdge") | has_key(record, "inV", "outV") | has_key(record, "_sink", "_vertexId")
    parts = parsed.select(
        *documents.columns,
        F.when(record.isNull(), F.lit("not a JSON object")).alias("error"),
        F.when(record.isNotNull(), F.when(edge, "edge").otherwise("vertex")).alias("kind"),
        first_printed(record, ["id"], unknown["id"]).alias("element_id"),
        first_printed(record, ["label"], unknown["label"]).alias("label"),
        first_printed(record, ["outVLabel"], unknown["outVLabel"]).alias("source_label"),
        first_printed(record, ["inVLabel"], unknown["inVLabel"]).alias("target_label"),
        first_printed(record, ["outV", "_vertexId"], unknown["source"]).alias("source_id"),
        first_printed(record, ["inV", "_sink"], unknown["target"]).alias("target_id"),
    )
    is_edge, good = F.col("kind") == "edge", F.col("error").isNull()
    named = {"id": F.col("element_id"), "label": F.col("label")}
    ends = {c: F.col(c) for c in ("source_label", "source_id", "target_label", "target_id")}
    return parts.select(
        *documents.columns, "kind",
        F.when(good, F.col("element_id")).alias("element_id"), F.when(good, F.col("label")).alias("label"),
        F.when(is_edge, F.col("source_id")).alias("source_id"), F.when(is_edge, F.col("target_id")).alias("target_id"),
        F.when(good, F.when(is_edge, fixed.render(fixed.EDGE_SUBJECT, **named))
               .otherwise(fixed.render(fixed.VERTEX_SUBJECT, **named))).alias("subject"),
        F.when(good, F.when(is_edge, fixed.render(fixed.EDGE_MESSAGE, **named, **ends))
               .otherwise(fixed.render(fixed.VERTEX_MESSAGE, **named))).alias("message"),
        "error",
    )


def outbox_rows(classified: DataFrame, key: str) -> DataFrame:
    """One chat and one mail row per good document, keyed by (message_key, channel)."""
    good = classified.filter(F.col("error").isNull()).select(
        F.col(key).cast("string").alias("message_key"), "subject", "message",
        F.to_json(F.struct(F.col("message").alias("text"))).alias("_chat"))
    start = len('{"text":') + 1
    quoted = F.substring("_chat", F.lit(start), F.length("_chat") - start)
    mail = F.concat(F.lit("<strong>"), F.col("message"), F.lit("</strong><p>Raw Document: <pre>"), quoted, F.lit("</pre></p>"))
    channels = F.array(
        F.struct(F.lit("chat").alias("channel"), F.lit(None).cast("string").alias("subject"), F.col("_chat").alias("body")),
        F.struct(F.lit("mail").alias("channel"), F.col("subject"), mail.alias("body")),
    )
    return good.select("message_key", F.inline(channels))


def new_outbox_rows(rows: DataFrame, sent: DataFrame) -> DataFrame:
    """Outbox rows not written before; repeats within the batch are dropped."""
    return rows.dropDuplicates(["message_key", "channel"]).join(sent.select("message_key", "channel"), ["message_key", "channel"], "left_anti")


def dead_letters(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("error").isNotNull())


