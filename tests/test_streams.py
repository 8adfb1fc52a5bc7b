from datetime import datetime, timedelta

from pyspark.sql import functions as F

from linkwright.streaming import capture, feed, relay
from tests.conftest import rows

DOCS = "k string, doc string"


def add(spark, path, data, schema, name):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def stream(spark, path, schema):
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("recursiveFileLookup", True).parquet(path)


def test_feed_goes_on_after_bad_documents_and_keeps_its_place(spark, tmp_path):
    src, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    add(spark, src, [("1", '{"id":"a"}'), ("2", "{broken")], DOCS, "f1")
    feed.classify_feed(stream(spark, src, DOCS), "doc", "k", out, mark, drain=True).awaitTermination()
    add(spark, src, [("3", '{"id":"c"}')], DOCS, "f2")
    feed.classify_feed(stream(spark, src, DOCS), "doc", "k", out, mark, drain=True).awaitTermination()
    assert rows(spark.read.parquet(f"{out}/outbox").filter("channel = 'mail'"), "message_key", "batch_id") == [("1", 0), ("3", 1)]
    assert rows(spark.read.parquet(f"{out}/dead_letters"), "k", "error") == [("2", "not a JSON object")]


def test_a_repeated_batch_replaces_its_first_try(spark, tmp_path):
    out = str(tmp_path / "out")
    batch = spark.createDataFrame([(1,), (2,)], "n int")
    feed.write_batch(batch, out, 3)
    feed.write_batch(batch, out, 3)
    assert spark.read.parquet(out).count() == 2


def test_index_log_reads_the_newest_row(spark, tmp_path):
    src, store, mark = str(tmp_path / "in"), str(tmp_path / "store"), str(tmp_path / "mark")
    schema = "k string, v string, n int"
    for name, data in (("f1", [("a", "1", 1), ("b", "1", 1), ("b", "2", 2)]), ("f2", [("a", "9", 1), ("c", "1", 1)])):
        add(spark, src, data, schema, name)
        feed.index_feed(stream(spark, src, schema), "k", [F.col("n").desc()], store, mark, drain=True).awaitTermination()
    assert rows(feed.current_index(spark, store, "k"), "k", "v") == [("a", "9"), ("b", "2"), ("c", "1")]


def test_audit_feed_sends_what_is_not_notified(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = ("AuditLogID bigint, QuestionaireID bigint, OldQuestion string, NewQuestion string, OldAnswer string, NewAnswer string, "
              "ActionTaken string, ActionTimestamp timestamp, ActionUser string, IsNotified boolean")
    when = datetime(2024, 1, 15, 10, 30)
    add(spark, src, [(1, 5, None, "q", None, "a", "INSERT", when, "u", False), (2, 6, None, "q", None, "a", "INSERT", when, "u", True)], schema, "f")
    feed.audit_feed(stream(spark, src, schema), "AuditLogID", out, str(tmp_path / "mark"), drain=True).awaitTermination()
    got = spark.read.parquet(f"{out}/outbox").collect()
    assert [(r["message_key"], r["subject"]) for r in got] == [("1", "Questionnaire Change: INSERT on ID 5")]
    assert "2024-01-15 10:30:00 UTC" in got[0]["body"]


def test_an_audit_row_delivered_again_is_mailed_once(spark, tmp_path):
    src, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    schema = ("AuditLogID bigint, QuestionaireID bigint, OldQuestion string, NewQuestion string, OldAnswer string, NewAnswer string, "
              "ActionTaken string, ActionTimestamp timestamp, ActionUser string, IsNotified boolean")

    def row(n):
        return (n, n, None, "q", None, "a", "INSERT", datetime(2024, 1, 15), "u", False)

    for name, ids in (("f1", [1, 1, 2]), ("f2", [2, 3]), ("f3", [1, 2, 3])):
        add(spark, src, [row(n) for n in ids], schema, name)
        feed.audit_feed(stream(spark, src, schema), "AuditLogID", out, mark, drain=True).awaitTermination()
    assert rows(spark.read.parquet(f"{out}/outbox"), "message_key", "batch_id") == [("1", 0), ("2", 0), ("3", 1)]


def capture_files(spark, tmp_path, files, schema, **options):
    src, out, mark = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "mark")
    for name, data in files:
        add(spark, src, data, schema, name)
        (capture.capture_changes(stream(spark, src, schema), **options).writeStream.format("parquet").option("checkpointLocation", mark)
         .trigger(availableNow=True).start(out).awaitTermination())
    return spark.read.parquet(out)


def test_captured_steps_span_batches(spark, tmp_path):
    schema = "id bigint, seq bigint, question string, answer string, deleted boolean"
    got = capture_files(spark, tmp_path, [
        ("f1", [(1, 2, "q", "b", False), (1, 1, "q", "a", False), (2, 1, "z", None, False)]),
        ("f2", [(1, 3, None, None, True), (1, 4, "q", "c", False), (3, 1, None, None, True)])], schema)
    assert rows(got, "id", "seq", "old_answer", "new_answer", "action") == [
        (1, 1, None, "a", "INSERT"), (1, 2, "a", "b", "UPDATE"), (1, 3, "b", None, "DELETE"), (1, 4, None, "c", "INSERT"),
        (2, 1, None, None, "INSERT")]


def test_captured_columns_may_be_any_and_late_rows_are_named(spark, tmp_path):
    schema = "k string, seq int, price double, deleted boolean"
    got = capture_files(spark, tmp_path, [
        ("f1", [("a", 5, 1.5, False), ("b", 1, None, None)]), ("f2", [("a", 4, 9.0, False), ("a", 6, None, True), ("b", 2, 2.0, False)])],
        schema, key="k", columns=["price"])
    assert rows(got, "k", "seq", "old_price", "new_price", "action") == [
        ("a", 4, None, "9.0", "LATE"), ("a", 5, None, "1.5", "INSERT"), ("a", 6, "1.5", None, "DELETE"),
        ("b", 1, None, None, "INSERT"), ("b", 2, None, "2.0", "UPDATE")]


def test_relay_answers_in_time_and_times_out(spark, tmp_path):
    asked, given, out = str(tmp_path / "asked"), str(tmp_path / "given"), str(tmp_path / "out")
    schema, t0 = "request_id string, text string, ts timestamp", datetime(2024, 1, 1)
    end = ("end", "", t0 + timedelta(hours=1))
    add(spark, asked, [("r1", "one", t0), ("r2", "two", t0), ("r3", "three", t0), end], schema, "f")
    add(spark, given, [("r1", "yes", t0 + timedelta(seconds=30)), ("r2", "late", t0 + timedelta(seconds=31)), end], schema, "f")
    matched = relay.match_responses(stream(spark, asked, schema), stream(spark, given, schema))
    query = (matched.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start(out))
    query.awaitTermination()
    got = {r["request_id"]: (r["response_text"], r["status"]) for r in spark.read.parquet(out).collect()}
    assert got["r1"] == ("yes", 200) and got["r2"] == (None, 504) and got["r3"] == (None, 504)
