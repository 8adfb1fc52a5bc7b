import json

import pytest
from pyspark.sql import functions as F

from linkwright.functions import fixed_text as fixed
from linkwright.operators import changes, index, notify
from linkwright.operators.clean import blank_defaults, in_states, left_chain, null_safe_left
from linkwright.operators.embed import embed_rows, embedding, HashedEmbedder
from linkwright.plans import audit_trail
from linkwright.session import written
from tests.conftest import rows

QA = "id bigint, question string, answer string"


@pytest.fixture(scope="module")
def states(spark):
    before = spark.createDataFrame([(1, "q1", "a"), (2, "q2", None), (3, "q3", "a"), (4, "q4", "a")], QA)
    after = spark.createDataFrame([(2, "q2", ""), (3, "q3", "b"), (4, "q4", "a"), (5, "q5", "n")], QA)
    return before, after


def test_diff_between_two_states(states):
    diff = changes.snapshot_diff(*states, "id", ["question", "answer"])
    assert rows(diff, "id", "action") == [(1, "DELETE"), (2, "UPDATE"), (3, "UPDATE"), (4, "UPDATE"), (5, "INSERT")]
    real = changes.snapshot_diff(*states, "id", ["question", "answer"], only_changed=True)
    assert rows(real, "id", "old_answer", "new_answer") == [(1, "a", None), (3, "a", "b"), (5, None, "n")]
    assert rows(changes.apply_diff(states[0], diff, "id", ["question", "answer"])) == rows(states[1])


def test_audit_log_is_worked_off_in_batches(states):
    audit = audit_trail.audit_log(*states, "id", "question", "answer", time=F.lit("2024-01-15T10:30:00Z"), user=F.lit("me"), first=100)
    assert rows(audit, "AuditLogID", "QuestionaireID") == [(100, 1), (101, 2), (102, 3), (103, 4), (104, 5)]
    mails, done = audit_trail.work_off(audit, size=2)
    assert rows(mails, "message_key", "subject") == [("100", "Questionnaire Change: DELETE on ID 1"), ("101", "Questionnaire Change: UPDATE on ID 2")]
    assert "<td>2024-01-15 10:30:00 UTC</td>" in mails.first()["body"]
    later, more = audit_trail.work_off(audit, done, 2)
    assert rows(later, "message_key") == [("102",), ("103",)]
    assert rows(audit_trail.work_off(audit, done.union(more))[1]) == [(104,)]
    marked = changes.mark_notified(audit, done, "AuditLogID")
    assert rows(changes.pending_batch(marked, "AuditLogID"), "AuditLogID") == [(102,), (103,), (104,)]


RECORD = {"ActionTaken": "UPDATE", "QuestionaireID": 7, "ActionTimestamp": "2023-10-27T10:30:00.123", "ActionUser": "u",
          "OldQuestion": "q", "NewQuestion": None, "OldAnswer": "a & b"}


def test_json_record_messages_tell_missing_from_null(spark):
    records = spark.createDataFrame([(1, json.dumps(RECORD)), (2, "{}"), (3, "[1]"), (4, '{"x"')], "k int, doc string")
    table = {r["k"]: r["message"] for r in notify.json_messages(records, "doc").collect()}
    head = fixed.TABLE_HEAD.replace("{action}", "UPDATE").replace("{id}", "7").replace("{time}", "2023-10-27 10:30:00 UTC").replace("{user}", "u")
    assert table[1].startswith(head)
    assert "<td>a & b</td></tr></table><h4>After Change:</h4><table><tr><td><strong>New Question:</strong></td><td>None</td>" in table[1]
    assert "<tr><td><strong>New Answer:</strong></td><td>N/A</td></tr></table><hr>" in table[1]
    assert fixed.TABLE_OTHER in table[2] and table[2].count("<td>N/A</td>") == 4
    assert table[3] is None and table[4] is None
    listed = {r["k"]: r["message"] for r in notify.json_messages(records, "doc", "list").collect()}
    assert "<li><strong>Timestamp:</strong> 2023-10-27T10:30:00.123</li>" in listed[1]
    assert "<p><strong>New Answer:</strong> </p><p>--- End of Notification ---</p>" in listed[1]
    assert listed[4] == 'Error formatting email: not a JSON object\nData received: {"x"'


def test_documents_are_vertices_edges_or_errors(spark):
    docs = {
        "plain": {"id": "v", "label": "CR"}, "flag": {"id": "e", "label": "L", "_isEdge": True, "inVLabel": None},
        "text flag": {"_isEdge": "false"}, "off": {"_isEdge": 0, "id": 3, "label": True},
        "pair": {"id": "e", "inV": "b", "outV": "a", "outVLabel": "X"}, "sink": {"_sink": "t", "_vertexId": None},
        "half": {"inV": "b", "_sink": "c"}, "empty": {},
    }
    data = [(k, json.dumps(d)) for k, d in docs.items()] + [("list", "[]"), ("cut", '{"id":'), ("null", None)]
    got = {r["k"]: r for r in notify.classify(spark.createDataFrame(data, "k string, doc string"), "doc").collect()}
    kinds = {k: r["kind"] for k, r in got.items()}
    assert kinds == {"plain": "vertex", "flag": "edge", "text flag": "edge", "off": "vertex", "pair": "edge", "sink": "edge",
                     "half": "vertex", "empty": "vertex", "list": None, "cut": None, "null": None}
    assert got["plain"]["message"] == "Gremlin Vertex Updated/Created: \n  Label: 'CR' (ID: v)"
    assert got["off"]["subject"] == "Gremlin Vertex Update: True (3)"
    assert got["pair"]["message"].endswith("From: Vertex 'X' (ID: a)\n  To:   Vertex 'UnknownTargetLabel' (ID: b)")
    assert (got["sink"]["source_id"], got["sink"]["target_id"]) == ("None", "t")
    assert "To:   Vertex 'None' (ID: UnknownTargetID)" in got["flag"]["message"]
    assert got["empty"]["message"].endswith("Label: 'Unknown Label' (ID: Unknown ID)")
    assert all(got[k]["error"] and got[k]["message"] is None for k in ("list", "cut", "null"))


def test_outbox_is_written_once_per_key_and_channel(spark):
    done = notify.classify(spark.createDataFrame([("1", '{"id":"a"}'), ("1", '{"id":"a"}'), ("2", '{"id":"b"}')], "k string, doc string"), "doc")
    box = notify.outbox_rows(done, "k")
    sent = spark.createDataFrame([("2", "chat")], "message_key string, channel string")
    assert rows(notify.new_outbox_rows(box, sent), "message_key", "channel") == [("1", "chat"), ("1", "mail"), ("2", "mail")]
    mail = box.filter("channel = 'mail'").first()["body"]
    text = "Gremlin Vertex Updated/Created: \n  Label: 'Unknown Label' (ID: a)"
    assert mail == f"<strong>{text}</strong><p>Raw Document: <pre>{json.dumps(text)}</pre></p>"


def test_index_upsert_and_insert_only(spark):
    stored = spark.createDataFrame([("a", "1"), ("b", "1")], "k string, v string")
    batch = spark.createDataFrame([("b", "2", 1), ("b", "3", 2), ("c", "4", 1)], "k string, v string, n int")
    assert rows(index.upsert(stored, batch, "k", [F.col("n").desc()])) == [("a", "1"), ("b", "3"), ("c", "4")]
    with pytest.raises(ValueError):
        index.insert_only(stored, batch.select("k", "v"), "k")
    with pytest.raises(ValueError):
        index.insert_only(stored, spark.createDataFrame([("a", "9")], "k string, v string"), "k")
    assert index.insert_only(stored, spark.createDataFrame([("z", "9")], "k string, v string"), "k").count() == 1
    assert index.document_rows(stored, "k", "v", ["v"]).first()["metadata"] == {"v": "1"}


def test_joins(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "n int, k string")
    right = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "w")], "k string, v string")
    assert rows(null_safe_left(left, right, "k"), "n", "v") == [(1, "x"), (1, "y"), (2, "w"), (3, None)]
    assert rows(left_chain(left, (right, "k")), "n", "v") == [(1, "x"), (1, "y"), (2, None), (3, None)]
    assert rows(blank_defaults(left, ["k"]), "n", "k") == [(1, "a"), (2, ""), (3, "z")]
    assert rows(in_states(left, "k", ["a", "b"]), "n") == [(1,)]


def test_failed_embedding_batches_lose_only_their_rows(spark):
    def embed(texts):
        if "bad" in texts:
            raise RuntimeError("refused")
        return [[float(len(t)), 1.0] for t in texts]
    texts = spark.createDataFrame([(i, "bad" if i == 3 else f"t{i}") for i in range(10)], "id int, text string").coalesce(1)
    assert rows(embed_rows(texts, embed, batch_size=5), "id") == [(i,) for i in range(5, 10)]
    kept = embed_rows(texts, embed, batch_size=5, keep_failed=True)
    assert kept.filter("error = 'refused' AND embedding IS NULL").count() == 5
    single = {r["id"]: r["e"] for r in texts.withColumn("e", embedding(F.col("text"), embed)).collect()}
    assert single[3] is None and single[4] == [2.0, 1.0]


def test_hashed_embedding_is_a_unit_vector():
    got = HashedEmbedder(16)(["one two three", ""])
    assert abs(float((got[0] ** 2).sum()) - 1) < 1e-9 and not got[1].any()


def _two(spark):
    schema = "id string, q string, n int"
    before = [(f"k{i}", f"text {i}", i) for i in range(400)] + [(None, "x", 1), ("gone", "y", 2), ("blank", "", 3)]
    after = [(f"k{i}", "new" if i == 7 else f"text {i}", i) for i in range(400)] + [(None, "x", 1), ("fresh", None, 2), ("blank", None, 3)]
    return spark.createDataFrame(before, schema), spark.createDataFrame(after, schema)


def test_diff_by_checksums_equals_the_full_one(spark):
    before, after = _two(spark)
    want = rows(changes.snapshot_diff(before, after, "id", ["q", "n"], True))
    for buckets in (1, 8, 5000):
        assert rows(changes.checked_diff(before, after, "id", ["q", "n"], buckets)) == want
    kept = written(changes.checksums(before, "id", ["q", "n"], 64))
    assert rows(changes.checked_diff(before, after, "id", ["q", "n"], 64, kept)) == want
    empty = before.limit(0)
    assert rows(changes.checked_diff(empty, after, "id", ["q", "n"])) == rows(changes.snapshot_diff(empty, after, "id", ["q", "n"], True))
    assert changes.checked_diff(empty, empty, "id", ["q", "n"]).count() == 0


def test_only_buckets_of_changed_keys_are_opened(spark):
    before, after = _two(spark)
    sums = [changes.checksums(t, "id", ["q", "n"], 5000) for t in (before, after)]
    assert changes.differing(*sums).count() == 3  # k7, gone, fresh
    with pytest.raises(ValueError):
        changes.checked_diff(before, after, "id", ["q"], 1 << 21)


def test_printed_fields_are_those_asked_one_by_one(spark):
    from linkwright.functions import values as v
    docs = ['{"id": 1.0, "label": [1, "a\'s", null], "x": 3}', '{"id": null, "label": "", "_isEdge": false}', '{"id": "a", "id": {"k": true}}', "{}",
            '{"_isEdge": [], "id": false}', '{"_isEdge": "yes"}', "[]", "broken {", None]
    names = ["id", "label", "_isEdge"]
    record = spark.createDataFrame([(d,) for d in docs], "d string").withColumn("r", v.json_record(F.col("d"))).withColumn(
        "p", v.printed_fields(F.col("r"), names))
    for wanted in (["id"], ["label", "id"], ["x", "_isEdge"]):
        named = [n for n in wanted if n in names]
        both = record.select(v.first_present(F.col("r"), named, "-").alias("a"), v.first_printed(F.col("p"), named, "-").alias("b"),
                             v.flag(F.col("r"), "_isEdge").alias("c"), v.printed_flag(F.col("p"), "_isEdge").alias("e")).collect()
        assert all(r["a"] == r["b"] and r["c"] == r["e"] for r in both)
