import json

from pyspark.sql import functions as F

from linkwright.llm import chat

TRICKY = ["", "a<b", "</turn>", "<turn>user<says>", "\\", "\\l", "\\s", "\\\\l<", "\\### Assistant: </turn> ok", "é😀\n\x00x", "<says>"]


def turns_of(rows):
    return [(t["role"], t["text"]) for t in rows]


def test_layouts_become_the_same_turns(spark):
    said = [("user", "q <1>"), ("assistant", "a")]
    records = {
        "prompt": {"prompt": "q <1>", "completion": "a"},
        "prompt-response": {"response": "a", "prompt": "q <1>"},
        "question": {"question": "q <1>", "answer": "a"},
        "instruction": {"output": "a", "instruction": "q <1>", "input": None},
        "messages": {"messages": [{"role": "user", "content": "q <1>"}, {"content": "a", "role": "assistant"}]},
        "conversations": {"conversations": [{"from": "human", "value": "q <1>"}, {"from": "gpt", "value": "a"}]},
    }
    rows = [(name, json.dumps(r)) for name, r in records.items()]
    frame = spark.createDataFrame(rows, "name string, json string").select("name", F.parse_json("json").alias("record"))
    got = chat.canonical_turns(frame.withColumn("layout", F.lit("own")), "record").collect()
    assert {r["name"]: r["layout"] for r in got} == {name: name for name in records}
    assert all(turns_of(r["turns"]) == said for r in got)


def test_types_do_not_change_a_fingerprint_but_fields_do(spark):
    texts = ['{"a": 1, "b": [{"c": "x"}]}', '{"b": [{"c": null}, {"c": 2.5}], "a": "y"}', '{"a": 1, "b": [{"d": "x"}]}', '{"a": 1}']
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    prints = [r[0] for r in frame.select(chat.fingerprint(F.parse_json("t"))).collect()]
    assert prints[0] == prints[1] and len(set(prints)) == 3
    shapes = [r[0] for r in frame.select(chat.shape(F.parse_json("t"))).collect()]
    assert shapes[0] == chat.shape_text(["a", "b[].c"])


def test_unknown_null_and_empty_records(spark):
    frame = spark.createDataFrame([('{"x": 1}',), (None,), ('{"messages": []}',), ('{"messages": null}',), ("[1]",), ('{"prompt": null}',)], "t string")
    got = [(r["layout"], r["turns"]) for r in chat.canonical_turns(frame.select(F.parse_json("t").alias("record")), "record").collect()]
    assert got == [(None, None), (None, None), ("messages", []), ("messages", []), (None, None), ("prompt", [])]


def test_marks_in_texts_are_escaped_and_read_back(spark):
    rows = [(k, turn, role, text) for k, text in enumerate(TRICKY) for turn, role in enumerate(["user", "as<sistant\\", "assistant"])]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    talks = chat.conversations(chat.message_records(frame)).select(
        "conv_id", "formatted", chat.parsed(F.col("formatted")).alias("back"), chat.loss_text(F.col("segments")).alias("learnt"))
    for r in talks.collect():
        text = TRICKY[r["conv_id"]]
        assert turns_of(r["back"]) == [("user", text), ("as<sistant\\", text), ("assistant", text)]
        assert r["learnt"] == text
        assert r["formatted"].count("<") == 9 and r["formatted"].endswith("</turn>")


def test_nulls_ties_repeats_long_texts_and_empty_tables(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, None, "assistant", "first"), (2, 0, "user", "same"), (2, 0, "user", "same"),
            (None, 0, "user", "lost"), (3, 0, "assistant", "<" * 200_000)]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("record", F.lit("own"))
    got = {r["conv_id"]: r for r in chat.report(frame).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 3, 2: 2, None: 1, 3: 1}
    assert got[1]["loss_chars"] == 5 and got[3]["loss_chars"] == 200_000
    assert got[3]["formatted_chars"] == 400_000 + len("<turn>assistant<says></turn>")
    assert chat.report(frame.filter("false")).count() == 0


def test_a_record_may_hold_several_turns_of_a_conversation(spark):
    rows = [(1, 2, '{"role": "user", "text": "z"}'), (1, 1, '{"prompt": "p", "completion": "c"}'), (1, 3, '{"odd": 1}')]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, t string").withColumn("record", F.parse_json("t"))
    row, = chat.conversations(frame).collect()
    assert turns_of(row["turns"]) == [("user", "p"), ("assistant", "c"), ("user", "z")]
