import random
import re

import pytest
from pyspark.sql import functions as F

from linkwright.functions import text as T
from linkwright.functions.values import map_lines, property_map, typed, utc_text
from linkwright.operators.chunks import document_chunks, row_chunks
from tests.conftest import rows


def packed(text, limit):
    """The packing rule, written as it reads."""
    out, running = [], ""
    for sentence in re.split(r"(?<=[.!?]) +", text or ""):
        if len((running + sentence).split()) <= limit:
            running = f"{running} {sentence}"
            continue
        if running:
            out.append(running.strip())
        running = sentence
    return out + ([running.strip()] if running else [])


def random_texts(count):
    rng = random.Random(5)
    pieces = ["a", "bb", "c.", "d!", "e?", " ", "  ", "\n", "\t", "f. ", "...", " ", "　", "é", "x y z", "\x1c", "."]
    return ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 40))) for _ in range(count)]


@pytest.mark.parametrize("limit", [1, 3, 8])
def test_chunks_follow_the_packing_rule(spark, limit):
    texts = [None, "", "a. ", "   ", "one two three four five. ", "one. two. three.", "a.\nb. c", *random_texts(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    found = {}
    for r in document_chunks(docs, "id", "text", max_words=limit).collect():
        found.setdefault(int(r["node_id"]), {})[r["ordinal"]] = (r["chunk_id"], r["text"])
    for i, text in enumerate(texts):
        expected = packed(text, limit)
        assert [found[i][n][1] for n in sorted(found[i])] == expected, repr(text)
        assert found[i][0][0] == f"{i}_chunk_0"


def test_chunks_keep_every_word(spark):
    texts = random_texts(100)
    docs = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    got = {}
    for r in document_chunks(docs, "id", "text", max_words=4).orderBy("node_id", "ordinal").collect():
        got.setdefault(int(r["node_id"]), []).append(r["text"])
    assert all(" ".join(got[i]).split() == t.split() for i, t in enumerate(texts))


def test_words_and_strip_match_python(spark):
    texts = random_texts(300)
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.word_count(F.col("t")).alias("n"), T.strip(F.col("t")).alias("s"))
    for r in df.collect():
        assert r["n"] == len(r["t"].split())
        assert r["s"] == r["t"].strip()


def test_small_text_functions(spark):
    df = spark.createDataFrame([("A Team", "x;;y;", "l1\nl2", 7, None)], "n string, l string, m string, k int, z string")
    r = df.select(
        T.team_id(F.col("n")).alias("team"), T.split_list(F.col("l")).alias("parts"), T.one_line(F.col("m")).alias("line"),
        T.padded_id("CR", F.col("k")).alias("id"), T.padded_id("CR", F.lit(12345)).alias("long"), T.flatten_row(df).alias("flat"),
        T.preview(F.col("n"), 3).alias("short"), T.contains_any([F.col("z"), F.col("n")], F.lit("Tea")).alias("hit"),
        T.contains_any([F.col("z"), F.col("n")], F.lit("tea")).alias("miss"), T.blank_to_null(F.lit("  ")).alias("blank"),
    ).first()
    assert (r.team, r.parts, r.line, r.id, r.long) == ("TEAM-A_Team", ["x", "y"], "l1 l2", "CR007", "CR12345")
    assert r.flat == "n: A Team | l: x;;y; | m: l1\nl2 | k: 7"
    assert (r.short, r.hit, r.miss, r.blank) == ("A T...", True, False, None)


def test_timestamp_texts(spark):
    cases = {
        "2023-10-27T10:30:00Z": "2023-10-27 10:30:00 UTC", "2023-10-27T10:30:00.123": "2023-10-27 10:30:00 UTC",
        "2023-10-27T10:30:00": "2023-10-27 10:30:00 UTC", "2023-10-27T10:30:00.5Z": "2023-10-27 10:30:00 UTC",
        "2023-10-27T10:30Z": "2023-10-27 10:30:00 UTC", "bad": "bad", "2023-10-27T10:30:00+05:30": "2023-10-27T10:30:00+05:30",
        "N/A": "N/A", "2023-13-27T10:30:00": "2023-13-27T10:30:00", "2023-10-27": "2023-10-27", "Z": "Z", "2023-10-27T10:30:00.x": "2023-10-27 10:30:00 UTC",
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert dict(df.select("t", utc_text(F.col("t"))).collect()) == cases
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_typed_casts_give_null_for_blank_and_bad_text(spark):
    df = spark.createDataFrame([(" 2.5 ", "2023-01-02", "2023-01-02 10:30"), ("", " ", ""), ("x", "soon", "x"), (None, None, None)], "n string, d string, t string")
    got = df.select(typed(F.col("n"), "decimal(5,1)"), typed(F.col("d"), "date"), typed(F.col("t"), "timestamp")).collect()
    assert [str(v) for v in got[0]] == ["2.5", "2023-01-02", "2023-01-02 10:30:00"]
    assert all(tuple(r) == (None, None, None) for r in got[1:])


def test_property_maps_and_their_null_rules(spark):
    df = spark.createDataFrame([("1", None)], "b string, a string")
    r = df.select(property_map(["b", "a"]).alias("drop"), property_map(["b", "a"], "None").alias("keep")).first()
    assert r["drop"] == {"b": "1"} and r["keep"] == {"b": "1", "a": "None"}
    assert df.select(map_lines(property_map(["b", "a"], "None"))).first()[0] == "a: None\nb: 1"


def test_row_chunks_have_stable_ids(spark):
    df = spark.createDataFrame([("k1", None, "v"), ("k2", "w", "v")], "k string, x string, y string")
    first, again = rows(row_chunks(df, "CR", "k")), rows(row_chunks(df, "CR", "k"))
    assert first == again
    assert {r[3] for r in first} == {"k: k1 | y: v", "k: k2 | x: w | y: v"}


def test_words_are_counted_alike_with_ascii_first(spark):
    """Every character, between two letters: a space of the list parts them, any other joins them."""
    assert T.COUNTED_WORD.startswith(r"[\x{21}-\x{7e}")  # no look at every space for plain letters
    points = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000] + [0xFEFF, 0x1F600]
    found = spark.createDataFrame([(c, f"a{chr(c)}b") for c in points], "c int, t string").select(
        "c", T.word_count(F.col("t")).alias("n"), F.regexp_count("t", F.lit(T.WORD)).alias("plain")).collect()
    assert all(r["n"] == r["plain"] == (2 if r["c"] in T.SPACE_CODES else 1) for r in found)
    assert spark.range(1).select(T.word_count(F.lit("")), T.word_count(F.lit(None).cast("string"))).first()[:] == (0, None)
