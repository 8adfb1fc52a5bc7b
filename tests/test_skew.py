"""Grouping and numbering with one key that owns most of the rows."""

import random

import pytest
from pyspark.sql import functions as F

from linkwright.operators import graph, skew
from tests.conftest import rows


@pytest.fixture(scope="module")
def hot(spark):
    return spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
        F.col("id").alias("n"))


def whole_texts(got, sep):
    parts = {}
    for r in sorted(got, key=lambda r: r["part_no"]):
        parts.setdefault(r["k"], []).append(r["text"])
    return parts, {k: sep.join(p) for k, p in parts.items()}


@pytest.mark.parametrize("part_bytes", [10, 300, 5000, 10**9])
def test_parts_joined_in_order_are_the_ordered_text(spark, hot, part_bytes):
    lines = hot.withColumn("line", F.concat(F.lit("line é "), F.col("n").cast("string")))
    expected = {}
    for r in sorted(lines.collect(), key=lambda r: r["n"]):
        expected.setdefault(r["k"], []).append(r["line"])
    expected = {k: "\n".join(v) for k, v in expected.items()}
    parts, texts = whole_texts(skew.text_parts(lines, ["k"], "line", ["n"], [], part_bytes=part_bytes).collect(), "\n")
    assert texts == expected
    for k, found in parts.items():
        assert len(found) >= len(expected[k].encode()) // (part_bytes + 16)
        assert all(len(p.encode()) <= part_bytes + 16 for p in found)
        assert part_bytes < len(expected[k].encode()) or len(found) == 1


def test_text_parts_with_many_large_keys_agree(spark, hot, monkeypatch):
    lines = hot.withColumn("line", F.col("n").cast("string"))
    listed = rows(skew.text_parts(lines, ["k"], "line", ["n"], ["n"], part_bytes=60))
    monkeypatch.setattr(skew, "MAX_LISTED_KEYS", 3)
    assert rows(skew.text_parts(lines, ["k"], "line", ["n"], ["n"], part_bytes=60)) == listed


def test_copies_of_one_line_are_split_too(spark):
    copies = spark.range(1000).select(F.lit("a").alias("k"), F.lit("same").alias("line"), F.col("id").alias("row_no"))
    got = skew.text_parts(copies, ["k"], "line", ["line"], ["line", "row_no"], part_bytes=500).collect()
    assert len(got) == 10 and sum(r["text"].count("same") for r in got) == 1000


def test_null_lines_and_null_keys_keep_their_place(spark):
    data = [(None, 1, "x" * 40), (None, 2, "y" * 40), ("a", 1, None), ("b", 1, None), ("b", 2, "z")]
    got = skew.text_parts(spark.createDataFrame(data, "k string, n int, line string"), ["k"], "line", ["n"], [], part_bytes=30)
    assert sorted(((r["k"] or "", r["part_no"], r["text"]) for r in got.collect()), key=str) == [
        ("", 0, "x" * 40), ("", 1, "y" * 40), ("a", 0, None), ("b", 0, "z")]


def test_ordinals_in_a_hot_group(spark, hot):
    got = skew.ordinal_in_group(hot, ["k"], ["n"], F.floor(F.col("n") / 100)).collect()
    by_key = {}
    for r in got:
        by_key.setdefault(r["k"], []).append((r["n"], r["ordinal"]))
    for found in by_key.values():
        assert [o for _, o in sorted(found)] == list(range(1, len(found) + 1))


def test_surrogate_keys_have_no_gaps(spark):
    numbers = list(range(500))
    random.Random(1).shuffle(numbers)
    df = spark.createDataFrame([(n // 300, n) for n in numbers], "a int, b int").repartition(7)
    got = skew.surrogate_key(df, ["a", "b"], first=10).collect()
    assert sorted((r["a"], r["b"], r["row_id"]) for r in got) == [(n // 300, n, n + 10) for n in range(500)]


def test_first_row(spark, hot):
    got = {r["k"]: r["n"] for r in skew.first_row(hot, ["k"], ["n"]).collect()}
    low = {r["k"]: r["m"] for r in hot.groupBy("k").agg(F.min("n").alias("m")).collect()}
    assert got == low


def test_first_row_is_limited_before_the_shuffle(spark, hot):
    plan = skew.first_row(hot, ["k"], ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_a_hub_is_split_in_joins_even_before_a_grouping(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    key = F.col("id").cast("string")
    edges = spark.range(0, 100_000, 1, 8).select(
        F.concat(F.lit("s"), key).alias("src"), F.lit("L").alias("label"),
        F.when(F.col("id") % 3 == 0, "hub").otherwise(F.concat(F.lit("t"), (F.col("id") % 2000).cast("string"))).alias("dst"),
        F.lit("S").alias("src_label"), F.lit("T").alias("dst_label"), F.lit("x").alias("src_table"), key.alias("row_no"))
    targets = edges.select(F.col("dst").alias("id"), F.lit("T").alias("label")).distinct()
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        unknown = edges.withColumn("dst_label", F.lit(None).cast("string"))  # only those are looked up
        kept = graph.with_target(unknown, targets).agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("src", "row_no")))
        hops = graph.neighborhood(targets.select(F.col("id").alias("seed_id")), edges)
        grouped = hops.groupBy("seed_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.hash("other_id", "row_no")))
        assert kept.collect()[0]["n"] == 100_000
        assert {r["seed_id"]: r["n"] for r in grouped.collect()}["hub"] == 33_334
        for done in (kept, grouped):
            assert "SortMergeJoin(skew=true)" in done._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_copies_of_a_line_are_dealt_to_their_parts(spark):
    """Lines with the number of their copies give the parts that the copies give as rows, also where a line is longer than a part."""
    data = [("a", 0, "head", 1), ("a", 1, "x" * 7, 50), ("a", 2, "y" * 45, 3), ("a", 3, "", 30), ("b", 0, "é", 100), (None, 0, "n", 20)]
    counted = spark.createDataFrame(data, "k string, n int, line string, copies bigint")
    single = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    for part_bytes in (1, 10, 64):
        want = skew.text_parts(single, ["k"], "line", ["n"], ["copy"], part_bytes=part_bytes)
        assert rows(skew.repeated_parts(counted, ["k"], "line", ["n"], "copies", "text", "\n", part_bytes)) == rows(want)
