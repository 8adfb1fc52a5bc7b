from pyspark.sql import functions as F

from linkwright.llm import merkle

SCHEMA = "file string, offset bigint, length bigint, digest string"


def archive(spark, n, size=1000):
    return spark.range(n).select(
        F.concat(F.lit("f"), F.col("id") % 3).alias("file"), (F.floor(F.col("id") / 3) * size).alias("offset"),
        F.lit(size).cast("bigint").alias("length"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))


def found(a, b):
    return sorted((r["file"] or "", r["offset"], r["kind"]) for r in merkle.audit(a, b).collect())


def test_equal_replicas_and_empty_tables_differ_in_nothing(spark):
    a = archive(spark, 3000)
    assert found(a, a.repartition(5)) == []
    assert found(a.filter("false"), a.filter("false")) == []


def test_damage_is_located_over_levels(spark):
    a = archive(spark, 60_000)  # 20 MB a file: three levels
    b = (a.filter("NOT (file = 'f1' AND offset = 777000)")
         .withColumn("digest", F.when((F.col("file") == "f2") & F.col("offset").isin(0, 19_999_000), "bad").otherwise(F.col("digest")))
         .union(spark.createDataFrame([("f0", 500, 10, "new"), ("f9", 0, 10, "new")], SCHEMA)))
    assert found(a, b) == [("f0", 500, "extra"), ("f1", 777000, "missing"), ("f2", 0, "changed"), ("f2", 19_999_000, "changed"), ("f9", 0, "extra")]
    assert found(b, a)[0] == ("f0", 500, "missing")
    assert found(a, a.filter("false").union(spark.createDataFrame([("f0", 0, 1, "x")], SCHEMA)))[0] == ("f0", 0, "changed")


def test_only_differing_branches_are_opened(spark, monkeypatch):
    opened = []
    plain = merkle._differing
    monkeypatch.setattr(merkle, "_differing", lambda a, b, keys: opened.append(a.count()) or plain(a, b, keys))
    a = archive(spark, 60_000)
    b = a.withColumn("digest", F.when((F.col("file") == "f1") & (F.col("offset") == 5_000_000), "bad").otherwise(F.col("digest")))
    assert found(a, b) == [("f1", 5_000_000, "changed")]
    assert len(opened) == 5 and all(n <= 70 for n in opened)


def test_nulls_repeats_ties_and_extra_columns(spark):
    rows = [(None, None, None, None), ("a", 0, 5, "x"), ("a", 0, 5, "x"), ("a", 0, 6, "y"), ("a", None, 5, "z"), ("b", 3, None, "q")]
    a = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit(1)).withColumn("kind", F.lit("own"))
    assert found(a, a) == []
    assert found(a, a.dropDuplicates()) == [("a", 0, "changed")]
    assert found(a, a.filter("file IS NOT NULL")) == [("", 0, "missing")]


def test_offsets_follow_the_records(spark):
    rows = spark.createDataFrame([(2, "u", "éé"), (1, None, None), (3, "http://x", "b" * 100_000)], "page_id bigint, url string, html string")
    record = merkle.warc_record(F.col("url"), F.col("html"))
    got = merkle.records(rows, F.lit("f"), ["page_id"], record, "page_id").orderBy("offset").collect()
    texts = {r["page_id"]: r["t"] for r in rows.select("page_id", record.alias("t")).collect()}
    assert [r["page_id"] for r in got] == [1, 2, 3]
    sizes = [len(texts[k].encode()) for k in (1, 2, 3)]
    assert [r["offset"] for r in got] == [0, sizes[0], sizes[0] + sizes[1]] and [r["length"] for r in got] == sizes
    assert "Content-Length: 4\r\n\r\néé\r\n\r\n" in texts[2]


def test_records_of_null_repeated_and_no_rows(spark):
    schema = "page_id bigint, html string, offset string, digest string"
    data = [(None, "b", "o", "d"), (None, "a", "o", "d"), (1, None, "o", "d"), (1, "xy", "o", "d"), (1, "xy", "o", "d")]
    rows = spark.createDataFrame(data, schema)
    got = merkle.records(rows, F.lit(None).cast("string"), ["page_id"], F.col("html"), "page_id").orderBy("offset", "length").collect()
    assert [r["page_id"] for r in got] == [None, None, 1, 1, 1] and {r["file"] for r in got} == {None}
    assert [r["length"] for r in got[:2]] == [1, 1] and sorted(r["length"] for r in got[2:]) == [0, 2, 2]
    assert max(r["offset"] + r["length"] for r in got) == 6
    again = merkle.records(rows.repartition(3), F.lit(None).cast("string"), ["page_id"], F.col("html"), "page_id")
    assert found(merkle.records(rows, F.lit(None).cast("string"), ["page_id"], F.col("html")), again) == []
    assert merkle.records(rows.filter("false"), F.lit("f"), ["page_id"], F.col("html")).count() == 0
