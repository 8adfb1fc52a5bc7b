import re

from pyspark.sql import functions as F

from linkwright.operators import context, postings
from tests.conftest import rows

TEXTS = [
    ("a", {"t": "login fails", "u": "ring"}), ("b", {"t": "Login bug é😀x", "u": None}), ("c", {"t": "", "v": "login"}),
    ("d", {"t": "abab abab", "u": "log"}), ("e", {"t": "x" * 70_000 + "login" + "y" * 10}), ("f", None),
    ("g", {"t": "lo", "u": "gin"}), ("a", {"t": "again login"}), ("h", {"t": "aXXbcdYef abcdef"}),
]
WORDS = ["login", "Login", "l", "lo", "gin", "bug é😀", "😀x", "x", "abab ab", "abababab", "nothing", "lo\ngin", "xlogin", "fails",
         "abcdef", "bcd", "log", "", None, "login", "y" * 10, "y" * 11]


def test_matches_are_those_of_the_texts(spark, tmp_path):
    vertices = spark.createDataFrame(TEXTS, "id string, props map<string,string>")
    keywords = spark.createDataFrame([(w,) for w in WORDS], "keyword string").withColumn("id", F.lit("own"))
    stored = postings.store_postings(vertices, ["t", "u"], str(tmp_path / "index"))
    want = sorted({(w, i) for w in WORDS if w for i, p in TEXTS for k in ("t", "u") if p and p.get(k) and w in p[k]})
    assert rows(postings.keyword_matches(stored, keywords)) == rows(spark.createDataFrame(want, "keyword string, id string"))
    plain = context.keyword_matches(vertices, keywords, ["t", "u"]).distinct()
    assert rows(plain) == rows(spark.createDataFrame(want, "keyword string, id string"))


def test_empty_index_and_no_keywords(spark, tmp_path):
    vertices = spark.createDataFrame(TEXTS, "id string, props map<string,string>")
    none = spark.createDataFrame([], "keyword string")
    some = spark.createDataFrame([("login",), ("l",)], "keyword string")
    full = postings.store_postings(vertices, ["t"], str(tmp_path / "full"))
    empty = postings.store_postings(vertices.filter("false"), ["t"], str(tmp_path / "empty"))
    assert postings.keyword_matches(full, none).count() == 0
    assert postings.keyword_matches(empty, some).count() == 0


def test_only_folders_of_asked_grams_are_read(spark, tmp_path):
    vertices = spark.range(500).select(F.concat(F.lit("v"), "id").alias("id"), F.create_map(F.lit("t"), F.md5(F.col("id").cast("string"))).alias("props"))
    stored = postings.store_postings(vertices, ["t"], str(tmp_path / "index"))
    plan = postings._read(stored, spark.createDataFrame([("abc",)], "gram string"))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*part#\d+ = \d+\)", plan)
    word = spark.createDataFrame([("abc",), ("ffff",)], "keyword string")
    assert rows(postings.keyword_matches(stored, word)) == rows(context.keyword_matches(vertices, word, ["t"]).select("keyword", "id"))


def test_candidates_do_not_grow_with_the_square_of_the_texts(spark, tmp_path, monkeypatch):
    """As many keywords as texts, made of the same digits: a keyword's rarest gram leads to a few texts, not to a share of all."""
    steps, kept = [], postings.written
    monkeypatch.setattr(postings, "written", lambda df, name="step": steps.append((name, kept(df, name))) or steps[-1][1])
    number = F.lpad(F.col("id").cast("string"), 9, "0")
    vertices = spark.range(8000).select(F.concat(F.lit("v"), "id").alias("id"), F.create_map(F.lit("t"), F.concat(F.lit("Customer#"), number)).alias("props"))
    keywords = spark.range(8000).select(F.concat(F.lit("#"), number).alias("keyword"))
    stored = postings.store_postings(vertices, ["t"], str(tmp_path / "index"))
    assert postings.keyword_matches(stored, keywords).count() == 8000
    assert sum(df.count() for name, df in steps if name == "starts") <= 4 * 8000
