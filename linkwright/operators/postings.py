"""Stored index of the texts of vertices: where every eight characters stand, so that keywords are found without the texts.

A row of the index holds the places of one gram in one text of one vertex. A keyword is in a text where its grams stand
in a row: candidates come from the keyword's rarest gram, and each further gram strikes places out. At every place
of a text stands the gram of the eight characters that begin there, a shorter one at the end, so a keyword of up to seven characters
is in a text exactly where a gram begins with it. Short grams would be shared by a fixed share of the texts: with as many keywords as
texts, the candidates would then grow with the square of the texts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.session import written

SIZE = 8
PARTS = 64
#: Characters of a text that one row of the index covers.
BLOCK = 1 << 16

_ROWS = "gram string, id string, text bigint, block bigint, places array<bigint>, part int"


@dataclass(frozen=True)
class Postings:
    """A stored index: its rows in folders by a hash of the gram, and the number of rows of every gram."""

    path: str

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(_ROWS).parquet(f"{self.path}/rows")

    def grams(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("gram string, n bigint").parquet(f"{self.path}/grams")


def _part(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(PARTS)).cast("int")


def store_postings(vertices: DataFrame, properties: Sequence[str], path: str) -> Postings:
    """Index the named properties of (id, props) below ``path``; null and empty texts have no rows.

    Rows of a gram are dealt over ranges of vertices, so one that stands in most texts is spread over several files. A long
    text has a row per ``BLOCK`` characters and gram. Texts of one vertex, also of vertices with equal ids, are told apart by
    a hash. Other columns are not read.
    """
    spark = vertices.sparkSession
    texts = vertices.select("id", F.explode(F.array(*[F.col("props")[p] for p in properties])).alias("_t")).filter("_t != ''")
    grams = F.transform(F.col("_c"), lambda _, i: F.array_join(F.slice("_c", i + 1, F.lit(SIZE)), ""))
    stood = (texts.select("id", F.xxhash64("_t").alias("text"), F.split("_t", "").alias("_c"))
             .select("id", "text", F.posexplode(grams).alias("place", "gram")))
    row = stood.groupBy("gram", "id", "text", F.floor(F.col("place") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_set(F.col("place").cast("bigint"))).alias("places"))
    (row.withColumn("part", _part(F.col("gram"))).repartitionByRange("part", "gram", "id").sortWithinPartitions("part", "gram", "id")
     .write.mode("overwrite").partitionBy("part").parquet(f"{path}/rows"))
    stored = Postings(path)
    stored.rows(spark).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/grams")
    return stored


def _read(stored: Postings, grams: DataFrame) -> DataFrame:
    """The rows of the grams in column ``gram``, from the folders (at most ``PARTS``) that may hold them."""
    spark = grams.sparkSession
    parts = [r["part"] for r in grams.select(_part(F.col("gram")).alias("part")).distinct().collect()]
    return stored.rows(spark).filter(F.col("part").isin(parts))


def keyword_matches(stored: Postings, keywords: DataFrame) -> DataFrame:
    """(keyword, id) for every vertex that holds the keyword, case-sensitively, in one of the indexed properties.

    A keyword given twice counts once; null and empty keywords match nothing. The texts are not read. Every step joins on
    the gram, and from the second on also on vertex and text, so a frequent gram is met only at places that are left.
    """
    spark = keywords.sparkSession
    asked = written(keywords.select("keyword").filter(F.col("keyword") != "").distinct().withColumn(
        "_size", F.char_length("keyword")), "asked")
    return _short(stored, spark, asked).unionByName(_long(stored, spark, asked)).distinct()


def _short(stored: Postings, spark: SparkSession, asked: DataFrame) -> DataFrame:
    """Keywords below the size of a gram: all grams that begin with one, by the list of grams."""
    short = asked.filter(F.col("_size") < SIZE)
    sizes = sorted(r["_size"] for r in short.select("_size").distinct().collect())  # at most SIZE - 1
    heads = stored.grams(spark).select("gram", F.explode(F.array_distinct(F.array(
        *[F.substring("gram", 1, n) for n in sizes or [1]]))).alias("keyword"))
    grams = written(short.select("keyword").join(heads, "keyword"), "short")
    return _read(stored, grams).join(grams, "gram").select("keyword", "id")


def _long(stored: Postings, spark: SparkSession, asked: DataFrame) -> DataFrame:
    """Keywords by as few grams as cover them, the rarest first; what is left are starts of the whole keyword."""
    at = F.array_distinct(F.concat(
        F.sequence(F.lit(0), F.col("_size") - SIZE, F.lit(SIZE)), F.array(F.col("_size") - SIZE)))
    parts = asked.filter(F.col("_size") >= SIZE).select("keyword", F.explode(at).alias("at")).withColumn(
        "gram", F.substring(F.col("keyword"), F.col("at") + 1, F.lit(SIZE)))
    counted = parts.join(stored.grams(spark), "gram", "left").fillna(0, ["n"])
    steps = counted.groupBy("keyword").agg(F.sort_array(F.collect_list(F.struct("n", "at", "gram"))).alias("steps")).filter(
        F.col("steps")[0]["n"] > 0)  # a gram that stands nowhere
    steps = written(steps.select("keyword", F.posexplode("steps").alias("step", "_s")).select("keyword", "step", "_s.*"), "steps")
    last = steps.agg(F.max("step")).first()[0]
    left = None
    for step in range(0 if last is None else last + 1):  # an eighth of the longest keyword
        now = steps.filter(F.col("step") == step).select("keyword", "gram", "at")
        if left is None:
            starts = F.explode(F.transform("places", lambda p: p - F.col("at"))).alias("start")
            found = _read(stored, now).join(now, "gram").select("keyword", "id", "text", starts)
            left = written(found.filter("start >= 0"), "starts")
            continue
        # Candidates of keywords with more grams meet the lists; the others are through.
        open_ = left.join(now, "keyword", "left")
        block = F.floor((F.col("start") + F.col("at")) / BLOCK)
        wanted = open_.filter(F.col("gram").isNotNull()).withColumn("block", block)
        met = wanted.join(_read(stored, now).drop("part"), ["gram", "id", "text", "block"]).filter(
            F.array_contains("places", F.col("start") + F.col("at")))
        done = open_.filter(F.col("gram").isNull())
        left = written(done.select("keyword", "id", "text", "start").unionByName(
            met.select("keyword", "id", "text", "start")), "starts")
    if left is None:
        return asked.select("keyword", F.lit("").alias("id")).filter(F.lit(False))
    return left.select("keyword", "id")
