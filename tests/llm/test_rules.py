import pytest
from pyspark.sql import functions as F

from linkwright.llm import rules


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.001"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return rules.fit(*tables)


def test_compiled_column_is_the_weighted_sum_of_rules(spark, tables, model):
    docs = tables[0]
    assert model.rules and all(rule.parts for rule, _ in model.rules)
    rows = docs.select(rules.with_statistics(F.col("text"), lambda s: s).alias("s"), model.score(F.col("text")).alias("score")).collect()
    for r in rows:
        odds = model.bias + sum(w for rule, w in model.rules if all((r["s"][n] > b) == over for n, over, b in rule.parts))
        assert abs(r["score"] - 1 / (1 + 2.718281828459045 ** -odds)) < 1e-9


def test_fit_is_repeatable_and_reads_no_held_out_row(spark, tables, model):
    docs, labels = tables
    assert rules.fit(docs.repartition(3), labels.repartition(2)) == model
    flipped = labels.withColumn("quality", F.when(rules.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert rules.fit(docs, flipped) == model


@pytest.mark.parametrize("labels, low, high", [([], 0.5, 0.5), ([1, 1], 0.9, 1.0), ([0, 0], 0.0, 0.1), ([None], 0.5, 0.5)])
def test_without_two_kinds_of_labels_the_score_is_constant(spark, labels, low, high):
    docs = spark.createDataFrame([(2, "a b"), (3, "c"), (None, None)], "doc_id bigint, text string")
    known = spark.createDataFrame([(2 + k, q) for k, q in enumerate(labels)], "doc_id bigint, quality int")
    scores = [r["score"] for r in rules.report(docs, known).collect()]
    assert len(scores) == 3 and all(low <= s <= high for s in scores)


def test_nulls_long_texts_repeats_and_clashing_columns(spark, tables, model):
    rows = [(1, None), (2, ""), (3, "\n"), (4, "word " * 100_000), (None, "a"), (5, "x"), (5, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("own")).withColumn("s", F.lit("own")).withColumn("words", F.lit(1))
    got = rules.report(docs, tables[1].filter("false")).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    scored = docs.select("doc_id", model.score(F.col("text")).alias("m")).collect()
    assert len({r["m"] for r in scored if r["doc_id"] in (1, 2)}) == 1
    left = rules.accepted(docs, tables[1].filter("false"))
    assert left.columns == docs.columns and left.count() == len(rows)
    assert rules.report(docs.filter("false"), tables[1]).count() == 0


def test_scoring_is_one_pass_without_python(tables, model):
    docs = tables[0]
    plan = docs.filter(model.score(F.col("text")) >= 0.3)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
    assert plan.count("regexp_extract_all") == 6  # once for each pattern that is counted


def test_tags_are_brackets_braces_and_backslashes(spark):
    docs = spark.createDataFrame([("[[a]] [b]",), ("<p> {x} \\",), ("a (b) d",)], "text string")
    found = [r[0] for r in docs.select(rules._count({"text": docs["text"]}, rules.TAGS)).collect()]
    assert found == [6, 5, 0]
