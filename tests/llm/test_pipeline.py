"""The stages of corpus_pipeline.py against brute force and what must hold, each on the rows that its predecessor kept."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from linkwright.llm import rules
from tests.llm.test_decontam import by_force as contaminated_by_force
from tests.llm.test_minhash import by_force as groups_by_force

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage gives, stored and read again."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, found[-1], FOLDER).write.parquet(path)
        found.append(spark.read.parquet(path))
    return found


def texts(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_stages_keep_the_columns_of_documents(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "bpe_tokens"]
    assert all(k.columns == kept[0].columns for k in kept[:-1])
    sizes = [k.count() for k in kept]
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] > 0


def test_quality_rejects_what_it_scores_low(spark, kept):
    scored = rules.report(kept[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert {r["doc_id"] for r in scored.filter("predicted = 1").collect()} == {i for i, _ in texts(kept[1])}


def test_near_dedup_leaves_one_of_each_group(kept):
    groups, _ = groups_by_force(texts(kept[1]))
    assert sorted(i for i, _ in texts(kept[2])) == sorted(set(groups.values()))


def test_decontamination_drops_contaminated_documents_only(spark, kept):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    want = {i for i, t in texts(kept[2]) if not contaminated_by_force(t, items)[-1]}
    assert {i for i, _ in texts(kept[3])} == want


def test_tokens_decode_to_the_texts(kept):
    of = dict(texts(kept[3]))
    rows = kept[4].collect()
    assert {r["doc_id"] for r in rows} == set(of) and len(rows) == len(of)
    assert all(r["decoded_sha256"] == hashlib.sha256(of[r["doc_id"]].encode()).hexdigest() for r in rows)
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)


def test_run_is_all_stages(spark, kept):
    got = corpus_pipeline.run(spark, FOLDER)
    assert sorted(r["ids_sha256"] for r in got.collect()) == sorted(r["ids_sha256"] for r in kept[-1].collect())
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_take_nulls_empties_repeats_and_clashing_columns(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, None), (3, ""), (None, "x y z"), (4, "word " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select(
        "doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.lit(None).cast("bigint").alias("n_chars"),
        F.lit("own").alias("score"), F.lit("own").alias("component_id"), F.lit("own").alias("_overlap_"))
    for frame in (docs, docs.filter("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, frame, FOLDER).columns == docs.columns
            assert stage(spark, frame, FOLDER).count() <= frame.count()
        assert corpus_pipeline.STAGES[-1][1](spark, frame, FOLDER).count() == frame.count()
    assert sorted(r["doc_id"] or 0 for r in corpus_pipeline.near_dedup(spark, docs, FOLDER).collect()) == [0, 1, 2, 3, 4]
