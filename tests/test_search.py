import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright.functions.vectors import cosine
from linkwright.operators import search
from tests.conftest import rows

DIMS = 8


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    return rng.normal(size=(300, DIMS)).astype(np.float32)


def frame(spark, vectors, parts=5):
    data = [(i, [float(x) for x in v], i % 3) for i, v in enumerate(vectors)]
    return spark.createDataFrame(data, "id bigint, embedding array<float>, kind int").repartition(parts)


def questions(spark, vectors, scope=None):
    data = [(f"q{i}", [float(x) for x in v], scope(i) if scope else None) for i, v in enumerate(vectors)]
    return spark.createDataFrame(data, "query_id string, embedding array<float>, scope int")


def brute(queries, docs, k, keep=lambda q, d: True):
    out = []
    for q, qv in enumerate(queries.astype(float)):
        scored = []
        for d, dv in enumerate(docs.astype(float)):
            size = np.linalg.norm(qv) * np.linalg.norm(dv)
            if size and keep(q, d):
                scored.append((-round(float(qv @ dv / size), 12), d))
        out += [(f"q{q}", d, n + 1, round(-s, 6)) for n, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def shown(hits):
    return sorted([(r["query_id"], r["id"], r["rank"], round(r["score"], 6)) for r in hits.collect()], key=str)


def test_exact_topk_matches_brute_force(spark, vectors):
    got = search.cosine_topk(questions(spark, vectors[:20]), frame(spark, vectors), 5, DIMS)
    assert shown(got) == brute(vectors[:20], vectors, 5)


def test_copies_tie_by_id_and_zero_vectors_are_left_out(spark, vectors):
    docs = np.vstack([vectors[:50], np.repeat(vectors[7:8], 100, axis=0), np.zeros((3, DIMS), np.float32)])
    got = shown(search.cosine_topk(questions(spark, docs[7:9]), frame(spark, docs), 6, DIMS))
    assert got == brute(docs[7:9], docs, 6)
    assert [g[1] for g in sorted(got, key=lambda g: (g[0], g[2]))[:6]] == [7, 50, 51, 52, 53, 54]


def test_large_query_sets_take_the_block_path_with_the_same_result(spark, vectors):
    asked, docs = questions(spark, vectors[:60]), frame(spark, vectors)
    blocks = search.cosine_topk(asked, docs, 4, DIMS, max_query_bytes=8 * DIMS * 10)
    assert shown(blocks) == brute(vectors[:60], vectors, 4)


def test_scope_filters_before_scoring(spark, vectors):
    asked = questions(spark, vectors[:9], scope=lambda i: i % 3)
    docs = frame(spark, vectors)
    expected = brute(vectors[:9], vectors, 5, keep=lambda q, d: q % 3 == d % 3)
    assert shown(search.cosine_topk(asked, docs, 5, DIMS, scope_col="kind")) == expected
    assert shown(search.cosine_topk(asked, docs, 5, DIMS, scope_col="kind", max_query_bytes=8 * DIMS * 2)) == expected


def test_wrong_length_vectors_are_ignored(spark, vectors):
    odd = spark.createDataFrame([(999, [1.0, 2.0], 0)], "id bigint, embedding array<float>, kind int")
    got = search.cosine_topk(questions(spark, vectors[:2]), frame(spark, vectors).unionByName(odd), 5, DIMS)
    assert shown(got) == brute(vectors[:2], vectors, 5)


def test_approximate_search_has_exact_scores_and_good_recall(spark, vectors, tmp_path):
    docs = frame(spark, vectors)
    listed, centres = search.build_lists(docs, 8, DIMS)
    search.write_index(listed, centres, str(tmp_path / "index"))
    stored, centres = search.read_index(spark, str(tmp_path / "index"))
    assert stored.count() == len(vectors) and len(centres) == 8
    asked = questions(spark, vectors[:40])
    exact = {(g[0], g[1]): g[3] for g in brute(vectors[:40], vectors, len(vectors))}
    best = {(g[0], g[1]) for g in brute(vectors[:40], vectors, 5)}
    recall = []
    for probes in (2, 8):
        got = shown(search.ann_topk(asked.drop("scope"), stored, centres, probes, 5, DIMS))
        assert all(abs(exact[g[0], g[1]] - g[3]) < 2e-6 for g in got)
        recall.append(len({(g[0], g[1]) for g in got} & best) / len(best))
    assert recall[0] >= 0.4 and recall[1] == 1.0


def test_approximate_search_in_a_scope(spark, vectors):
    docs = frame(spark, vectors)
    listed, centres = search.build_lists(docs, 8, DIMS)
    asked = questions(spark, vectors[:12], scope=lambda i: i % 3 if i else None)
    expected = [r for r in brute(vectors[:12], vectors, 5, keep=lambda q, d: q % 3 == d % 3) if r[0] != "q0"]
    assert shown(search.ann_topk(asked, listed, centres, 8, 5, DIMS, scope_col="kind")) == expected


def test_centres_must_fit_a_task(spark, vectors, monkeypatch):
    monkeypatch.setattr(search, "MAX_CENTRE_BYTES", 8 * DIMS * 4)
    with pytest.raises(ValueError):
        search.build_lists(frame(spark, vectors), 5, DIMS)
    assert search.build_lists(frame(spark, vectors), 4, DIMS, train_rows=100)[0].count() == len(vectors)


def test_cosine_expression(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(F.round(cosine(F.col("a"), F.col("b")), 6)).collect()]
    assert got == [0.707107, None]


def test_no_shuffle_of_the_documents(spark, vectors):
    hits = search.cosine_topk(questions(spark, vectors[:3]), spark.range(5).select("id", F.array(*[F.lit(1.0)] * DIMS).cast("array<float>").alias("embedding")), 5, DIMS)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("MapInArrow") and plan.count("Exchange") == 1
    assert rows(hits, "query_id")
