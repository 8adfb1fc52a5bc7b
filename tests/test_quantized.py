import numpy as np
import pytest

import __spark_entry__ as entry
from linkwright.operators import quantized, search

DIMS = 16


@pytest.fixture(scope="module")
def vectors():
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(12, DIMS))
    return (centres[draw.integers(0, 12, 1500)] + 0.5 * draw.normal(size=(1500, DIMS))).astype(np.float32)


def exact(vectors, queries, k):
    unit = vectors / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    scores = np.round(unit[queries] @ unit.T, 12)
    return {(q, i): scores[n, i] for n, q in enumerate(queries) for i in sorted(range(len(unit)), key=lambda i: (-scores[n, i], i))[:k]}


def frame(spark, vectors):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "id bigint, embedding array<float>")


def test_recall_and_exact_scores(spark, vectors, tmp_path, monkeypatch):
    docs, path = frame(spark, vectors), str(tmp_path / "index")
    quantized.build_index(docs, path, 8, DIMS, parts=4, codes=64)
    asked = docs.filter("id % 50 = 0").withColumnRenamed("id", "query_id")
    listed, centres, books = quantized.open_index(spark, path)
    assert listed.count() == len(vectors) and books.shape == (4, 64, 4)
    assert {len(r["code"]) for r in listed.select("code").collect()} == {4}
    want = exact(vectors, list(range(0, 1500, 50)), 5)
    for table_bytes in (quantized.TABLE_BYTES, 4 * 4 * 64 * 10):  # in one block, and in several
        monkeypatch.setattr(quantized, "TABLE_BYTES", table_bytes)
        got = quantized.pq_topk(asked, listed, centres, books, 4, 5, depth=60).collect()
        found = {(r["query_id"], r["id"]): r["score"] for r in got}
        assert len(found.keys() & want.keys()) >= 0.9 * len(want)
        assert all(abs(found[p] - want[p]) < 1e-6 for p in found.keys() & want.keys())
        assert sorted(r["rank"] for r in got) == sorted(list(range(1, 6)) * 30)


def test_odd_vectors_are_left_out(spark, vectors, tmp_path):
    odd = spark.createDataFrame([(5001, [0.0] * DIMS), (5002, [1.0]), (5003, None)], "id bigint, embedding array<float>")
    docs = frame(spark, vectors[:200]).union(odd)
    quantized.build_index(docs, str(tmp_path / "index"), 4, DIMS, parts=4, codes=16)
    index = quantized.open_index(spark, str(tmp_path / "index"))
    got = quantized.pq_topk(docs.filter("id % 50 = 0 OR id > 5000").withColumnRenamed("id", "query_id"), *index, 2).collect()
    assert {r["query_id"] for r in got} == {0, 50, 100, 150} and all(r["id"] < 200 for r in got)
    assert quantized.pq_topk(docs.filter("false").withColumnRenamed("id", "query_id"), *index, 2).collect() == []


def test_a_part_with_few_different_rows():
    rows = np.array([[0.0, 1.0], [1.0, 0.0]] * 5)
    centres = quantized._fitted(rows, 8)
    assert centres.shape == (8, 2) and (rows == centres[quantized._nearest(rows, centres)]).all()
    with pytest.raises(ValueError):
        quantized.fit_codes(None, 10, parts=4)


def test_bound_query_has_a_recall_of_nine_tenths(spark):
    folder = "/root/testdata/sf0.01"
    got = entry.queries()["pq_topk"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/embeddings.parquet").withColumnRenamed("vec_id", "id")
    best = search.cosine_topk(docs.filter("id % 50 = 0").withColumnRenamed("id", "query_id"), docs, 5, 64).collect()
    want = {(r["query_id"], r["id"]) for r in best}
    recall = len(want & {(r["query_id"], r["id"]) for r in got}) / len(want)
    print("recall", recall)
    assert recall >= 0.9
