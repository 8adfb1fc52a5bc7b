import math
import random

import numpy as np
import pytest

from linkwright.llm import whitening
from linkwright.llm.whitening import whiten

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, keep=4):
    """The contract in numpy: fit list, sums, covariance, eigenvectors."""
    steps = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in rows]
    fit = sorted({x for _, x in steps})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, x in steps:
        far = sum((n * v - s) ** 2 for v, s in zip(x, sums))
        for k in range(min(keep, len(x))):
            on = float((np.array(x, float) - np.array(sums) / n) @ vectors[:, k])
            out.setdefault((i, k + 1), []).append((n, far, on / math.sqrt(values[k]) if values[k] > 1e-9 else None,
                                                   values[k] / values.sum()))
    return out


def compare(got, want):
    assert sum(map(len, want.values())) == len(got)
    signs = {}
    for r in got:
        n, far, on, share = want[r["vec_id"], r["component"]].pop()
        assert (r["n"], r["deviation"]) == (n, far) and r["explained"] == pytest.approx(share, rel=1e-6, abs=1e-12)
        if on is None:
            assert r["whitened"] is None
        else:
            assert abs(r["whitened"]) == pytest.approx(abs(on), abs=1e-7)
            if abs(on) > 1e-6:
                signs.setdefault(r["component"], set()).add(r["whitened"] * on > 0)
        assert r["identity_error"] <= 1e-8
    assert all(len(s) == 1 for s in signs.values())


def test_equals_numpy_with_repeats_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 16)
    monkeypatch.setattr(whitening, "BLOCK_COLUMNS", 4)
    monkeypatch.setattr(whitening, "BLOCKS_A_TASK", 2)
    draw = np.random.default_rng(1)
    base = draw.normal(size=(200, 10)) * np.linspace(0.5, 3, 10)
    vectors = [v.astype(np.float32).tolist() for v in base]
    vectors += [vectors[7]] * 100  # a hot vector counts once in the fit
    rows = list(enumerate(vectors))
    got = whiten(spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)).collect()
    compare(got, plain(rows))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [random.Random(i).uniform(-1, 1) for _ in range(3)]) for i in range(30)]
    good = [(i, [float(np.float32(c)) for c in v]) for i, v in good]
    repeated = [*good, good[3], (None, good[4][1]), (None, good[4][1])]
    odd = [(50, None), (51, []), (52, [1.0, None, 2.0]), (53, [nan, 1.0, 2.0]), (54, [inf, 1.0, 2.0]), (55, [1.0, 2.0])]
    # the columns of the result and of its steps are all taken already
    df = spark.createDataFrame([(i, v, 0) for i, v in repeated + odd], SCHEMA)
    for name in ("x", "index", "values", "each", "n", "component", "deviation", "whitened", "c", "vector", "_part", "_place"):
        df = df.withColumn(name, df["label"])
    compare(whiten(df).collect(), plain(repeated))


def test_components_without_variance(spark):
    rows = [(1, [0.5, 0.25]), (2, [0.75, 0.25]), (3, [1.0, 0.25])]
    got = {(r["vec_id"], r["component"]): r for r in whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()}
    assert len(got) == 6 and got[1, 2]["whitened"] is None and got[1, 2]["explained"] == pytest.approx(0, abs=1e-12)
    assert got[2, 1]["whitened"] == pytest.approx(0) and got[1, 1]["identity_error"] < 1e-9
    same = whiten(spark.createDataFrame([(1, [0.5, 2.0], 0), (2, [0.5, 2.0], 0)], SCHEMA)).collect()
    assert len(same) == 4
    assert {(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same} == {(1, 0, None, None, None)}


def test_empty_tables(spark):
    assert whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whiten(spark.createDataFrame([(1, None, 0), (2, [], 0)], SCHEMA)).collect() == []


def test_large_entries_are_exact_or_null(spark):
    rows = [(1, [2.0**40, 0.0]), (2, [2.0**40 + 2.0**20, 1.0]), (3, [2.0**40, 1.0])]
    got = {r["vec_id"]: r["deviation"] for r in whiten(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()}
    want = plain(rows)
    assert got == {i: want[i, 1][0][1] for i, _ in rows}
    far = [(1, [3e30]), (2, [-3e30]), (3, [1.0])]
    got = {r["vec_id"]: r["deviation"] for r in whiten(spark.createDataFrame([(*r, 0) for r in far], SCHEMA)).collect()}
    assert got == {1: None, 2: None, 3: (3 * 256 - 255) ** 2}  # the outer ones count as the ends of a long
