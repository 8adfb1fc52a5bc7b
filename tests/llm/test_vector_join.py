import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright.llm import vector_join

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def by_force(rows, least):
    usable = [(i, np.array(e, np.float32).astype(float), label) for i, e, label in rows
              if i is not None and label is not None and e and None not in e and np.isfinite(e).all() and np.any(np.array(e) != 0)]
    root, n = {}, {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for k, (i, a, la) in enumerate(usable):
        for j, b, lb in usable[:k]:
            if la == lb and len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= least:
                n[i], n[j] = n.get(i, 0) + 1, n.get(j, 0) + 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (n.get(i, 0), find(i) if i is not None else None) for i, _, _ in rows}


def rows(seed, dims=8):
    draw = np.random.default_rng(seed)
    found = []
    for label in (0, 1, 2):
        for _ in range(25):
            centre = draw.normal(size=dims)
            for _ in range(draw.integers(1, 9)):
                found.append((centre + draw.normal(size=dims) * 0.14, label))
        found += [(found[-1][0], label)] * 5
    found = [([float(x) for x in v], label) for v, label in found]
    nan, inf = float("nan"), float("inf")
    found += [([0.0] * dims, 0), (None, 0), ([nan] * dims, 0), ([inf] + [1.0] * (dims - 1), 0), ([None] + [1.0] * (dims - 1), 0),
              (found[0][0], None), ([], 0), ([1.0, 0.0], 0), ([1.0, 0.0], 0), ([x * 1e30 for x in found[0][0]], 0)]
    order = list(range(len(found)))
    random.Random(seed).shuffle(order)
    return [(k, *found[at]) for k, at in enumerate(order)]


@pytest.mark.parametrize("cell, block", [(2000, 4000), (20, 4000), (20, 13)])
def test_groups_are_those_of_all_pairs(spark, monkeypatch, cell, block):
    monkeypatch.setattr(vector_join, "CELL_ROWS", cell)
    monkeypatch.setattr(vector_join, "BLOCK_ROWS", block)
    data = rows(11)
    got = vector_join.linked_vectors(spark.createDataFrame(data, SCHEMA).withColumn("node", F.lit("own")), 0.93).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == by_force(data, 0.93)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_pivots_prune_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "CELL_ROWS", 30)
    draw = np.random.default_rng(3)
    data = [(k, [float(x) for x in np.eye(12)[k % 12] * 5 + draw.normal(size=12) * 0.2], 0) for k in range(360)]
    frame = spark.createDataFrame(data, SCHEMA).withColumn("node", F.xxhash64("vec_id"))
    classes = vector_join._classes(frame)
    pivots = vector_join._pivots(classes)
    homes = vector_join._homes(classes, pivots)
    reach = float(np.sqrt(2 - 2 * 0.93))
    radii = {s: np.full(len(p), np.inf) for s, p in pivots.items()}
    copies = vector_join._spread(homes, pivots, radii, reach).count()
    assert len(pivots[0, 12]) == 12 and copies < 360 * 6
    got = vector_join.linked_vectors(frame, 0.93).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == by_force(data, 0.93)


def test_pivots_that_nearly_coincide_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(vector_join, "CELL_ROWS", 14)
    draw = np.random.default_rng(5)
    hot = draw.normal(size=8)
    found = [hot * s for s in draw.uniform(0.1, 10, 300)] + [hot + draw.normal(size=8) * 0.3 for _ in range(300)]
    found += list(draw.normal(size=(300, 8)))
    data = [(int(k), [float(x) for x in np.float32(v)], 0) for k, v in zip(draw.permutation(900), found, strict=True)]
    frame = spark.createDataFrame(data, SCHEMA)
    pivots = vector_join._pivots(vector_join._classes(frame.withColumn("node", F.xxhash64("embedding"))))[0, 8]
    assert len(pivots) == 64 and (vector_join._chords(pivots, pivots) < 1e-7).sum() > 64 + 100
    got = vector_join.linked_vectors(frame, 0.93).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == by_force(data, 0.93)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    data = [(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (3, [0.0, 1.0], 1), (None, [1.0, 0.0], 1)]
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in
                  vector_join.linked_vectors(spark.createDataFrame(data, SCHEMA), 0.93).collect()))
    assert got == [(0, 0, 0, True), (3, 0, 3, True), (5, 1, 5, True), (5, 1, 5, True)]
    assert vector_join.linked_vectors(spark.createDataFrame([], SCHEMA), 0.93).count() == 0
