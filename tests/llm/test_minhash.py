import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright.llm import minhash

SCHEMA = "doc_id bigint, text string"


def sets(texts):
    found = {}
    for key, text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
        found[key] = ({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}) if w else set()
    return found


def by_force(texts):
    """component of every id, by comparing all pairs; ids are distinct."""
    of = sets(texts)
    root = {k: k for k in of}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = sorted(of)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(of[a] & of[b])
            if of[a] and of[b] and 100 * both >= 75 * (len(of[a]) + len(of[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}, {k: len(s) for k, s in of.items()}


def near_copies(draw, n, length, changes):
    words = [f"w{draw.randint(0, 10**6)}" for _ in range(length)]
    for _ in range(n):
        copy = list(words)
        for _ in range(draw.randint(0, changes)):
            copy[draw.randrange(length)] = f"x{draw.randint(0, 10**6)}"
        cut = draw.choice([0, 0, 0, draw.randint(0, length // 4)])
        yield " ".join(copy[:length - cut])


def check(spark, texts):
    got = minhash.near_duplicates(spark.createDataFrame(texts, SCHEMA)).collect()
    want, sizes = by_force(texts)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == sizes
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_groups_of_near_copies_are_those_of_all_pairs(spark):
    draw = random.Random(3)
    texts = [t for n, length, changes in [(120, 60, 5), (40, 150, 9), (30, 12, 1), (20, 6, 1), (15, 400, 25)]
             for t in near_copies(draw, n, length, changes)]
    texts += ["A b c", "a  B\tC", "a b", "", "  ", None, "a b c d e", "a b c d e f", "É é", "é é"]
    draw.shuffle(texts)
    check(spark, list(enumerate(texts)))


def test_a_passage_in_many_texts_links_nothing(spark):
    draw = random.Random(4)
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [passage + " " + " ".join(f"w{draw.randint(0, 10**6)}" for _ in range(60)) for _ in range(80)]
    check(spark, list(enumerate(texts)))


def test_nulls_repeats_empty_tables_and_clashing_columns(spark):
    long = "very long text " * 20_000
    rows = [(None, "a b c d e f", 1), (None, "a b c d e f", 1), (4, None, 1), (5, "", 1), (7, "a b c d e f", 1),
            (7, "a b c d e f", 2), (9, "A B C D E F", 3), (11, long, 4), (12, long, 4), (13, "x y", 1), (13, "other", 1)]
    docs = spark.createDataFrame(rows, SCHEMA + ", component_id int").withColumn("node", F.lit("x")).withColumn("key", F.lit(1))
    got = sorted((r["doc_id"] or 0, r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect())
    assert got == [(0, None, True), (0, None, True), (4, 4, True), (5, 5, True), (7, 7, True), (7, 7, True), (9, 7, False),
                   (11, 11, True), (12, 11, False), (13, 13, True), (13, 13, True)]
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 4, 5, 7, 11, 13, 13]
    none = docs.filter("false")
    assert minhash.near_duplicates(none).count() == 0 and minhash.one_of_each(none).count() == 0


@pytest.mark.parametrize("first, second, linked", [(7, 7, True), (8, 7, False)])
def test_the_bound_itself_links(spark, first, second, linked):
    # 6 of 8 shingles shared is 0.75; 6 of 9 is less
    base = [f"w{k}" for k in range(10)]
    a, b = base + [f"a{k}" for k in range(first - 6)], base + [f"b{k}" for k in range(second - 6)]
    got = minhash.near_duplicates(spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], SCHEMA))
    assert [r["component_id"] for r in got.orderBy("doc_id").collect()] == ([1, 1] if linked else [1, 2])


@pytest.mark.parametrize("both, left, right", [(24, 0, 8), (24, 0, 1), (22, 0, 7), (15, 2, 3), (75, 12, 13)])
def test_pairs_at_the_threshold_share_a_band(both, left, right):
    draw = np.random.default_rng(both)
    sets = []
    for _ in range(3000):
        drawn = draw.integers(0, 2**64 - 1, both + left + right, np.uint64)
        sets += [np.sort(drawn[:both + left]), np.sort(np.concatenate([drawn[:both], drawn[both + left:]]))]
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    for first in range(0, len(sets), 500):
        mine = (rows >= first) & (rows < first + 500)
        *_, keys = minhash.sketch_of(500, rows[mine] - first, np.concatenate(sets[first:first + 500]))
        assert (keys[0::2] == keys[1::2]).any(axis=1).all()


def test_filled_bins_keep_their_values():
    draw = np.random.default_rng(1)
    filled = draw.random((50, minhash.BINS)) < np.linspace(0, 0.5, 50)[:, None]
    signature = np.where(filled, draw.integers(1, 1 << 60, filled.shape), 0).astype(np.uint64)
    got = minhash.densified(signature.copy(), filled)
    assert (got[filled] == signature[filled]).all()
    assert (got[filled.any(1)] != 0).all() and (got[~filled.any(1)] == 0).all()


def test_one_of_each_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x"), (3, "y"), (None, "x")], "doc_id bigint, text string")
    for name in ("own_0", "OWN_1", "_gone", "_again", "_id", "_hash", "component_id", "component", "text_hash", "count"):
        docs = docs.withColumn(name, F.lit("own"))
    got = minhash.one_of_each(docs)
    assert got.columns == docs.columns and sorted(str(r["doc_id"]) for r in got.collect()) == ["1", "3", "3", "None"]
