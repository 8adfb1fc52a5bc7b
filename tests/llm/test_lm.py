import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkwright.llm import lm

SCHEMA = "doc_id bigint, text string"


def by_force(texts, order, alpha=0.4):
    words = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) for _, t in texts]

    def grams(w):
        return Counter(tuple(w[i:i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)) + Counter({(): len(w)})

    total = sum((grams(w) for w in words), Counter())
    found = []
    for (key, _), w in zip(texts, words, strict=True):
        rest = total.copy()
        rest.subtract(grams(w))
        score, seen = 0.0, 0
        for i in range(len(w)):
            steps = 0
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i - n + 1:i + 1])
                if rest[gram] > 0:
                    score += math.log10(rest[gram] / rest[gram[:-1]]) + steps * math.log10(alpha)
                    seen += n == order
                    break
                steps += 1
            else:
                score += steps * math.log10(alpha) - math.log10(max(rest[()], 1))
        found.append((key, len(w), seen, round(score, 6), round(score / len(w), 6) if w else None))
    return found


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_are_those_of_the_counts_of_the_others(spark, monkeypatch, order):
    monkeypatch.setattr(lm, "BLOCK_BYTES", 700)
    monkeypatch.setattr(lm, "BUCKET_BYTES", 900)
    draw = random.Random(order)
    texts = [(k, " ".join(draw.choice("abcdefghijk") + draw.choice(["", "", "1", str(draw.randint(0, 99))]) for _ in range(draw.randint(0, 40))))
             for k in range(80)]
    texts += [(100, None), (101, ""), (102, "A b C"), (102, "A b C"), (None, "a b"), (103, "alone " * 5), (104, "a b " * 3000)]
    docs = spark.createDataFrame(texts, SCHEMA).withColumn("block", F.lit("own"))
    got = [(r["doc_id"], r["n_words"], r["n_seen"], round(r["log_score"], 6), r["mean_log"] if r["mean_log"] is None else round(r["mean_log"], 6))
           for r in lm.scores(docs, order).collect()]
    assert sorted(got, key=str) == sorted(by_force(texts, order), key=str)


def test_long_ngrams_are_asked_for_where_both_shorter_ones_are_shared(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(lm, "_ask", lambda *a, ask=lm._ask: asked.append(ask(*a)) or asked[-1])
    texts = [(0, "a b c d"), (1, "a b c e"), (2, "x b c d"), (3, "a b y"), (4, "p q r s t"), (5, "p q"), (6, "q r z a b c")]
    got = [(r["doc_id"], r["n_words"], r["n_seen"], round(r["log_score"], 6), round(r["mean_log"], 6))
           for r in lm.scores(spark.createDataFrame(texts, SCHEMA), 4).collect()]
    assert sorted(got) == sorted(by_force(texts, 4))
    sizes = [sum(len(r["keys"]) // 6 for r in level.collect()) for level in asked]
    assert len(sizes) == 3 and sizes[1:] == [3, 1]  # abc, bcd, pqr of 11 that there are; abcd of 8


def test_packed_counts_come_back():
    counts = np.array([1, 254, 255, 256, 0, 1 << 40, 3])
    assert (lm._unpacked(lm._packed(counts)) == counts).all() and len(lm._unpacked(lm._packed(counts[:0]))) == 0


def test_one_text_and_no_text(spark):
    docs = spark.createDataFrame([(1, "a b")], SCHEMA)
    row, = lm.scores(docs).collect()
    assert (row["n_words"], row["n_seen"], round(row["log_score"], 6)) == (2, 0, round(3 * math.log10(0.4), 6))
    assert lm.scores(docs.filter("false")).count() == 0
