import random
import re

import numpy as np
import pyarrow as pa

from linkwright.llm import words as w
from linkwright.llm.components import components

PATTERNS = {"spaced": r"[^\x20\x09-\x0D]+", "plain": r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"}
PARTS = ["Ab", "c1", " ", "\n", "é", "ß", "漢", ",", "-", "\x00", "\x1c", "😀", "Z", "\t", "_", "\x7f", ""]


def lower(text):
    return text.translate({k: k + 32 for k in range(65, 91)})


def test_words_are_those_of_the_pattern(monkeypatch):
    draw = random.Random(1)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 40))) for _ in range(400)] + [None, "", " ", "x" * 5000]
    for most in (64, 1 << 20):
        monkeypatch.setattr(w.slices, "__defaults__", (most,))
        for alphabet, pattern in PATTERNS.items():
            want = [re.findall(pattern, lower(t or "")) for t in texts]
            codes: dict[str, int] = {}
            rows = 0
            for part in w.words(pa.array(texts), alphabet):
                rows += len(part.counts)
                for k, n in enumerate(part.counts):
                    mine = part.hashes[part.at[k]:part.at[k + 1]]
                    assert n == len(want[part.first + k])
                    for word, code in zip(want[part.first + k], mine.tolist(), strict=True):
                        assert codes.setdefault(word, code) == code
            assert rows == len(texts) and len(set(codes.values())) == len(codes)


def test_runs_stay_inside_a_text():
    part, = w.words(pa.array(["a b c", "", "d", "e f"]), "spaced")
    first, hashes = part.runs(2)
    assert first.tolist() == [0, 1, 4] and len(np.unique(hashes)) == 3


def test_arrow_slices_and_large_strings():
    texts = pa.array(["skip", "a b", None, "c"])
    want = [p.counts.tolist() for p in w.words(pa.array(["a b", None, "c"]), "plain")]
    assert [p.counts.tolist() for p in w.words(texts.slice(1), "plain")] == want
    assert [p.counts.tolist() for p in w.words(texts.slice(1).cast(pa.large_string()), "plain")] == want


def test_components_are_those_of_union_find(spark):
    draw = random.Random(2)
    links = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(170)]
    links += [(k, k + 1) for k in range(1000, 1060)] + [(5, 5), (2000, 2001), (2000, 2001)]
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "a bigint, b bigint"))
    assert sorted((r["node"], r["component"]) for r in got.collect()) == sorted((x, find(x)) for x in linked)


def test_no_links_give_no_components(spark):
    assert components(spark.createDataFrame([(1, 1), (None, 2)], "a bigint, b bigint")).count() == 0
