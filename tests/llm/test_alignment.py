import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from linkwright.llm import alignment
from linkwright.llm.alignment import Fragment, align, joined, settle

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", " the", " ", "  ", "\n", "'s", "'re", "é", "漢", "😀", "\x00", "12", " 7", "!!", "<|endoftext|>", "<s>", "\t",
         "aaaa", "́", "zqx", "unbelievable ", "tion", " of", "。", " ", "\x1c"]


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())


def texts(seed, n, most, parts=PARTS):
    draw = random.Random(seed)
    return ["".join(draw.choice(parts) for _ in range(draw.randint(0, most))) for _ in range(n)]


def groups(pair, text):
    """Groups by the libraries' whole encodings; None where a text has no tokens."""
    whole = b" " + text.encode()
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    if not text or b"".join(pair.of_a[i] for i in a) != whole or b"".join(pair.of_b[i] for i in b) != whole:
        return None
    found, i, j, at_a, at_b = [], 0, 0, 0, 0
    while i < len(a):
        group = ([], [])
        while True:
            if at_a <= at_b and i < len(a):
                group[0].append(a[i])
                at_a += len(pair.of_a[a[i]])
                i += 1
            else:
                group[1].append(b[j])
                at_b += len(pair.of_b[b[j]])
                j += 1
            if at_a == at_b:
                break
        found.append(group)
    return found


def plain(pair, rows):
    """The contract, text by text."""
    of = [groups(pair, t or "") for _, t in rows]
    links = [Counter((x, y) for a, b in g or [] for x in a for y in b) for g in of]
    held = Counter(p for c in links for p in c)
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    out = []
    for (i, _), g, c in zip(rows, of, links):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or [])
        out.append((i, sum(len(a) for a, _ in g or []), sum(len(b) for _, b in g or []), len(g or []), sum(c.values()),
                    sum(n for p, n in c.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in c.items()),
                    hashlib.sha256(spelled.encode()).hexdigest() if g else ""))
    return out


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(spark, pair, rows, **options):
    got = align(spark.createDataFrame(rows, "doc_id bigint, text string"), A, B, **options)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=str) == sorted(plain(pair, rows), key=str)


LONG = ["x" * 3000, " " * 900 + "y", "the end of it " * 60, "ab  cd " * 90, "x" * 300 + " one two " * 40 + "漢" * 200, "\n" * 200 + "a",
        "trailing ", " leading", "a" * 90 + "▁" + "b" * 90]


@pytest.mark.parametrize("size", [7, 32, 150])
def test_long_texts_are_folded_in_a_tree(spark, pair, size, monkeypatch):
    monkeypatch.setattr(alignment, "FAN", 3)
    rows = list(enumerate(texts(1, 25, 60) + (LONG if size > 7 else LONG[3:4]) + [None, ""]))
    check(spark, pair, rows, range_bytes=size)


def test_short_texts(spark, pair, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 900)
    check(spark, pair, list(enumerate(texts(2, 400, 40) + LONG + ["the same text"] * 7 + [None, "", " ", "  "])))


def test_joining_is_associative(pair):
    draw = random.Random(3)
    for text in [t for t in texts(4, 150, 40) if groups(pair, t)]:
        data = b" " + text.encode()
        cuts = [dict(zip(("begin", "end", "place", "bytes"), r), whole=len(data)) for r in alignment.ranges(data, draw.randint(1, 9))]
        pieces = [fragment for fragment, _ in alignment._of_ranges(pair, cuts)]

        def shape(f: Fragment):
            open_ = [(t.a.tolist(), t.b.tolist()) for t in (f.prefix, f.suffix)]
            return open_, f.low, f.high, sum(len(t.a) for _, t in f.runs), sorted((p, len(t.a)) for p, t in f.runs)[:1]

        while len(pieces) > 2:
            k = draw.randint(0, len(pieces) - 3)
            x, y, z = pieces[k:k + 3]
            assert shape(joined(joined(x, y, pair), z, pair))[:4] == shape(joined(x, joined(y, z, pair), pair))[:4]
            k = draw.randint(0, len(pieces) - 2)
            pieces[k:k + 2] = [joined(pieces[k], pieces[k + 1], pair)]
        whole = pieces[0] if len(pieces) == 1 else joined(*pieces, pair)
        assert (whole.low, whole.high, len(whole.prefix.a), len(whole.suffix.a)) == (0, len(data), 0, 0)
        found = []
        for _, run in sorted(whole.runs, key=lambda r: r[0]):
            ends, of_a, of_b = pair.groups(run.a, run.b)
            strings, edges = alignment.spelled(pair, run.a, run.b, of_a, of_b, len(ends))
            found += ["".join(strings[x:y])[:-1] for x, y in zip([0, *edges[:-1]], edges)]
        assert found == [",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups(pair, text)]
    assert settle(alignment.NOTHING, pair).low is None


def test_ranges_cover_the_text_and_begin_at_cuts():
    for text in [*texts(5, 200, 60), "x" * 500, " " * 500, "a b" * 300]:
        data = b" " + text.encode()
        found = list(alignment.ranges(data, 20))
        assert [b for b, *_ in found] == [0, *[e for _, e, *_ in found[:-1]]] and found[-1][1] == len(data)
        for begin, end, place, piece in found:
            assert place <= begin and data[place:place + len(piece)] == piece and place + len(piece) >= end
            assert place == 0 or alignment._is_cut(data, place)
        assert sum(len(piece) for *_, piece in found) <= 4 * len(data) + 100


def test_odd_rows(spark, pair):
    rows = [(1, "The thing"), (1, "The thing"), (None, "a b"), (None, None), (2, ""), (3, "x▁y"), (4, "word and " * 6000), (4, "word and " * 6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for name in ("row_no", "no", "block", "pair", "pairs", "n", "best", "low", "a", "b", "bad", "run", "part", "n_a", "sha", "times"):
        docs = docs.withColumn(name, F.lit("own"))
    got = align(docs, A, B)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(plain(pair, rows), key=str)
    assert align(docs.filter("false"), A, B).count() == 0
