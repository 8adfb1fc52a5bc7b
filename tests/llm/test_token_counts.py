import json
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from linkwright.llm import segments, token_counts
from tests.conftest import rows

FILE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "the", " the", " ", "  ", "\n", "\n\n", "'s", "'", "r", "e", "'re", "é", "漢", "😀", "\x00", "\x1c", " ", " ",
         "▁", "᠎", "12", " 7", "!!", "<|endoftext|>", "<|endof", "text|>", "\t", "aaaa", "́", "zqx", "\x85"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(open(FILE, encoding="utf-8").read())


def texts(seed, n, most):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, most))) for _ in range(n)]


def count(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_counts_of_segments_add_up(counter, library, monkeypatch):
    drawn = texts(1, 3000, 40)
    assert counter.counts(drawn) == [count(library, t) for t in drawn]
    assert any(len(segments.cut(t)) > 3 for t in drawn)
    monkeypatch.setattr(token_counts, "KEPT_BYTES", 500)
    assert counter.counts(drawn) == [count(library, t) for t in drawn] and not counter.known


def test_lumps_hold_every_segment_once():
    given = [" a", " b!", "first", " end\n", "", " ", "  x", " c" * 20]
    made, order = segments.lumps(given, 4)
    assert sorted(order) == list(range(len(given))) and "".join(made) == "".join(given[i] for i in order)


def test_bytes_of_every_token(library):
    known = segments.byte_tokens(library)
    for text in texts(2, 300, 30):
        ids = library.encode(text, add_special_tokens=False).ids
        assert b"".join(known[i] for i in ids) == text.encode()


@pytest.mark.parametrize("chunk, overlap", [(40, 4), (64, 24), (200, 32)])
def test_huge_texts(spark, library, chunk, overlap):
    given = texts(3, 120, 160) + [
        "x" * 3000, " " * 1500 + "y", "ab " * 700, "x" * 500 + " one two three " * 40 + "漢" * 700, "\n" * 900 + "a",
        "it's we're <|endoftext|>" * 60, "don't " * 300, "<|endoftext|>" * 100, None, "", " "]
    docs = spark.createDataFrame(list(enumerate(given)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in token_counts.token_counts(docs, FILE, 512, chunk, overlap).collect()}
    assert len(got) == len(given)
    for i, text in enumerate(given):
        n = count(library, text)
        assert (got[i]["n_tokens"], got[i]["n_bytes"], got[i]["over_limit"]) == (n, len((text or "").encode()), n > 512), text


def test_odd_rows(spark, library):
    long = "word " * 9000
    given = [(1, "The thing"), (1, "The thing"), (None, "a b"), (None, long), (2, None), (3, ""), (3, long), (3, long)]
    docs = spark.createDataFrame(given, "doc_id bigint, text string")
    for name in ("n_tokens", "n_bytes", "row_no", "no", "cuts", "chars", "starts", "c", "first", "n", "left", "right", "gain", "lang"):
        docs = docs.withColumn(name, F.lit("own"))
    got = token_counts.token_counts(docs, FILE)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), count(library, t), count(library, t) > 512) for i, t in given]
    assert sorted(rows(got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(docs.filter("false"), FILE).count() == 0


def test_only_byte_level_tokenizers_are_taken(tmp_path):
    with pytest.raises(ValueError):
        segments.require_byte_level(json.load(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8")))
    with pytest.raises(ValueError):
        token_counts.token_counts(None, FILE, chunk_chars=10, overlap_chars=10)
