import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from linkwright.llm import bpe

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = ["a", "b", "the", " ", "  ", "\n", "'s", "'ll", "é", "ß", "漢", "😀", "\x00", "\x1c", " ", "0", "12", "!!", "###",
         "\x85", "\xa0", "ing", "tion", "\\", "aaaa", "́", "zqx", "ue"]


@pytest.fixture(scope="module")
def ranks():
    with open(FILE, "rb") as data:
        return bpe.Ranks(data.read())


@pytest.fixture(scope="module")
def known(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ids, special_tokens={})


def texts(seed, n, most=40):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, most))) for _ in range(n)]


def test_ids_and_round_trip(ranks, known):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for text in texts(1, 3000):
        ids = np.frombuffer(b"".join(encoder.parts(text)), "<u4")
        assert ids.tolist() == known.encode_ordinary(text)
        assert ranks.decode(ids) == text.encode()


def test_long_texts_are_read_in_parts(ranks, known, monkeypatch):
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe.text_parts, "__defaults__", (50,))
    for text in [*texts(2, 300, 200), "x" * 400, " " * 400, "ab " * 200, "a  b\n c " * 60]:
        parts = list(encoder.parts(text))
        assert np.frombuffer(b"".join(parts), "<u4").tolist() == known.encode_ordinary(text)
    assert len(list(bpe.text_parts("ab " * 200, 50))) > 5


def test_appends_and_edits_give_the_encoding_of_the_whole(ranks, known):
    draw = random.Random(3)

    def whole(text):
        return bpe.Prefixes(ranks, text).encoding()

    for _ in range(200):
        a, b, c = ("".join(draw.choice("abcdeting the") for _ in range(draw.randint(0, 12))).encode() for _ in range(3))
        grown = bpe.Prefixes(ranks, a)
        grown.append(b)
        assert grown.encoding() == whole(a + b)
        start = draw.randint(0, len(a + b))
        stop = draw.randint(start, len(a + b))
        before = grown.last[:start]
        grown.edit(start, stop, c)
        assert grown.text == (a + b)[:start] + c + (a + b)[stop:]
        assert grown.last[:start] == before and grown.encoding() == whole(grown.text)


def test_an_edit_is_encoded_again_only_near_the_edit(ranks, monkeypatch):
    draw = random.Random(6)
    text = "".join(draw.choice("abcdeting the") for _ in range(6000)).encode()
    done, append = [0], bpe.Prefixes.append

    def counted(self, more):
        done[0] += len(more)
        append(self, more)

    monkeypatch.setattr(bpe.Prefixes, "append", counted)
    for _ in range(20):
        grown = bpe.Prefixes(ranks, text)
        start = draw.randint(0, 5000)
        done[0] = 0
        grown.edit(start, start + draw.randint(0, 5), b"xyz")
        assert done[0] <= 4 * ranks.longest
        assert grown.last == bpe.Prefixes(ranks, grown.text).last


def test_batches_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_BYTES", 10)
    texts = ["a" * 4, None, "b" * 6, "", "c" * 30, "d", None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["doc_id", "text"])
    parts = list(bpe.sliced(iter([batch, batch.slice(0, 0)])))
    assert [t for p in parts for t in p.column(1).to_pylist()] == texts and [p.num_rows for p in parts] == [4, 1, 2]


def test_remembered_pieces_and_pairs_may_be_forgotten(ranks, known, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 1500)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 5)
    monkeypatch.setattr(bpe, "KEPT_PREFIXES", 5)
    encoder = bpe.Encoder(bpe.Ranks(open(FILE, "rb").read()), public_tokenizers.PATTERN)
    for text in texts(4, 200):
        assert np.frombuffer(b"".join(encoder.parts(text)), "<u4").tolist() == known.encode_ordinary(text)


def test_table(spark, known):
    rows = [(1, "The thing"), (2, None), (3, ""), (None, "a"), (1, "The thing"), (4, "éa " * 40_000), (5, "\x00" * 5000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_tokens", F.lit("own")).withColumn("ids", F.lit(0))
    got = bpe.encode(docs, FILE, public_tokenizers.PATTERN, ids=True).collect()
    assert len(got) == len(rows)
    want = sorted(str((i, known.encode_ordinary(t or ""), hashlib.sha256((t or "").encode()).hexdigest())) for i, t in rows)
    assert sorted(str((r["doc_id"], r["ids"], r["decoded_sha256"])) for r in got) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    assert all(r["ids_sha256"] == hashlib.sha256(np.array(r["ids"], "<u4").tobytes()).hexdigest() for r in got)
    assert bpe.encode(docs.filter("false"), FILE, public_tokenizers.PATTERN).count() == 0


def test_only_lengths_of_tokens_with_the_same_end_are_looked_up():
    with open(FILE, "rb") as data:
        ranks = bpe.Ranks(data.read())
    looked = []

    class Seen(dict):
        def get(self, token, default=None):
            looked.append(token)
            return super().get(token, default)

    for token in ranks.merged:
        assert len(token) < 3 or len(token) in ranks.tails[token[-3:]]
    ranks.merged = Seen(ranks.merged)
    text = b" internationalisation unbelievably straightforward" * 3
    assert b"".join(ranks.tokens[t] for t in bpe.Prefixes(ranks, text).encoding()) == text
    ends = {(t[-3:], len(t)) for t in ranks.merged}
    assert all(len(t) < 3 or (t[-3:], len(t)) in ends for t in looked)
