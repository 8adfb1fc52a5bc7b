"""The bound queries of the subpackage against their SQL, and the rest against what must hold."""

import glob
import hashlib
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry
from linkwright.llm import queries as llm
from tests.test_queries import table

FOLDER = "/root/testdata/sf0.001"


def duck(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM '{path}'")
    return con


def documents():
    return pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_matches_its_sql(spark, name):
    folder = "/root/testdata/sf0.01" if name.startswith("op1_") else FOLDER  # no page of the smallest table is damaged
    got = entry.queries()[name](spark, folder)
    data = [tuple(r) for r in got.collect()]
    result = duck(folder).execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert data and sorted(names) == sorted(got.columns)
    assert table(got.columns, data) == table(names, result.fetchall())


def test_all_thirteen_are_bound():
    found = entry.queries()
    assert "pipeline" in found
    assert {name.split("_")[0] for name in llm.QUERIES if name != "capacity_shards"} == {f"op{n}" for n in range(1, 14)}


def test_shards(spark):
    rows = entry.queries()["op2_best_fit_shards"](spark, FOLDER).collect()
    docs = documents()
    assert Counter(r["doc_id"] for r in rows) == Counter(d["doc_id"] for d in docs)
    of = {d["doc_id"]: (d["text"] or "").encode() for d in docs}
    places, texts, sizes = {}, {}, Counter()
    for r in rows:
        assert r["size"] == len(of[r["doc_id"]]) + 16 and r["text_crc32"] == zlib.crc32(of[r["doc_id"]])
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 40
        texts.setdefault(of[r["doc_id"]], set()).add(r["shard"])
        places.setdefault(r["shard"], []).append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(len(s) == 1 for s in texts.values())
    assert all(sorted(s) == list(range(len(s))) for s in places.values())
    groups = Counter()
    for r in rows:
        groups[of[r["doc_id"]]] += r["size"]
    even = sum(sizes.values()) / 40
    assert max(sizes.values()) <= max(1.05 * even, max(groups.values()))


def test_shards_of_fixed_capacity(spark):
    from tests.llm.test_sharding import loads, places
    rows = entry.queries()["capacity_shards"](spark, FOLDER).collect()
    docs = documents()
    groups = Counter()
    for d in docs:
        groups[d["text"] or ""] += len((d["text"] or "").encode()) + 16
    placed, bins = places(list(Counter(groups.values()).items()), llm.SHARD_BYTES)
    assert Counter(r["doc_id"] for r in rows) == Counter(d["doc_id"] for d in docs)
    load = loads([(r["size"], r["shard"]) for r in rows])
    assert load == Counter({r["shard"]: r["shard_bytes"] for r in rows}) and len(load) == bins
    assert sorted(load.values()) == sorted(loads(placed).values())


def test_tokens(spark):
    data = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
    from linkwright.llm.bpe import Ranks
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=Ranks(data).ids, special_tokens={})
    rows = {r["doc_id"]: r for r in entry.queries()["op9_bpe_prefix_dp"](spark, FOLDER).collect()}
    for d in documents():
        text, r = d["text"] or "", rows[d["doc_id"]]
        ids = known.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_quality(spark):
    folder = "/root/testdata/sf0.01"
    rows = entry.queries()["op10_rule_ensemble"](spark, folder).toPandas()
    labels = pq.read_table(f"{folder}/labels.parquet").to_pandas()
    assert (rows["held_out"] == rows["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert rows["score"].between(0, 1).all() and (rows["predicted"] == (rows["score"] >= 0.3)).all()
    held = rows[rows["held_out"]].merge(labels, on="doc_id")
    assert (held["predicted"] == held["quality"]).mean() > 0.95


def test_whitening(spark):
    from tests.llm.test_whitening import compare, plain
    rows = pq.read_table(f"{FOLDER}/embeddings.parquet").to_pylist()
    whole = [(r["vec_id"], r["embedding"]) for r in rows if r["embedding"] is not None]
    compare(entry.queries()["op11_block_whitening"](spark, FOLDER).collect(), plain(whole))


def test_token_counts(spark):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = {r["doc_id"]: r for r in entry.queries()["op12_spliced_counts"](spark, FOLDER).collect()}
    assert len(rows) == len(documents())
    for d in documents():
        n, r = len(library.encode(d["text"] or "", add_special_tokens=False).ids), rows[d["doc_id"]]
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len((d["text"] or "").encode()), n > 512)


def test_alignment(spark):
    from tests.llm.test_alignment import A, B, COLUMNS, plain
    from linkwright.llm.alignment import Pair
    known = Pair(open(A, encoding="utf-8").read(), open(B, "rb").read())
    got = entry.queries()["op13_fragment_alignment"](spark, FOLDER).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(plain(known, [(d["doc_id"], d["text"]) for d in documents()]))
