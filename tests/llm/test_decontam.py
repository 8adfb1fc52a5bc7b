import hashlib
import random
import re

from pyspark.sql import functions as F

from linkwright.llm import decontam

VOCABULARY = [f"w{k}" for k in range(12)]


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))


def by_force(text, items):
    words, hit, found = plain(text), set(), set()
    for item, item_text in items:
        w = plain(item_text)
        if item is None or not w:
            continue
        size = min(13, len(w))
        windows = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}
        for i in range(len(words) - size + 1):
            if tuple(words[i:i + size]) in windows:
                hit.update(range(i, i + size))
                found.add(str(item))
    digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    return len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)


def case(seed):
    draw = random.Random(seed)

    def say(n):
        return " ".join(draw.choice(VOCABULARY) for _ in range(n))

    items = [(k, say(draw.choice([1, 2, 3, 5, 12, 13, 14, 30]))) for k in range(12)] + [
        (3, say(20)), (50, None), (51, " ,. "), (None, say(13)), (52, "Éa, b!"), (7, items_long := say(40))]
    docs = [(k, say(draw.randint(0, 120))) for k in range(60)]
    docs += [(100 + k, f"{say(200)} {items_long.upper()} {say(200)}") for k in range(3)]
    docs += [(200, items_long), (201, None), (202, ""), (203, "éA b"), (203, "Éa. B"), (None, items_long), (204, say(3000))]
    return docs, items


def check(spark, docs, items):
    got = decontam.report(spark.createDataFrame(docs, "doc_id bigint, text string"),
                          spark.createDataFrame(items, "item_id bigint, text string")).collect()
    want = sorted(((i, *by_force(t, items)) for i, t in docs), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want


def test_hits_are_those_of_all_windows(spark):
    docs, items = case(5)
    check(spark, docs, items)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 40)
    docs, items = case(6)
    check(spark, docs, items)


def test_clean_keeps_rows_and_columns(spark):
    docs, items = case(7)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("n_words", F.lit("own")).withColumn("overlap", F.lit(1))
    left = decontam.clean(frame, spark.createDataFrame(items, "item_id bigint, text string"))
    assert left.columns == frame.columns
    want = sorted((i or -1 for i, t in docs if not by_force(t, items)[-1]))
    assert sorted(r["doc_id"] or -1 for r in left.collect()) == want


def test_empty_tables(spark):
    docs, items = case(8)
    frame, bench = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    assert decontam.report(frame.filter("false"), bench).count() == 0
    rows = decontam.report(frame, bench.filter("false")).collect()
    assert len(rows) == len(docs) and not any(r["n_hit"] or r["contaminated"] for r in rows)


def test_clean_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "five")], "doc_id bigint, text string")
    for name in ("_overlap", "overlap", "own_0", "OWN_1"):
        docs = docs.withColumn(name, F.lit("own"))
    bench = spark.createDataFrame([("i", "one two three four")], "item_id string, text string")
    got = decontam.clean(docs, bench)
    assert got.columns == docs.columns and [r["doc_id"] for r in got.collect()] == [2]
