"""Stupid-backoff language-model scores over n-gram count tables that are partitioned by hash.

Documents are dealt into blocks of bounded bytes. Every block asks for the counts of its distinct n-grams (n from 0,
the empty one, whose count is the size of the corpus): the n-grams go to buckets by hash, as packed arrays, one row per
block and bucket. A bucket adds up the counts of all blocks and answers each of them in the order asked. Back in their
blocks the counts are joined to the n-grams of every document and summed. N-grams of more than two words are asked for
in rounds of their own, and only where both of their shorter n-grams stand in another document. As an n-gram is asked for once per block,
a frequent one is no larger than any other: no bucket is hot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.words import Words, mix, words

#: Bytes of text in a block, and bytes of text whose n-grams share a bucket, about.
BLOCK_BYTES, BUCKET_BYTES = 4 << 20, 16 << 20

ALPHA = 0.4

#: Bits of a hash that are sent; the bucket holds the upper ones.
_LOW = np.uint64((1 << 48) - 1)


#: N-grams up to this size are asked for at once, longer ones size by size.
FIRST = 2


def _levels(order: int) -> list[list[int]]:
    """Sizes of n-grams by the round they are asked for in."""
    return [list(range(min(order, FIRST) + 1)), *([size] for size in range(FIRST + 1, order + 1))]


def _grams(part: Words, size: int, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last word and the hash of every n-gram of one size that is asked for.

    Above FIRST these are the ones whose first n - 1 and last n - 1 words both stand in another document, as
    ``rest`` tells; no other n-gram can stand there, and one that does is asked for by every document that has it.
    """
    if size == 0:
        n = len(part.hashes)
        return np.arange(n), np.full(n, mix(np.zeros(1, np.uint64), 61)[0])
    first, hashes = part.runs(size)
    last = first + size - 1
    if size > FIRST:
        open_ = (rest[size - 1][last] > 0) & (rest[size - 1][last - 1] > 0)
        last, hashes = last[open_], hashes[open_]
    return last, mix(hashes, 62 + size)


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket numbers; they rise with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _key(hashes: np.ndarray) -> np.ndarray:
    """What tells n-grams of one bucket apart."""
    return mix(hashes, 71) & _LOW


def _packed(counts: np.ndarray) -> bytes:
    """Counts as their number, a byte each, and 8 bytes for each from 255 on, as nearly all are small."""
    large = counts[counts >= 255].astype("<u8")
    return np.array(len(counts), "<u4").tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes() + large.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    every = np.frombuffer(data, np.uint8)
    n = 4 + int(every[:4].view("<u4")[0])
    counts = every[4:n].astype(np.int64)
    counts[counts == 255] = every[n:].copy().view("<u8")
    return counts


def _asked(table: pa.Table, answers: pa.Table | None, order: int, level: int, buckets: int) -> pa.Table:
    """Rows (block, bucket, keys, counts) for the distinct n-grams of a block and level, in the order of their hashes."""
    parts = list(words(_column(table, "text"), "spaced"))
    rests = _rests(parts, answers, order, level)
    every = [_grams(part, size, rest)[1] for part, rest in zip(parts, rests, strict=True) for size in _levels(order)[level]]
    distinct, counts = np.unique(np.concatenate(every) if every else np.empty(0, np.uint64), return_counts=True)
    bucket = _bucket(distinct, buckets)
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.empty(0, np.int64)
    stops = np.append(starts[1:], len(bucket))
    packed = np.zeros((len(distinct), 6), np.uint8)
    packed[:] = _key(distinct).view(np.uint8).reshape(-1, 8)[:, :6]
    block = table.column("block")[0]
    return pa.table({
        "block": pa.array([block.as_py()] * len(starts), pa.int64()), "bucket": pa.array(bucket[starts], pa.int64()),
        "keys": pa.array([packed[a:b].tobytes() for a, b in zip(starts, stops, strict=True)], pa.binary()),
        "counts": pa.array([_packed(counts[a:b]) for a, b in zip(starts, stops, strict=True)], pa.binary())})


def _answered(table: pa.Table) -> pa.Table:
    """Rows (block, bucket, totals): the counts of a bucket's n-grams over all blocks, in the order asked."""
    asked = [np.frombuffer(x.as_py(), np.uint8).reshape(-1, 6) for x in table.column("keys")]
    sizes = [len(a) for a in asked]
    wide = np.zeros((sum(sizes), 8), np.uint8)
    wide[:, :6] = np.concatenate(asked)
    counts = np.concatenate([_unpacked(x.as_py()) for x in table.column("counts")])
    _, which = np.unique(wide.view(np.uint64)[:, 0], return_inverse=True)
    totals = np.bincount(which, weights=counts).astype(np.int64)[which]
    return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                     "totals": pa.array([_packed(t) for t in np.split(totals, np.cumsum(sizes)[:-1])], pa.binary())})


def _own(row: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """How often each n-gram stands in its own row."""
    order = np.lexsort((gram, row))
    a, b = row[order], gram[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
    group = np.cumsum(new) - 1
    own = np.empty(len(row), np.int64)
    own[order] = np.bincount(group)[group]
    return own


def _rests(parts: list[Words], answers: pa.Table | None, order: int, levels: int) -> list[np.ndarray]:
    """Per slice the counts outside the own document, by size and by the last word of the n-gram, for the first levels."""
    rests = [np.zeros((order + 1, len(part.hashes)), np.int64) for part in parts]
    for level, sizes in enumerate(_levels(order)[:levels]):
        grams = [[(size, *_grams(part, size, rest)) for size in sizes] for part, rest in zip(parts, rests, strict=True)]
        every = [hashes for of in grams for _, _, hashes in of]
        distinct = np.unique(np.concatenate(every) if every else np.empty(0, np.uint64))
        given = answers.filter(pa.array(answers.column("level").to_numpy() == level))
        place = np.argsort(given.column("bucket").to_numpy(), kind="stable")
        packed = given.column("totals").to_pylist()
        totals = np.concatenate([_unpacked(packed[k]) for k in place]) if len(place) else np.empty(0, np.int64)
        if len(totals) != len(distinct):
            raise RuntimeError("a block was read twice with different rows; store the documents first")
        for part, rest, of in zip(parts, rests, grams, strict=True):
            row = part.rows()
            for size, last, hashes in of:
                gram = np.searchsorted(distinct, hashes)
                rest[size, last] = totals[gram] - (part.counts[row] if size == 0 else _own(row[last], gram))
    return rests


def _scored(table: pa.Table, answers: pa.Table, order: int, alpha: float) -> pa.Table:
    """Scores of a block's documents from the counts of its n-grams."""
    parts = list(words(_column(table, "text"), "spaced"))
    counted, seen, scores = [], [], []
    for part, rest in zip(parts, _rests(parts, answers, order, len(_levels(order))), strict=True):
        row = part.rows()
        n, rows = len(row), len(part.at) - 1
        value, steps, level = np.full(n, np.nan), np.zeros(n), np.zeros(n, np.int64)
        spot = np.arange(n) - part.at[:-1][row]  # words before this one in the text
        for size in range(order, 0, -1):
            open_ = np.isnan(value) & (spot >= size - 1)
            context = rest[0] if size == 1 else np.append(0, rest[size - 1][:-1])
            hit = open_ & (rest[size] > 0)
            value[hit] = np.log10(rest[size][hit] / context[hit]) + steps[hit] * math.log10(alpha)
            level[hit] = size
            steps[open_ & ~hit] += 1
        miss = np.isnan(value)  # a word that no other document has
        value[miss] = steps[miss] * math.log10(alpha) - np.log10(np.maximum(rest[0][miss], 1))
        counted.append(part.counts)
        seen.append(np.bincount(row[level == order], minlength=rows))
        scores.append(np.bincount(row, weights=value, minlength=rows))
    n_words = np.concatenate(counted) if counted else np.empty(0, np.int64)
    total = np.concatenate(scores) if scores else np.empty(0)
    return pa.table({
        "doc_id": table.column("doc_id"), "n_words": pa.array(n_words, pa.int64()),
        "n_seen": pa.array(np.concatenate(seen) if seen else np.empty(0, np.int64), pa.int64()), "log_score": pa.array(total),
        "mean_log": pa.array(total / np.maximum(n_words, 1), mask=n_words == 0)})


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)


def _ask(dealt: DataFrame, answered: DataFrame | None, order: int, level: int, buckets: int) -> DataFrame:
    """What the blocks ask for in a round, after the answers of the rounds before."""
    schema = "block bigint, bucket bigint, keys binary, counts binary"
    if answered is None:
        return dealt.groupBy("block").applyInArrow(lambda table: _asked(table, None, order, level, buckets), schema)
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        lambda table, answers: _asked(table, answers, order, level, buckets), schema)


def scores(docs: DataFrame, order: int = 2, alpha: float = ALPHA) -> DataFrame:
    """Stupid-backoff score of every document (doc_id, text) under the counts of all other documents.

    A word is scored by the longest n-gram, up to ``order``, that ends in it and stands in another document: the logarithm
    (base 10) of its count over that of its context, plus log(alpha) for each shorter n-gram gone to; single words are
    counted over all words. A word that no other document has counts as if it stood in the others a fraction alpha of
    once. Counts leave out the own document, so that a text is not its own evidence.

    Returns per row: doc_id, n_words, n_seen (words scored by a full n-gram), log_score (sum, 0 without words) and mean_log
    (per word, null without words). Words are runs of other than blanks, A-Z lower-cased. A null text has no words. Equal
    rows are separate documents and are each other's evidence. Other columns are not read; an empty table gives no rows.

    ``docs`` is read twice, and once more for each size of n-gram above two. It must give the same rows in the same order
    each time, as a stored table does. Hashes tell n-grams apart (48 bits within a bucket).
    """
    text = F.col("text").cast("string")
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks, buckets = max(1, -(-size // BLOCK_BYTES)), max(1, -(-size // BUCKET_BYTES))
    dealt = (docs.select("doc_id", F.coalesce(text, F.lit("")).alias("text"))
             .withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("bigint"))
             .repartition("block"))
    answered = None
    for level in range(len(_levels(order))):
        asked = _ask(dealt, answered, order, level, buckets)
        found = asked.groupBy("bucket").applyInArrow(_answered, "block bigint, bucket bigint, totals binary")
        found = found.withColumn("level", F.lit(level))
        answered = found if answered is None else answered.union(found)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        lambda table, answers: _scored(table, answers, order, alpha),
        f"doc_id {kind}, n_words bigint, n_seen bigint, log_score double, mean_log double")
