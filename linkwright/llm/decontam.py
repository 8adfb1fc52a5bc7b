"""Benchmark decontamination by a prefix-filtered join of word windows.

An item's windows are its runs of WINDOW consecutive words (a shorter item is one window). Seen as a set of short
shingles, a window lies in a document only if all its shingles do, so any one of them is a necessary prefix; the
rarest one in the corpus is joined on. A document place where that shingle stands gives a candidate only if the
whole window fits into the document around it (length and position), and the candidate counts only if every word of
the window stands there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linkwright.llm.names import free_names
from linkwright.llm.words import Words, hashes_of, run_hash, words

WINDOW, SHINGLE = 13, 3

#: Words of the items that are matched in one pass over the documents; more items take more passes.
BLOCK_WORDS = 250_000

FOUND = "n_words bigint, n_hit bigint, ranges array<int>, items array<string>"
FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("ranges", pa.list_(pa.int32())),
                         ("items", pa.list_(pa.string()))])

_SLOTS = 1 << 20


class Places:
    """Looks many hashes up in a fixed sorted set; most misses end at one small table."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self._seen = np.zeros(_SLOTS, bool)
        self._seen[self.values >> np.uint64(44)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where ``hashes`` are in the set: their places among the hashes, and in the sorted values."""
        at = np.flatnonzero(self._seen[hashes >> np.uint64(44)])
        if not len(at) or not len(self.values):
            return at[:0], at[:0]
        of = np.searchsorted(self.values, hashes[at])
        of[of == len(self.values)] = 0
        same = self.values[of] == hashes[at]
        return at[same], of[same]


class Windows:
    """All windows of a block of items: word hashes, length, item."""

    def __init__(self, ids: list[str], hashes: list[np.ndarray]):
        self.ids = sorted(set(ids))
        number = {item: k for k, item in enumerate(self.ids)}
        found: dict[bytes, set[int]] = {}
        for item, words_ in zip(ids, hashes, strict=True):
            size = min(WINDOW, len(words_))
            for first in range(len(words_) - size + 1 if size else 0):
                found.setdefault(words_[first:first + size].tobytes(), set()).add(number[item])
        self.words = [np.frombuffer(w, np.uint64) for w in found]
        self.items = [sorted(items) for items in found.values()]
        self.sizes = sorted({min(SHINGLE, len(w)) for w in self.words})

    def shingles(self) -> dict[int, np.ndarray]:
        """Hashes of all shingles, by size: SHINGLE words, or all words of a shorter window."""
        of: dict[int, list[np.ndarray]] = {}
        for w in self.words:
            size = min(SHINGLE, len(w))
            of.setdefault(size, []).append(run_hash(w, np.arange(len(w) - size + 1), size))
        return {size: np.unique(np.concatenate(parts)) for size, parts in of.items()}

    def prefixes(self, counts: dict[tuple[int, int], int]) -> dict[int, dict[str, np.ndarray]]:
        """The rarest shingle of every window with its place in it; ties go to the first place."""
        rows: dict[int, list[tuple]] = {}
        for k, w in enumerate(self.words):
            size = min(SHINGLE, len(w))
            of = run_hash(w, np.arange(len(w) - size + 1), size)
            offset = min(range(len(of)), key=lambda j: (counts.get((size, int(of[j])), 0), j))
            rows.setdefault(size, []).append((int(of[offset]), offset, len(w), k))
        found = {}
        for size, of_size in rows.items():
            of_size.sort()
            found[size] = {
                "hash": np.array([r[0] for r in of_size], np.uint64), "offset": np.array([r[1] for r in of_size]),
                "length": np.array([r[2] for r in of_size]), "window": np.array([r[3] for r in of_size])}
        return found


def _rarity(docs: DataFrame, text: str, shingles: dict[int, np.ndarray]) -> dict[tuple[int, int], int]:
    """How often each shingle of the items stands in the documents; at most one number per shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {size: Places(of) for size, of in shingles.items()}
        total = {size: np.zeros(len(p.values), np.int64) for size, p in places.items()}
        for batch in batches:
            for part in words(batch.column(0), "plain"):
                for size, p in places.items():
                    _, of = p.find(part.runs(size)[1])
                    total[size] += np.bincount(of, minlength=len(p.values))
        for size, p in places.items():
            some = np.flatnonzero(total[size])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), size), pa.int32()), pa.array(p.values[some].view(np.int64)),
                 pa.array(total[size][some], pa.int64())], ["size", "hash", "n"])

    counted = (docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "size int, hash bigint, n bigint")
               .groupBy("size", "hash").agg(F.sum("n").alias("n")))
    return {(r["size"], r["hash"] % (1 << 64)): r["n"] for r in counted.collect()}


class _Matcher:
    """Finds the windows of a block in slices of documents."""

    def __init__(self, windows: Windows, prefixes: dict[int, dict[str, np.ndarray]]):
        self.items, self.prefixes = windows.items, prefixes
        self.places = {size: Places(of["hash"]) for size, of in prefixes.items()}
        self.of_place = {size: np.searchsorted(of["hash"], np.append(self.places[size].values, np.uint64(2**64 - 1)))
                         for size, of in prefixes.items()}
        for size, of in prefixes.items():
            self.of_place[size][-1] = len(of["hash"])
        self.length = np.array([len(w) for w in windows.words])
        self.whole = np.zeros((len(windows.words), WINDOW), np.uint64)
        for k, w in enumerate(windows.words):
            self.whole[k, :len(w)] = w

    def find(self, part: Words) -> tuple[np.ndarray, np.ndarray]:
        """First words and numbers of all windows that stand in the slice."""
        begins, found = [], []
        total = len(part.hashes)
        row_of = None
        for size, of in self.prefixes.items():
            first, hashes = part.runs(size)
            at, place = self.places[size].find(hashes)
            if not len(at):
                continue
            if row_of is None:
                row_of = part.rows()
            low, high = self.of_place[size][place], self.of_place[size][place + 1]
            many = high - low
            rule = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
            stands = np.repeat(first[at], many)
            begin, length = stands - of["offset"][rule], of["length"][rule]
            row = row_of[stands]
            fits = (begin >= part.at[row]) & (begin + length <= part.at[row + 1])
            begin, window, length = begin[fits], of["window"][rule][fits], length[fits]
            same = np.ones(len(begin), bool)
            for k in range(WINDOW):
                here = k < length
                same &= ~here | (part.hashes[np.minimum(begin + k, total - 1)] == self.whole[window, k])
            begins.append(begin[same])
            found.append(window[same])
        if not begins:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(begins), np.concatenate(found)


def _scan(docs: DataFrame, text: str, matcher: _Matcher, names: list[str], out: str) -> DataFrame:
    """``docs`` with what the windows of one block give, added to what earlier blocks gave in ``out``."""
    place, before = docs.columns.index(text), docs.columns.index(out) if out in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(before).to_pylist() if before is not None else None
            rows: list[dict] = []
            for part in words(batch.column(place), "plain"):
                counts = part.counts.tolist()
                ranges: list[list[int]] = [[] for _ in counts]
                items: list[set[str]] = [set() for _ in counts]
                if old is not None:
                    ranges = [o["ranges"] for o in old[part.first:part.first + len(counts)]]
                    items = [set(o["items"]) for o in old[part.first:part.first + len(counts)]]
                begin, window = matcher.find(part)
                row = np.searchsorted(part.at, begin, "right") - 1
                for r, w in set(zip(row.tolist(), window.tolist(), strict=True)):
                    items[r].update(names[k] for k in matcher.items[w])
                for r in np.unique(row).tolist():
                    mine = row == r
                    first = begin[mine] - part.at[r]
                    last = first + matcher.length[window[mine]]
                    if ranges[r]:
                        first, last = np.append(first, ranges[r][::2]), np.append(last, ranges[r][1::2])
                    ranges[r] = joined_ranges(first, last)
                rows += [{"n_words": n, "n_hit": sum(a[1::2]) - sum(a[::2]), "ranges": a, "items": sorted(b)}
                         for n, a, b in zip(counts, ranges, items, strict=True)]
            columns = [c for k, c in enumerate(batch.columns) if k != before]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, FOUND_ARROW)], [*kept, out])

    kept = [c for c in docs.columns if c != out]
    schema = docs.drop(out).schema.add(out, StructType.fromDDL(FOUND))
    return docs.mapInArrow(run, schema)


def joined_ranges(first: np.ndarray, last: np.ndarray) -> list[int]:
    """Flat sorted list of the disjoint ranges that cover first[k]:last[k] for all k."""
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.append(True, first[1:] > reach[:-1])
    stops = reach[np.append(np.flatnonzero(new)[1:] - 1, len(first) - 1)]
    return np.stack([first[new], stops], 1).ravel().tolist()


def _blocks(items: DataFrame) -> Iterator[Windows]:
    ids: list[str] = []
    hashes: list[np.ndarray] = []
    total = 0
    for row in items.toLocalIterator():
        of = hashes_of([row["text"]], "plain")[0]
        if hashes and total + len(of) > BLOCK_WORDS:
            yield Windows(ids, hashes)
            ids, hashes, total = [], [], 0
        ids.append(row["item_id"])
        hashes.append(of)
        total += len(of)
    yield Windows(ids, hashes)


def overlap(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "overlap") -> DataFrame:
    """``docs`` with a struct ``out`` (n_words, n_hit, ranges, items): which words of a text stand in benchmark windows.

    ``ranges`` holds the hit words as flat pairs (first word, word after the last); ``items`` the ids, as strings, of
    items with a window in the text. ``benchmark`` has item_id and text and is read in blocks of BLOCK_WORDS words, one
    pass over the documents each (and one to count how rare shingles are), so what a task holds is bounded however large
    the benchmark is. Documents are never shuffled.

    A null text has no words, in documents and items alike; an item without words or without an id is left out, rows of
    a repeated id are windows of one item. An empty benchmark hits nothing; an empty table gives no rows. Repeated
    documents are treated one by one. Other columns pass through; one named ``out`` is replaced.
    """
    docs = docs.drop(out)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    found = docs
    for windows in _blocks(items.filter("item_id IS NOT NULL AND text IS NOT NULL")):
        counts = _rarity(docs, text, windows.shingles()) if windows.words else {}
        found = _scan(found, text, _Matcher(windows, windows.prefixes(counts)), windows.ids, out)
    return found


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """Whether a twentieth of the words, and one at least, is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 (ids sorted as strings, comma-joined) and contaminated."""
    found = overlap(docs.select("doc_id", "text"), benchmark)
    of = F.col("overlap")
    return found.select(
        "doc_id", of["n_words"].alias("n_words"), of["n_hit"].alias("n_hit"),
        F.size(of["items"]).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(of["items"]), ","), 256).alias("items_sha256"),
        contaminated(of["n_words"], of["n_hit"]).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones; columns and all other rows stay as they are."""
    (out,) = free_names(docs, 1)
    found = overlap(docs, benchmark, out=out)
    return found.filter(~contaminated(F.col(f"{out}.n_words"), F.col(f"{out}.n_hit"))).drop(out)
