"""Alignment of two tokenizers over the same bytes, by an associative monoid of fragments.

Byte offsets where tokens of both tokenizers end cut a text into groups. A byte range of a text yields a fragment: tokens
before the first common boundary (open prefix), groups between common boundaries (closed), tokens behind the last one (open
suffix). Joining two neighbours closes what lies between them, whichever neighbours are joined first; so the fragments of
a very long text are folded in a tree over tasks, and closed groups leave the tree as rows of their own.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkwright.llm.process import kept
from linkwright.llm.segments import batches, byte_tokens, cut, encode_segments, joinable, require_byte_level
from linkwright.session import written

#: Bytes of a range of a long text; shorter texts are one range.
RANGE_BYTES = 1 << 15

#: Ranges that are encoded together, each distinct segment once.
RANGES_TOGETHER = 32

#: Neighbouring fragments that one step of the tree joins.
FAN = 16

#: Characters of texts that are worked on together: one block.
BLOCK_CHARS = 1 << 20


class Pair:
    """Tokenizers A (byte-level, in a JSON file) and B (pieces, a sentencepiece model), with the bytes of every id."""

    def __init__(self, a: str, b: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        require_byte_level(json.loads(a))
        self.a = Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=b)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        inner = [n for i, n in enumerate(names) if "▁" in n.lstrip("▁") and not self.b.is_byte(i)]
        if inner:
            raise ValueError("needs a piece vocabulary that merges nothing over the start of a word")
        self.of_a = byte_tokens(self.a)
        self.of_b = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        #: Ids as they are spelled: A inside and at the end of its side of a group, B inside and at the end.
        self.written = [f"{i}{mark}" for of, marks in ((self.of_a, ",|"), (self.of_b, ",;")) for mark in marks for i in range(len(of))]
        self.size_a = np.array([len(t) for t in self.of_a], np.int64)
        self.size_b = np.array([len(t) for t in self.of_b], np.int64)

    def encode(self, segments: list[str]) -> Streams:
        """Tokens of distinct segments, each of which begins with the blank that B adds by itself."""
        a, at_a, order = encode_segments(self.a, self.size_a, segments)
        found = self.b.encode([segments[i][1:] for i in order], num_threads=1)
        at_b = np.cumsum([0, *map(len, found)])
        b = np.fromiter(chain.from_iterable(found), np.int64, at_b[-1])
        data = [segments[i].encode() for i in order]
        good = np.ones(len(order), bool)
        for ids, at, tokens in ((a, at_a, self.of_a), (b, at_b, self.of_b)):
            listed = ids.tolist()
            if b"".join(map(tokens.__getitem__, listed)) != b"".join(data):
                joined = (b"".join(map(tokens.__getitem__, listed[at[k]:at[k + 1]])) for k in range(len(data)))
                good &= np.fromiter((j == d for j, d in zip(joined, data)), bool, len(data))
        return Streams(order, a, at_a, b, at_b, good)

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends of the groups in bytes, and the group of every A and B token, of two streams over the same bytes."""
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
        return ends, np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b)


@dataclass
class Streams:
    """Ids of segments one behind the other; segment ``order[k]`` has those at[k]:at[k + 1]; ``good``: bytes are the text's."""

    order: list[int]
    a: np.ndarray
    at_a: np.ndarray
    b: np.ndarray
    at_b: np.ndarray
    good: np.ndarray

    def places(self) -> np.ndarray:
        """k of every segment."""
        found = np.empty(len(self.order), np.int64)
        found[self.order] = np.arange(len(self.order))
        return found


def linked(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Every A-B pair of tokens of one group, as A id << 32 | B id, and its group; in order of the A tokens."""
    in_b = np.bincount(of_b, minlength=n)
    first_b = np.cumsum(in_b) - in_b
    reps = in_b[of_a]
    inside = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
    return np.repeat(a, reps) << 32 | b[np.repeat(first_b[of_a], reps) + inside], np.repeat(of_a, reps)


def spelled(pair: Pair, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, n: int) -> tuple[list[str], np.ndarray]:
    """``a1,`` ``a2|`` ``b1;`` ... of all tokens, group by group, and the number of strings up to the end of every group."""
    in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
    written_a = np.where(np.diff(of_a, append=n) > 0, a + len(pair.of_a), a)
    written_b = np.where(np.diff(of_b, append=n) > 0, b + len(pair.of_b), b) + 2 * len(pair.of_a)
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[of_a]] = written_a
    order[np.arange(len(b)) + np.cumsum(in_a)[of_b]] = written_b
    return [pair.written[k] for k in order.tolist()], np.cumsum(in_a + in_b)


# ---- the monoid ----

@dataclass(frozen=True)
class Tokens:
    """Tokens of both tokenizers that stand next to each other; ``a_at``, ``b_at``: byte where the first of each begins."""

    a_at: int
    a: np.ndarray
    b_at: int
    b: np.ndarray

    def then(self, other: Tokens) -> Tokens:
        return Tokens(self.a_at if len(self.a) else other.a_at, np.concatenate([self.a, other.a]),
                      self.b_at if len(self.b) else other.b_at, np.concatenate([self.b, other.b]))

    def starts(self, pair: Pair) -> tuple[np.ndarray, np.ndarray]:
        size_a, size_b = pair.size_a[self.a], pair.size_b[self.b]
        return self.a_at + np.cumsum(size_a) - size_a, self.b_at + np.cumsum(size_b) - size_b

    def split(self, pair: Pair, place: int) -> tuple[Tokens, Tokens]:
        """Tokens that begin before ``place`` and the others."""
        starts_a, starts_b = self.starts(pair)
        i, j = int(np.searchsorted(starts_a, place)), int(np.searchsorted(starts_b, place))
        return Tokens(self.a_at, self.a[:i], self.b_at, self.b[:j]), Tokens(place, self.a[i:], place, self.b[j:])


NOTHING = Tokens(0, np.empty(0, np.int64), 0, np.empty(0, np.int64))


@dataclass(frozen=True)
class Fragment:
    """Open prefix; first and last common boundary, None without one; open suffix; closed runs that have not left yet.

    Without a common boundary all tokens are in the prefix.
    """

    prefix: Tokens
    low: int | None = None
    high: int | None = None
    suffix: Tokens = NOTHING
    runs: tuple[tuple[int, Tokens], ...] = field(default=(), compare=False)


def settle(tokens: Tokens, pair: Pair, end: int | None = None) -> Fragment:
    """A fragment of neighbouring tokens; ``end`` is a common boundary behind them, if it is known to be one."""
    starts_a, starts_b = tokens.starts(pair)
    common = np.intersect1d(starts_a, starts_b, assume_unique=True).tolist()
    if end is not None and (not common or common[-1] != end):
        common.append(end)
    if not common:
        return Fragment(tokens)
    prefix, rest = tokens.split(pair, common[0])
    closed, suffix = rest.split(pair, common[-1])
    return Fragment(prefix, common[0], common[-1], suffix, ((common[0], closed),) if common[0] < common[-1] else ())


def joined(left: Fragment, right: Fragment, pair: Pair) -> Fragment:
    """Two neighbours as one: what is open between them is settled.

    The open suffix of a left one with a boundary begins at that boundary with tokens of both kinds, so settling closes
    from there on.
    """
    between = settle((left.prefix if left.low is None else left.suffix).then(right.prefix), pair, right.low)
    low, prefix = (between.low, between.prefix) if left.low is None else (left.low, left.prefix)
    high, suffix = (between.high, between.suffix) if right.low is None else (right.high, right.suffix)
    return Fragment(prefix, low, high, suffix, left.runs + between.runs + right.runs)


FRAGMENT = ("row_no bigint, no bigint, run boolean, bad boolean, low bigint, high bigint, pre_a_at bigint, pre_a array<int>, "
            "pre_b_at bigint, pre_b array<int>, suf_a_at bigint, suf_a array<int>, suf_b_at bigint, suf_b array<int>")
_FRAGMENT = pa.schema([
    ("row_no", pa.int64()), ("no", pa.int64()), ("run", pa.bool_()), ("bad", pa.bool_()), ("low", pa.int64()), ("high", pa.int64()),
    *[(f"{p}_{t}{s}", k) for p in ("pre", "suf") for t in "ab" for s, k in (("_at", pa.int64()), ("", pa.list_(pa.int32())))]])


def _rows(row_no: int, no: int, fragment: Fragment, bad: bool = False) -> Iterator[dict]:
    """The fragment as one row, and each of its closed runs as one."""

    def tokens(name: str, t: Tokens) -> dict:
        return {f"{name}_a_at": t.a_at, f"{name}_a": t.a.astype(np.int32), f"{name}_b_at": t.b_at, f"{name}_b": t.b.astype(np.int32)}

    head = {"row_no": row_no, "no": no, "bad": bad}
    yield head | {"run": False, "low": fragment.low, "high": fragment.high} | tokens("pre", fragment.prefix) | tokens("suf", fragment.suffix)
    for place, closed in fragment.runs:
        yield head | {"run": True, "low": place, "high": None} | tokens("pre", closed) | tokens("suf", NOTHING)


def _fragment(row: dict) -> Fragment:
    def tokens(name: str) -> Tokens:
        return Tokens(row[f"{name}_a_at"], np.asarray(row[f"{name}_a"], np.int64), row[f"{name}_b_at"], np.asarray(row[f"{name}_b"], np.int64))

    return Fragment(tokens("pre"), row["low"], row["high"], tokens("suf"))


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in _FRAGMENT], schema=_FRAGMENT)


# ---- ranges of long texts ----

def _is_cut(data: bytes, place: int) -> bool:
    if not 0 < place < len(data) - 1 or data[place] != 0x20:
        return False
    first = place - 1
    while data[first] & 0xC0 == 0x80:
        first -= 1
    return joinable(" " + data[first:place].decode())


def _cut_before(data: bytes, place: int) -> int:
    """The last cut at or before ``place``; 0 without one."""
    while (place := data.rfind(b" ", 0, place + 1)) > 0 and not _is_cut(data, place):
        place -= 1
    return max(place, 0)


def _cut_behind(data: bytes, place: int) -> int:
    """The first cut at or behind ``place``; the end without one."""
    while (place := data.find(b" ", place)) >= 0 and not _is_cut(data, place):
        place += 1
    return place if place >= 0 else len(data)


def ranges(data: bytes, size: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(begin, end, place of the bytes, bytes): ranges of about ``size`` bytes, each with bytes from cut to cut around it.

    A range that ends inside a long run without a cut is widened to half a size before the run's end, so that the run is
    encoded twice at most.
    """
    begin = 0
    while begin < len(data):
        end = min(begin + size, len(data))
        behind = _cut_behind(data, end)
        if behind - end > size:
            end = behind - size // 2
        before = _cut_before(data, begin)
        yield begin, end, before, data[before:behind]
        begin = end


def _of_ranges(pair: Pair, rows: list[dict]) -> Iterator[tuple[Fragment, bool]]:
    """The fragment of the tokens that begin in each range, and whether their bytes are not the text's."""
    parts = [cut(r["bytes"].decode()) for r in rows]
    distinct = {s: i for i, s in enumerate(dict.fromkeys(chain.from_iterable(parts)))}
    streams = pair.encode(list(distinct))
    place = streams.places()
    for r, part in zip(rows, parts):
        picked = place[[distinct[s] for s in part]]
        if not streams.good[picked].all():
            yield Fragment(NOTHING), True
            continue
        a, b = (ids[_expanded(np.diff(at)[picked], at[picked])] for ids, at in ((streams.a, streams.at_a), (streams.b, streams.at_b)))
        tokens = Tokens(r["place"], a, r["place"], b)
        starts_a, starts_b = (np.append(s, r["end"]) for s in tokens.starts(pair))
        i, j = int(np.searchsorted(starts_a, r["begin"])), int(np.searchsorted(starts_b, r["begin"]))
        inside, _ = Tokens(int(starts_a[i]), a[i:], int(starts_b[j]), b[j:]).split(pair, r["end"])
        yield settle(inside, pair, r["whole"] if r["end"] == r["whole"] else None), False


def _expanded(sizes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... sizes[0] of them, then those from first[1] on, and so on."""
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


# ---- Spark ----

def _pair(files: tuple[str, str]) -> Pair:
    def make() -> Pair:
        with open(SparkFiles.get(files[0]), encoding="utf-8") as a, open(SparkFiles.get(files[1]), "rb") as b:
            return Pair(a.read(), b.read())

    return kept(("alignment", *files), make)


def _block(pair: Pair, texts: list[str]) -> dict[str, list | bytes]:
    """Figures of every text, and the distinct links of each as places in the block's list of pairs."""
    parts = [cut(" " + t) if t else [] for t in texts]
    distinct = {s: i for i, s in enumerate(dict.fromkeys(chain.from_iterable(parts)))}
    streams = pair.encode(list(distinct))
    n, place = len(distinct), streams.places()
    fine = np.repeat(streams.good, np.diff(streams.at_a)), np.repeat(streams.good, np.diff(streams.at_b))
    a, b = streams.a[fine[0]], streams.b[fine[1]]
    n_a = np.where(streams.good, np.diff(streams.at_a), 0)
    n_b = np.where(streams.good, np.diff(streams.at_b), 0)
    ends, of_a, of_b = pair.groups(a, b)
    pairs, group = linked(a, b, of_a, of_b, len(ends))
    strings, string_ends = spelled(pair, a, b, of_a, of_b, len(ends))
    # every segment ends in a common boundary, so its groups and links lie side by side
    last_a = np.cumsum(n_a)
    until = np.where(last_a > 0, of_a[np.maximum(last_a - 1, 0)] + 1, 0) if len(a) else np.zeros(n, np.int64)
    n_groups = np.diff(until, prepend=0)
    last_link = np.searchsorted(group, until)
    n_links = np.diff(last_link, prepend=0)
    edges = np.concatenate([[0], np.concatenate([[0], string_ends])[until]]).tolist()
    spelling = ["".join(strings[x:y]) for x, y in zip(edges[:-1], edges[1:])]
    listed, of_link = np.unique(pairs, return_inverse=True)

    sequence = [place[[distinct[s] for s in p]] if p else np.empty(0, np.int64) for p in parts]
    sequence = [s if streams.good[s].all() else s[:0] for s in sequence]
    digests = [hashlib.sha256("".join([spelling[k] for k in s.tolist()])[:-1].encode()).hexdigest() if len(s) else "" for s in sequence]
    whole = np.concatenate([*sequence, np.empty(0, np.int64)])
    doc = np.repeat(np.arange(len(texts)), [len(s) for s in sequence])

    def per_doc(figure: np.ndarray) -> list[int]:
        return np.bincount(doc, weights=figure[whole], minlength=len(texts)).astype(np.int64).tolist()

    sizes = n_links[whole]
    held = of_link[_expanded(sizes, (last_link - n_links)[whole])] if len(listed) else np.empty(0, np.int64)
    keys, times = np.unique(np.repeat(doc, sizes) * max(len(listed), 1) + held, return_counts=True)
    of_doc, which = np.divmod(keys, max(len(listed), 1))
    return {
        "n_a": per_doc(n_a), "n_b": per_doc(n_b), "n_groups": per_doc(n_groups), "n_links": per_doc(n_links), "sha": digests,
        "pairs": listed, "docs": np.bincount(which, minlength=len(listed)),
        "at": np.searchsorted(of_doc, np.arange(len(texts) + 1)).astype("<i4").tobytes(),
        "which": which.astype("<i4").tobytes(), "times": times.astype("<i4").tobytes(),
    }


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(texts: DataFrame, files: tuple[str, str]) -> DataFrame:
    """Texts as blocks: one row with the figures of many texts and what is needed to sum the counts of their pairs."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = (f"block bigint, doc_id array<{kind}>, {', '.join(f'{c} array<bigint>' for c in _FIGURES)}, sha array<string>, "
              "pairs array<bigint>, docs array<bigint>, at binary, which binary, times binary")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(files)
        block = TaskContext.get().partitionId() << 32
        for batch in rows:
            done = 0
            for part in batches((t.as_py() for t in batch.column(1)), BLOCK_CHARS):
                found = _block(pair, part)
                ids = batch.column(0).slice(done, len(part))
                done += len(part)
                columns = [pa.array([block], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
                columns += [pa.array([found[c]], pa.list_(pa.int64())) for c in _FIGURES]
                columns += [pa.array([found["sha"]], pa.list_(pa.string()))]
                columns += [pa.array([found[c]], pa.list_(pa.int64())) for c in ("pairs", "docs")]
                columns += [pa.array([found[c]], pa.binary()) for c in ("at", "which", "times")]
                block += 1
                yield pa.RecordBatch.from_arrays(
                    columns, ["block", "doc_id", *_FIGURES, "sha", "pairs", "docs", "at", "which", "times"])

    return texts.select("doc_id", "text").mapInArrow(run, schema)


def _leaves(texts: DataFrame, files: tuple[str, str], size: int) -> DataFrame:
    """Fragments of the ranges of long texts, in any task."""

    def cuts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row_no, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = b" " + text.as_py().encode()
                for no, (begin, end, place, piece) in enumerate(ranges(data, size)):
                    yield pa.RecordBatch.from_pylist([{"row_no": row_no, "no": no, "begin": begin, "end": end, "place": place,
                                                       "whole": len(data), "bytes": piece}])

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(files)
        for batch in rows:
            for first in range(0, batch.num_rows, RANGES_TOGETHER):
                part = batch.slice(first, RANGES_TOGETHER).to_pylist()
                for r, (fragment, bad) in zip(part, _of_ranges(pair, part)):
                    yield _batch(list(_rows(r["row_no"], r["no"], fragment, bad)))

    spread = texts.select("row_no", "text").mapInArrow(
        cuts, "row_no bigint, no bigint, begin bigint, end bigint, place bigint, whole bigint, bytes binary")
    return spread.repartition("row_no", "no").mapInArrow(encode, FRAGMENT)


def _folded(fragments: DataFrame, files: tuple[str, str]) -> DataFrame:
    """One step of the tree: up to FAN neighbours become one fragment, with the runs that this closes."""

    def fold(table: pa.Table) -> pa.Table:
        pair = _pair(files)
        rows = sorted(table.drop(["part"]).to_pylist(), key=lambda r: r["no"])
        whole = _fragment(rows[0])
        for row in rows[1:]:
            whole = joined(whole, _fragment(row), pair)
        return pa.Table.from_batches([_batch(list(_rows(rows[0]["row_no"], rows[0]["no"] // FAN, whole)))])

    part = F.floor(F.col("no") / FAN)
    return fragments.withColumn("part", part).groupBy("row_no", "part").applyInArrow(fold, FRAGMENT)


def _closed(texts: DataFrame, files: tuple[str, str], size: int) -> DataFrame:
    """All closed runs (row_no, low, a, b) of long texts whose bytes both tokenizers keep."""
    leaves = written(_leaves(texts, files, size), "fragments")
    bad = leaves.filter("bad").select("row_no").distinct()
    leaves = leaves.join(bad, "row_no", "left_anti")
    runs, open_ = leaves.filter("run"), leaves.filter("NOT run")
    while (open_.agg(F.max("no")).first()[0] or 0) > 0:
        step = written(_folded(open_, files), "fragments")
        runs, open_ = runs.union(step.filter("run")), step.filter("NOT run")
    return runs.select("row_no", "low", F.col("pre_a").alias("a"), F.col("pre_b").alias("b"))


def _run_figures(runs: DataFrame, files: tuple[str, str]) -> tuple[DataFrame, DataFrame]:
    """Of closed runs: (row_no, figures, sha), and the links (row_no, pair, times)."""

    def links(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(files)
        for batch in rows:
            for row_no, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                a, b = (np.asarray(v.values, np.int64) for v in (a, b))
                ends, of_a, of_b = pair.groups(a, b)
                found, times = np.unique(linked(a, b, of_a, of_b, len(ends))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), row_no)), pa.array(found, pa.int64()), pa.array(times, pa.int64())],
                    ["row_no", "pair", "times"])

    def digests(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(files)
        current, figures, digest = None, Counter(), None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"row_no": current, "n_a": figures["a"], "n_b": figures["b"], "n_groups": figures["groups"], "sha": digest.hexdigest()}])

        for batch in rows:
            for row_no, a, b in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                if row_no != current:
                    if current is not None:
                        yield done()
                    current, figures, digest = row_no, Counter(), hashlib.sha256()
                a, b = (np.asarray(v.values, np.int64) for v in (a, b))
                ends, of_a, of_b = pair.groups(a, b)
                strings, _ = spelled(pair, a, b, of_a, of_b, len(ends))
                digest.update((";" * (figures["groups"] > 0) + "".join(strings)[:-1]).encode())
                figures.update(a=len(a), b=len(b), groups=len(ends))
        if current is not None:
            yield done()

    # a digest goes through a text in order, run after run, with nothing kept but its state
    in_order = runs.repartition("row_no").sortWithinPartitions("row_no", "low").select("row_no", "a", "b")
    return (in_order.mapInArrow(digests, "row_no bigint, n_a bigint, n_b bigint, n_groups bigint, sha string"),
            runs.select("row_no", "a", "b").mapInArrow(links, "row_no bigint, pair bigint, times bigint"))


def _summed(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """A row per text of each block, with the sums over its links."""
    kind = blocks.schema["doc_id"].dataType.elementType.simpleString()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for r in range(batch.num_rows):
                of = {c: batch.column(c)[r] for c in batch.schema.names}
                at, which, times = (np.frombuffer(of[c].as_py(), "<i4").astype(np.int64) for c in ("at", "which", "times"))
                n, best = np.zeros(len(of["pairs"]) + 1, np.int64), np.zeros(len(of["pairs"]) + 1, bool)
                if of["answers"].is_valid:
                    place, count, top = of["answers"].values.flatten()
                    n[place.to_numpy()], best[place.to_numpy()] = count.to_numpy(), top.to_numpy(zero_copy_only=False)
                sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times * best[which], times * n[which])]
                columns = [of["doc_id"].values, *[of[c].values for c in _FIGURES],
                           *[pa.array(s[at[1:]] - s[at[:-1]], pa.int64()) for s in sums], of["sha"].values]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *_FIGURES, "n_best", "count_sum", "groups_sha256"])

    schema = f"doc_id {kind}, {', '.join(f'{c} bigint' for c in (*_FIGURES, 'n_best', 'count_sum'))}, groups_sha256 string"
    return blocks.drop("docs").join(answers, "block", "left").mapInArrow(run, schema)


def align(docs: DataFrame, byte_file: str, piece_file: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Groups and links of every text between the tokens of two tokenizers.

    A: space + text by the byte-level tokenizer in ``byte_file``; B: the text by the piece model in ``piece_file``, which adds
    the space; special strings are plain text. Both paths are the driver's and go to every executor once.
    Returns doc_id; n_a, n_b (tokens); n_groups; n_links (A-B pairs of tokens in one group); n_best (links whose
    pair of ids is held by as many documents as any pair of its A id); count_sum (documents that hold a link's
    pair, summed over the links); groups_sha256 (digest of ``a1,a2|b1;a3|b2,b3``).

    Texts that are null, empty, or whose bytes one of the tokenizers changes have no tokens: zeros, and '' as digest. Rows
    are documents of their own: a null or repeated doc_id and equal rows stay as they are and count. Other columns are not
    read; an empty table gives no row.

    Memory: a task holds a batch of texts, or a range of a long text with the run without a cut around it. The counts of
    pairs are never sent whole to a task: a block of texts asks for each of its pairs once, by a join.
    """
    spark = docs.sparkSession
    for file in (byte_file, piece_file):
        spark.sparkContext.addFile(file)
    files = (byte_file.rpartition("/")[2], piece_file.rpartition("/")[2])
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    long = F.octet_length("text") > range_bytes
    blocks = written(_blocks(texts.filter(~long), files), "blocks")
    named = written(texts.filter(long).withColumn("row_no", F.monotonically_increasing_id()), "long_texts")
    figures, links = _run_figures(written(_closed(named, files, range_bytes), "runs"), files)
    links = written(links.groupBy("row_no", "pair").agg(F.sum("times").alias("times")), "links")

    held = blocks.select(F.explode(F.arrays_zip("pairs", "docs")).alias("p")).select(
        F.col("p.pairs").alias("pair"), F.col("p.docs").alias("n")).filter("n > 0")
    held = held.union(links.select("pair", F.lit(1).cast("bigint")))
    counts = held.groupBy("pair").agg(F.sum("n").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))  # an A id has no more pairs than B has ids
    counts = written(counts.withColumn("best", F.col("n") == F.max("n").over(of_a)), "counts")

    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(counts, "pair").groupBy("block").agg(F.collect_list(F.struct("place", "n", "best")).alias("answers"))
    short = _summed(blocks, answers)

    sums = links.join(counts, "pair").groupBy("row_no").agg(
        F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    whole = named.select("row_no", "doc_id").join(figures, "row_no", "left").join(sums, "row_no", "left")
    names = (*_FIGURES, "n_best", "count_sum")
    return short.unionByName(whole.select(
        "doc_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in names], F.coalesce("sha", F.lit("")).alias("groups_sha256")))
