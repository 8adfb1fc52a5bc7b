"""Byte-level BPE by prefix dynamic programming.

The encoding of every byte prefix of a piece ends in exactly one token, and that token alone decides how the
encoding goes on: token t may follow the encoding of a prefix that ends in token s exactly if the two tokens
side by side encode to themselves. So one number per byte, the last token of the prefix that ends there, stores
the encodings of all prefixes; bytes are appended without a look at what lies before the longest token, and an
edit is encoded again only from the edited place on.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.process import kept

#: Bytes of encoded pieces that a task remembers (as counted here, with what the dictionary takes), and the longest piece.
KEPT_BYTES, KEPT_LENGTH = 48 << 20, 64

#: Token pairs with their answers, and prefixes of up to KEPT_PREFIX bytes with their last tokens, that a task
#: remembers: about 90 and 110 bytes each.
KEPT_PAIRS, KEPT_PREFIXES, KEPT_PREFIX = 250_000, 150_000, 6

#: Lengths of the tokens that may end a text, falling, where none of three bytes or more can.
BELOW_THREE = (2, 1)

#: Bytes of texts whose ids a task holds before it gives them on.
SLICE_BYTES = 1 << 20

#: Texts are read in parts of about this many characters, cut where a piece begins for certain.
PART_CHARS = 1 << 20


class Ranks:
    """A rank file: base64 token and its rank in each line. Every byte is a token; ids are the ranks."""

    def __init__(self, data: bytes):
        pairs = (line.split() for line in data.splitlines() if line.strip())
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ids.items()}
        self._parts: dict[int, tuple[int, int] | None] = {}
        self.beside: dict[int, bool] = {}  # by left << 32 | right
        self.prefixes: dict[bytes, int] = {}
        #: Tokens that merges lead to; a rank file may hold others, which no encoding uses.
        self.merged = {t: r for t, r in self.ids.items() if len(t) == 1 or self.parts(r) is not None}
        self.longest = max(map(len, self.merged), default=1)
        #: Lengths, falling, of the tokens that can stand at the end of a text with the given last three bytes. Endings that
        #: no token of three bytes has are left out.
        self.tails: dict[bytes, tuple[int, ...]] = {}
        lengths: dict[bytes, set[int]] = {}
        for token in self.merged:
            if len(token) > 2:
                lengths.setdefault(token[-3:], set()).add(len(token))
        alike: dict[tuple[int, ...], tuple[int, ...]] = {}
        for tail, sizes in lengths.items():
            falling = (*sorted(sizes, reverse=True), *([2, 1] if tail[1:] in self.merged else [1]))
            self.tails[tail] = alike.setdefault(falling, falling)
        size = max(self.tokens) + 1
        self._length = np.zeros(size, np.int64)
        for rank, token in self.tokens.items():
            self._length[rank] = len(token)
        self._start = np.concatenate([[0], np.cumsum(self._length)])
        self._bytes = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(size)), np.uint8)

    def parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a byte, or where no merge leads to it."""
        if token not in self._parts:
            self._parts[token] = self._split(self.tokens[token], token)
        return self._parts[token]

    def _split(self, text: bytes, token: int) -> tuple[int, int] | None:
        """Merge the lowest ranks below ``token`` first; what is left must be two tokens."""
        pieces = [bytes([b]) for b in text]
        while len(pieces) > 2:
            merges = [(rank, k) for k in range(len(pieces) - 1)
                      if (rank := self.ids.get(pieces[k] + pieces[k + 1])) is not None and rank < token]
            if not merges:
                return None
            _, k = min(merges)
            pieces[k:k + 2] = [pieces[k] + pieces[k + 1]]
        return (self.ids[pieces[0]], self.ids[pieces[1]]) if len(pieces) == 2 else None

    def may_follow(self, left: int, right: int) -> bool:
        """Whether the bytes of the two tokens, side by side, encode to just these two."""
        pair = left << 32 | right
        known = self.beside.get(pair)
        if known is None:
            if len(self.beside) >= KEPT_PAIRS:
                self.beside.clear()
            known = self.beside[pair] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Undo merges of both sides, latest first; no merge over the border may come before the one undone.

        At equal ranks the left place is merged first.
        """
        bound = 1 << 62  # the merge undone last: a merge over the border only counts before it
        whole, tokens, parts = self.ids.get, self.tokens, self._parts.get  # known for all longer than a byte
        while True:
            across = whole(tokens[left] + tokens[right])
            if across is not None and across < bound:
                return False
            of_left, of_right = parts(left), parts(right)
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and left > right):
                bound, left = left, of_left[1]
            else:
                bound, right = right + 1, of_right[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of many ids at once."""
        if not len(ids):
            return b""
        length = self._length[ids]
        ends = np.cumsum(length)
        place = np.arange(ends[-1]) + np.repeat(self._start[ids] - (ends - length), length)
        return self._bytes[place].tobytes()


class Prefixes:
    """Last tokens of all byte prefixes of one piece; it grows by ``append`` and mends by ``edit``."""

    def __init__(self, ranks: Ranks, text: bytes = b""):
        self.ranks, self.text, self.last = ranks, b"", []
        self.append(text)

    def append(self, more: bytes) -> None:
        """Go on after what is there; nothing before is computed again."""
        ranks, last, text = self.ranks, self.last, self.text + more
        whole, known, may_follow, tails = ranks.merged.get, ranks.beside.get, ranks.may_follow, ranks.tails.get
        prefixes = ranks.prefixes
        for end in range(len(self.text) + 1, len(text) + 1):
            if end <= KEPT_PREFIX and (token := prefixes.get(text[:end])) is not None:
                last.append(token)
                continue
            for length in tails(text[end - 3:end], BELOW_THREE) if end > 2 else BELOW_THREE:
                start = end - length
                if start < 0:
                    continue
                token = whole(text[start:end])
                if token is None:
                    continue
                if start:
                    left = last[start - 1]
                    apart = known(left << 32 | token)
                    if not (may_follow(left, token) if apart is None else apart):
                        continue
                break
            else:
                raise ValueError("a byte of the text has no token")
            last.append(token)
            if end <= KEPT_PREFIX:
                if len(prefixes) >= KEPT_PREFIXES:
                    prefixes.clear()
                prefixes[text[:end]] = token
        self.text = text

    def edit(self, start: int, stop: int, new: bytes) -> None:
        """Put ``new`` for bytes start:stop.

        Prefixes before the edit stay. Behind it the last tokens are found anew until as many of them as the longest token
        has bytes agree with those from before: what follows depends on nothing else, so the rest stays as well.
        """
        rest, before = self.text[stop:], self.last[stop:]
        self.text, self.last = self.text[:start], self.last[:start]
        self.append(new)
        step = self.ranks.longest
        for done in range(step, len(rest) + 1, step):
            self.append(rest[done - step:done])
            if self.last[-step:] == before[done - step:done]:
                self.text, self.last = self.text + rest[done:], self.last + before[done:]
                return
        self.append(rest[len(rest) - len(rest) % step:])

    def encoding(self) -> list[int]:
        """Ids of the whole, read backwards from the last token."""
        found, end, last, tokens = [], len(self.text), self.last, self.ranks.tokens
        while end:
            token = last[end - 1]
            found.append(token)
            end -= len(tokens[token])
        return found[::-1]


class Encoder:
    """Texts to ids: every match of ``pattern`` is a piece that is encoded by itself."""

    def __init__(self, ranks: Ranks, pattern: str):
        import regex

        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.bytes = 0

    def piece(self, piece: str) -> bytes:
        """Ids of a piece that is not among the newer half of the remembered ones."""
        found = self.older.get(piece)
        if found is None:
            text = piece.encode()
            token = self.ranks.merged.get(text)
            ids = Prefixes(self.ranks, text).encoding() if token is None else [token]
            found = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= KEPT_LENGTH:
            size = len(piece) + len(found) + 180  # two small objects and the entry
            if self.bytes + size > KEPT_BYTES // 2:
                self.older, self.kept, self.bytes = self.kept, {}, 0
            self.kept[piece] = found
            self.bytes += size
        return found

    def parts(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian 32-bit numbers, for one part of the text after the other."""
        piece = self.piece
        for part in text_parts(text):
            yield b"".join([self.kept.get(p) or piece(p) for p in self.find(part)])


def text_parts(text: str, most: int = PART_CHARS) -> Iterator[str]:
    """Cut a long text between a letter and a following line end or blank with a letter behind it.

    There the pattern ends a piece and begins another one, wherever it began. A text without such a place
    stays whole.
    """
    first = 0
    while len(text) - first > most:
        cut = next((k for k in range(first + most, len(text) - 1)
                    if text[k] == " " and text[k - 1].isalpha() and text[k + 1].isalpha()), None)
        if cut is None:
            break
        yield text[first:cut]
        first = cut
    yield text[first:]


def _encoder(file: str, pattern: str) -> Encoder:
    def make() -> Encoder:
        with open(SparkFiles.get(file), "rb") as ranks:
            return Encoder(Ranks(ranks.read()), pattern)

    return kept(("bpe", file, pattern), make)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows with about SLICE_BYTES of text (column 1), one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield batch.slice(first, last - first)
            first = last


def encode(docs: DataFrame, ranks_file: str, pattern: str, ids: bool = False) -> DataFrame:
    """Encode ``text`` of every row and decode it again.

    Returns doc_id, n_tokens, ids_sha256 (hex digest of the ids as little-endian unsigned 32-bit numbers),
    decoded_sha256 (hex digest of the bytes decoded from the ids) and, if asked for, ``ids`` themselves as an
    array of integers. The rank file (a driver's path) goes to every executor once, by SparkContext.addFile.

    A null text counts as empty: no tokens and the digests of nothing. Rows are treated one by one, so a null or
    repeated doc_id and equal rows stay as they are; other columns are not read. Long texts are read in parts.
    Memory per task: the ranks, what it remembers (about 90 MB), one batch, and the ids of a slice of it.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(ranks_file)
    file = ranks_file.rpartition("/")[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(file, pattern)
        ranks = encoder.ranks
        for batch in sliced(batches):
            counts, id_digests, text_digests, arrays = [], [], [], []
            for text in batch.column(1):
                n, of_ids, of_text, numbered = 0, hashlib.sha256(), hashlib.sha256(), []
                for part in encoder.parts(text.as_py() or ""):
                    numbers = np.frombuffer(part, "<u4")
                    n += len(numbers)
                    of_ids.update(part)
                    of_text.update(ranks.decode(numbers))
                    if ids:
                        numbered.append(numbers.astype(np.int32))
                counts.append(n)
                id_digests.append(of_ids.hexdigest())
                text_digests.append(of_text.hexdigest())
                if ids:
                    arrays.append(np.concatenate(numbered) if numbered else np.empty(0, np.int32))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()),
                       pa.array(text_digests, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if ids:
                columns.append(pa.array(arrays, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
