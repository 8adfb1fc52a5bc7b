"""Words of many texts at once, as 64-bit hashes, with numpy over Arrow's own text buffers.

A word is a run of bytes of an alphabet, after A-Z were lower-cased. Both alphabets hold every byte of
a non-ASCII character, so working on UTF-8 bytes and on characters gives the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from linkwright.llm.process import kept

#: Texts are worked on in slices of about this many bytes; one longer text is a slice of its own.
SLICE_BYTES = 1 << 19

_SPACES = [0x20, *range(0x09, 0x0E)]
_MARKS = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
#: Bytes that part words, by alphabet: `spaced` [^\x20\x09-\x0D]+, `plain` [^\x00-\x2F\x3A-\x60\x7B-\x7F]+.
ALPHABETS = {"spaced": _SPACES, "plain": _MARKS}

_RADIX = 0x9E3779B97F4A7C15
_RADIX_INVERSE = pow(_RADIX, -1, 1 << 64)
_WHOLE = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((seed * 0xD1B54A32D192ED03 + 0x632BE59BD9B4E019) % (1 << 64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64), 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWERED = _BYTE[_LOWER]


def _power(radix: int, n: int) -> np.ndarray:
    """radix ** 0, 1, 2, ... modulo 2 ** 64."""
    def make(size: int) -> np.ndarray:
        steps = np.full(size, radix, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    if n > SLICE_BYTES:
        return make(n)
    return kept(("powers", radix), lambda: make(SLICE_BYTES))[:n]


@dataclass
class Words:
    """Words of texts ``first`` .. ``first + rows - 1`` of a column; ``at[i]:at[i + 1]`` are those of row i."""

    first: int
    hashes: np.ndarray
    at: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.at)

    def rows(self) -> np.ndarray:
        """Row of every word."""
        return np.repeat(np.arange(len(self.at) - 1), self.counts)

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``size`` words that lies in one text."""
        if len(self.hashes) < size:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        left = np.repeat(self.at[1:], self.counts) - np.arange(len(self.hashes))
        first = np.flatnonzero(left >= size)
        return first, run_hash(self.hashes, first, size)


def run_hash(hashes: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each of ``first`` on."""
    total = np.full(len(first), size, np.uint64)
    for k in range(size):
        total = total * np.uint64(_RADIX) + hashes[first + k]
    return mix(total, 2)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; a null is empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8), at


def slices(at: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts have ``most`` bytes together, or are one longer text."""
    first, rows = 0, len(at) - 1
    while first < rows:
        last = int(np.searchsorted(at, at[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def words(column: pa.Array, alphabet: str) -> Iterator[Words]:
    """The words of a text column, slice by slice."""
    inside = np.ones(256, bool)
    inside[ALPHABETS[alphabet]] = False
    inside = inside[_LOWER]
    data, at = buffers(column)
    for first, last in slices(at):
        low, high = int(at[first]), int(at[last])
        text, edges = data[low:high], at[first:last + 1] - low
        if low == high:
            yield Words(first, np.empty(0, np.uint64), np.zeros(last - first + 1, np.int64))
            continue
        word = inside[text]
        cut = np.zeros(len(text) + 1, bool)  # a text begins here, or the column ends
        cut[edges] = True
        begins = word.copy()
        begins[1:] &= ~word[:-1] | cut[1:-1]
        ends = word.copy()
        ends[:-1] &= ~word[1:] | cut[1:-1]
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        total = np.empty(len(text) + 1, np.uint64)
        total[0] = 0
        np.cumsum(_LOWERED[text] * _power(_RADIX, len(text)), out=total[1:])
        hashes = mix((total[end] - total[begin]) * _power(_RADIX_INVERSE, len(text))[begin], 3)
        yield Words(first, hashes, np.searchsorted(begin, edges))


def hashes_of(texts: list[str | None], alphabet: str) -> list[np.ndarray]:
    """Word hashes of a few texts, one array each."""
    found: list[np.ndarray] = []
    for part in words(pa.array(texts, pa.large_string()), alphabet):
        found += np.split(part.hashes, part.at[1:-1])
    return found
