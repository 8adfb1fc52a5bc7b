"""Texts cut into segments that tokenizers encode independently, so that every distinct one is encoded once.

A cut lies before a blank that follows a character which is no white space and that is not the last character.
The pattern of byte-level BPE ends a piece there and begins another, whatever stands around, and a piece vocabulary
without an inner word mark merges nothing over it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate

import numpy as np

#: What may not stand before a cut: white space by any Unicode version, and the mark that piece vocabularies write for a blank.
_NO_END = "᠎▁"

cut = re.compile(rf"(?<=[^\s{_NO_END}])(?= [\s\S])").split

#: Characters that are given to a tokenizer at once.
LUMP_CHARS = 1 << 14

#: Lumps whose tokens the library holds at once.
TOGETHER = 8


def joinable(segment: str) -> bool:
    """Whether the segment may stand between others with a cut on both sides."""
    return len(segment) > 1 and segment[0] == " " and not segment[-1].isspace() and segment[-1] not in _NO_END


def lumps(segments: Sequence[str], most: int = LUMP_CHARS) -> tuple[list[str], list[int]]:
    """Texts of about ``most`` characters, made of joinable segments one behind the other or of one other segment.

    Also returns the order of the segments in them.
    """
    inside, alone = [], []
    for i, s in enumerate(segments):
        (inside if joinable(s) else alone).append(i)
    texts, first, size = [], 0, 0
    for k, i in enumerate(inside):
        size += len(segments[i])
        if size >= most:
            texts.append("".join([segments[j] for j in inside[first:k + 1]]))
            first, size = k + 1, 0
    if first < len(inside):
        texts.append("".join([segments[j] for j in inside[first:]]))
    return texts + [segments[i] for i in alone], inside + alone


def byte_tokens(tokenizer) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary, in which a byte is written as a printable character.

    The printable bytes of Latin-1 stand for themselves, the others are numbered from 256 on. Ids without a token are empty.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in byte_of.values())}
    added = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    vocabulary = tokenizer.get_vocab(with_added_tokens=True)
    found = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        found[i] = token.encode() if token in added else bytes([byte_of[c] for c in token])
    return found


def require_byte_level(description: dict) -> None:
    """The cuts and look-aheads hold for the byte-level splitting pattern over unchanged text, and for no other."""
    before = description.get("pre_tokenizer") or {}
    if (description.get("normalizer") is not None or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space") or not before.get("use_regex", True)):
        raise ValueError("needs a byte-level tokenizer without a normalizer")


def encode_segments(tokenizer, sizes: np.ndarray, segments: Sequence[str]) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Ids of distinct segments by a byte-level tokenizer; ``sizes`` are the bytes of every id.

    Returns all ids, the place of each segment's first id (one more at the end), and the order of the segments.
    """
    texts, order = lumps(segments)
    found = [np.empty(0, np.int64)]
    for first in range(0, len(texts), TOGETHER):  # the library's own results are many times larger than the ids
        found += [np.asarray(e.ids, np.int64) for e in tokenizer.encode_batch_fast(texts[first:first + TOGETHER], add_special_tokens=False)]
    ids = np.concatenate(found)
    ends = np.cumsum(sizes[ids])
    edges = np.array(list(accumulate((len(segments[i].encode()) for i in order), initial=0)), np.int64)
    at = np.searchsorted(ends, edges, "right")
    if not np.array_equal(np.concatenate([[0], ends])[at], edges):
        raise AssertionError("a token crosses a cut")
    return ids, at, order


def batches(texts: Iterable[str], most: int) -> Iterator[list[str]]:
    """Runs of texts with about ``most`` characters together, one text at least."""
    run: list[str] = []
    size = 0
    for text in texts:
        if run and size + len(text) > most:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run
