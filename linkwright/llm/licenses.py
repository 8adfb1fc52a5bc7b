"""License scans by template markup, compiled into token automata.

A template is wording with marked regions: ``<<beginOptional>> ... <<endOptional>>`` may be missing, and
``<<var;name="holder";words="0-12">>`` stands for that many words of any kind. All other words are mandatory and must
match exactly, as lower-cased words, whatever stands between them. A template compiles into a chain of states, one bit
each: a word moves the bits that accept it, and skips over optional regions are taken at once. Automata start only where
a template's first words stand.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.llm.decontam import Places
from linkwright.llm.words import hashes_of, run_hash, words

# Phrases that licenses are named by, and wording of well-known licenses and notices.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

TEMPLATES = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;name="software";words="1-8">> and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
        sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial
        portions of the Software.""",
    "isc-text": """Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any
        purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice
        appear in all copies.""",
    "bsd-text": """Redistribution and use in source and binary forms, with or without modification, are permitted provided
        that the following conditions are met: <<var;name="bullet";words="0-1">> Redistributions of source code must retain
        the above copyright notice, this list of conditions and the following disclaimer.
        <<var;name="bullet";words="0-1">> Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    "apache-notice": """Licensed under the Apache License, Version 2.0
        <<beginOptional>>(the "License"); you may not use this file except in compliance with the License<<endOptional>>""",
    "gpl-notice": """licensed under the <<beginOptional>>terms of the<<endOptional>>
        GNU <<var;name="kind";words="0-1">> General Public License, version <<var;name="version";words="1-1">>""",
    "cc-by-nc-notice": """Licensed under <<beginOptional>>the<<endOptional>> CC BY-NC<<beginOptional>>-SA<<endOptional>>
        <<var;name="version";words="1-2">>""",
    "mit-notice": "Released under the <<beginOptional>>terms of the<<endOptional>> MIT License",
}

_MARKUP = re.compile(r'<<(beginOptional|endOptional|var;name="[^"]*";words="(\d+)-(\d+)")>>')

#: Words of a template that must stand together for its automaton to start.
ANCHOR = 3


@dataclass(frozen=True)
class Region:
    """A part of a template: words as they stand, an optional part, or a number of words of any kind."""

    words: tuple[str, ...] = ()
    optional: tuple[Region, ...] = ()
    least: int = 0
    most: int = 0


def regions(template: str) -> tuple[Region, ...]:
    """The parts of a template's markup, in order."""
    stack: list[list[Region]] = [[]]
    place = 0
    for mark in [*_MARKUP.finditer(template), None]:
        plain = plain_words(template[place:mark.start() if mark else len(template)])
        if plain:
            stack[-1].append(Region(words=tuple(plain)))
        if mark is None:
            break
        place = mark.end()
        if mark[1] == "beginOptional":
            stack.append([])
        elif mark[1] == "endOptional":
            if len(stack) == 1:
                raise ValueError("an optional region ends that did not begin")
            inner = stack.pop()
            stack[-1].append(Region(optional=tuple(inner)))
        else:
            stack[-1].append(Region(least=int(mark[2]), most=int(mark[3])))
    if len(stack) != 1:
        raise ValueError("an optional region does not end")
    return tuple(stack[0])


def plain_words(text: str) -> list[str]:
    lowered = text.translate({k: k + 32 for k in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


class Automaton:
    """States of one template; bit k of a set stands for having passed the first k steps."""

    def __init__(self, name: str, template: str):
        self.name, self._any, self._of = name, 0, {}
        self._skips: list[tuple[int, int]] = []
        self.steps = 0
        parts = regions(template)
        if not parts or not parts[0].words:
            raise ValueError("a template begins with mandatory words")
        self.anchor = parts[0].words[:ANCHOR]
        self._add(parts)
        self._skips.sort()

    def _add(self, parts: Iterable[Region]) -> None:
        for part in parts:
            begin = self.steps
            for word in part.words:
                code = int(hashes_of([word], "plain")[0][0])
                self._of[code] = self._of.get(code, 0) | 1 << self.steps
                self.steps += 1
            for k in range(part.most):
                if k >= part.least:
                    self._skips.append((self.steps, self.steps + 1))
                self._any |= 1 << self.steps
                self.steps += 1
            if part.optional:
                self._add(part.optional)
                self._skips.append((begin, self.steps))

    def _closed(self, states: int) -> int:
        for low, high in self._skips:
            if states >> low & 1:
                states |= 1 << high
        return states

    def longest(self, hashes: np.ndarray) -> int | None:
        """Words of the longest accepted run from the first word on; None if none is accepted."""
        states, best = self._closed(1), None
        for k in range(min(len(hashes), self.steps)):
            accepts = self._of.get(int(hashes[k]), 0) | self._any
            states = self._closed((states & accepts) << 1)
            if not states:
                break
            if states >> self.steps & 1:
                best = k + 1
        return best


def scan(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None) -> DataFrame:
    """doc_id, n_words and ``found`` (array of label, phrase, first, last) of every (doc_id, text).

    ``phrase`` tells a phrase's place from an accepted template; first and last are words, from 0. A template is
    reported at every place it can begin, with its longest reading. Texts are read whole; other columns are not read. A
    null text is empty; rows are treated one by one; an empty table gives no rows.
    """
    automata = [Automaton(name, text) for name, text in (TEMPLATES if templates is None else templates).items()]
    heads: dict[int, dict[int, list[tuple[str, Automaton | None, int]]]] = {}

    def listen(first: Iterable[str], entry: tuple[str, Automaton | None, int]) -> None:
        of = np.concatenate(hashes_of(list(first), "plain"))
        head = run_hash(of, np.array([0]), len(of))[0]
        heads.setdefault(len(of), {}).setdefault(int(head), []).append(entry)

    for automaton in automata:
        listen(automaton.anchor, (automaton.name, automaton, len(automaton.anchor)))
    for phrase, label in (PHRASES if phrases is None else phrases).items():
        listen(phrase.split(), (label, None, len(phrase.split())))
    places = {size: Places(np.array(sorted(of), np.uint64)) for size, of in heads.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words(batch.column(1), "plain"):
                rows: list[list[dict]] = [[] for _ in part.counts]
                for size, of in heads.items():
                    first, hashes = part.runs(size)
                    at, _ = places[size].find(hashes)
                    for begin, head in zip(first[at].tolist(), hashes[at].tolist(), strict=True):
                        row = int(np.searchsorted(part.at, begin, "right")) - 1
                        low, high = int(part.at[row]), int(part.at[row + 1])
                        for label, automaton, length in of[head]:
                            n = length if automaton is None else automaton.longest(part.hashes[begin:min(high, begin + automaton.steps)])
                            if n is not None:
                                rows[row].append({"label": label, "phrase": automaton is None, "first": begin - low,
                                                  "last": begin - low + n - 1})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, len(rows)), pa.array(part.counts), pa.array(rows, kind)],
                    ["doc_id", "n_words", "found"])

    kind = pa.list_(pa.struct([("label", pa.string()), ("phrase", pa.bool_()), ("first", pa.int64()), ("last", pa.int64())]))
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_kind}, n_words bigint, found array<struct<label: string, phrase: boolean, first: bigint, last: bigint>>")


def _names(found: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda f: f["label"]))), ",")


def report(docs: DataFrame) -> DataFrame:
    """What is found per document: doc_id, n_words, n_base (all places of phrases), first_word and last_word (smallest and
    largest word that one begins at, else null), base_labels, labels (of templates too) and score.

    The score is 1 if a template is accepted, 0.5 if only a phrase stands in the text, else 0. Labels are distinct, sorted
    and comma-joined, empty if there are none.
    """
    base = F.filter("found", lambda f: f["phrase"])
    starts = F.transform(base, lambda f: f["first"])
    accepted = F.exists("found", lambda f: ~f["phrase"])
    return scan(docs).select(
        "doc_id", "n_words", F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _names(base).alias("base_labels"), _names(F.col("found")).alias("labels"),
        F.when(accepted, 1.0).when(F.size(base) > 0, 0.5).otherwise(0.0).alias("score"))


def template_pattern(template: str) -> str:
    """The same language as a regular expression over words that each end in a blank, for other engines."""
    def pattern(parts: Iterable[Region]) -> str:
        found = ""
        for part in parts:
            found += "".join(f"{word} " for word in part.words)
            if part.most:
                found += f"(?:[^ ]+ ){{{part.least},{part.most}}}"
            if part.optional:
                found += f"(?:{pattern(part.optional)})?"
        return found

    return pattern(regions(template))
