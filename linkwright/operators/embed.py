"""Model calls over columns: batched embedding and text completion, with a local stand-in for each.

A model is any function from a list of texts to a list of answers. It runs inside the tasks on
Arrow batches; nothing is collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwright.functions.fixed_text import MODEL_ERROR

Embed = Callable[[list[str]], list[Sequence[float]]]
Complete = Callable[[list[str]], list[str]]

EMBED_BATCH = 10


MAX_PLACES = 200_000


class HashedEmbedder:
    """A local embedder without a model: each word adds +1 or -1 at a place given by its md5."""

    def __init__(self, dims: int) -> None:
        self.dims = dims
        self._places: dict[str, tuple[int, float]] = {}

    def _place(self, word: str) -> tuple[int, float]:
        digest = hashlib.md5(word.encode()).hexdigest()
        found = int(digest[:8], 16) % self.dims, 1.0 if int(digest[8:10], 16) % 2 == 0 else -1.0
        if len(self._places) < MAX_PLACES:
            self._places[word] = found
        return found

    def __call__(self, texts: list[str]) -> list[Sequence[float]]:
        out = np.zeros((len(texts), self.dims))
        for row, text in enumerate(texts):
            for word in text.split():
                at, sign = self._places.get(word) or self._place(word)
                out[row, at] += sign
        size = np.linalg.norm(out, axis=1)
        return list(out / np.where(size == 0, 1, size)[:, None])


def echo_model(texts: list[str]) -> list[str]:
    """A local completer without a model: the md5 of the whole prompt."""
    return [f"Reply {hashlib.md5(t.encode()).hexdigest()}" for t in texts]


def embed_rows(
    rows: DataFrame, embed: Embed, text_col: str = "text", batch_size: int = EMBED_BATCH, keep_failed: bool = False
) -> DataFrame:
    """Add ``embedding`` (float array) by calling ``embed`` on batches of texts.

    A failing call loses its own batch only: those rows get a null embedding and ``error``, and are
    dropped unless ``keep_failed``.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("embedding", T.ArrayType(T.FloatType())),
                           T.StructField("error", T.StringType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = frame[text_col].fillna("").tolist()
            vectors: list = []
            errors: list[str | None] = []
            for at in range(0, len(texts), batch_size):
                batch = texts[at:at + batch_size]
                try:
                    answers = [np.asarray(v, dtype=np.float32) for v in embed(batch)]
                    if len(answers) != len(batch):
                        raise ValueError(f"{len(answers)} vectors for {len(batch)} texts")
                    vectors += answers
                    errors += [None] * len(batch)
                except Exception as problem:  # noqa: BLE001 - any model failure marks the batch
                    vectors += [None] * len(batch)
                    errors += [str(problem)] * len(batch)
            yield frame.assign(embedding=vectors, error=errors)

    done = rows.mapInPandas(run, schema)
    return done if keep_failed else done.filter(F.col("error").isNull()).drop("error")


def _answers(values: list[str], call: Callable[[list[str]], list], failed: Callable[[Exception], object]) -> list:
    """Answers to batches of texts; the texts of a batch that fails are asked one by one."""
    found: list = []
    for at in range(0, len(values), EMBED_BATCH):
        batch = values[at:at + EMBED_BATCH]
        try:
            answers = list(call(batch))
            if len(answers) != len(batch):
                raise ValueError(f"{len(answers)} answers to {len(batch)} texts")
            found += answers
        except Exception:  # noqa: BLE001 - one bad text must not fail its neighbours
            for value in batch:
                try:
                    found.append(call([value])[0])
                except Exception as problem:  # noqa: BLE001 - a failed call has an answer of its own
                    found.append(failed(problem))
    return found


def embedding(text: Column, embed: Embed) -> Column:
    """Embedding of a text column, asked in batches; null where the call fails."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            vectors = _answers(batch.fillna("").tolist(), embed, lambda _: None)
            yield pd.Series([None if v is None else np.asarray(v, dtype=np.float32) for v in vectors], dtype=object)

    return run(text)


def completion(prompt: Column, complete: Complete) -> Column:
    """Model answer to a prompt column, stripped, asked in batches; a failing call gives the error as text."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            answers = _answers(batch.fillna("").tolist(), complete, lambda problem: f"{MODEL_ERROR}{problem}")
            yield pd.Series([a.strip() for a in answers], dtype=object)

    return run(prompt)
