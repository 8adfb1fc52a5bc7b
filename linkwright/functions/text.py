"""Text expressions: clean-up, splitting, counting, flattening, chunk bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that count as white space when words are counted or text is stripped.
SPACE_CODES = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
SPACES = "".join(chr(code) for code in SPACE_CODES)
WORD = "[^" + "".join(rf"\x{{{code:x}}}" for code in SPACE_CODES) + "]+"
# The same words, counted faster: printable ASCII stands first in the class and is found at once, without a look at every space.
COUNTED_WORD = rf"[\x{{21}}-\x{{7e}}{WORD.removesuffix('+')}]+"
# Fixed value: a sentence ends after one of these marks, at one or more spaces.
SENTENCE_BREAK = r"(?<=[.!?]) +"
MAX_WORDS = 200


def blank_to_null(value: Column) -> Column:
    return F.nullif(strip(value), F.lit(""))


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(SPACES))


def one_line(value: Column) -> Column:
    return F.replace(value, F.lit("\n"), F.lit(" "))


def team_id(name: Column) -> Column:
    return F.concat(F.lit("TEAM-"), F.replace(name, F.lit(" "), F.lit("_")))


def split_list(value: Column, sep: str = ";") -> Column:
    """Parts of a delimited text without the empty ones."""
    return F.filter(F.split(value, F.lit(_literal_pattern(sep)), -1), lambda part: part != "")


def _literal_pattern(text: str) -> str:
    return "\\Q" + text + "\\E"


def padded_id(prefix: str, number: Column, width: int = 3) -> Column:
    """Prefix and zero-padded number; a longer number is kept whole."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.repeat(F.lit("0"), F.greatest(F.lit(0), width - F.length(digits))), digits)


def preview(value: Column, size: int = 300) -> Column:
    return F.concat(F.left(F.coalesce(value, F.lit("")), F.lit(size)), F.lit("..."))


def word_count(value: Column) -> Column:
    return F.regexp_count(value, F.lit(COUNTED_WORD))


def sentences(value: Column) -> Column:
    return F.split(F.coalesce(value, F.lit("")), SENTENCE_BREAK, -1)


def flatten_row(rows: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """``name: value`` for every non-null column, in column order, joined by `` | ``."""
    return F.concat_ws(" | ", *[
        F.concat(F.lit(f"{c}: "), F.col(c).cast("string")) for c in (columns or rows.columns)
    ])


def contains_any(values: Sequence[Column], keyword: Column) -> Column:
    """Case-sensitive containment in at least one of the texts; a null text contains nothing."""
    found = F.lit(False)
    for value in values:
        found = found | F.coalesce(F.contains(value, keyword), F.lit(False))
    return found


def chunk_starts(parts: Column, max_words: int = MAX_WORDS) -> Column:
    """Index of the first sentence of every chunk.

    Sentences are packed while the word count of the running text directly followed by the next
    sentence stays within the limit. There is no space between the two in that test, so the last
    word of one and the first of the next count as one when neither edge is white space. Only
    counts are carried along the fold; no text is built.
    """
    facts = F.transform(parts, lambda s: F.struct(
        word_count(s).alias("words"),
        (strip(F.left(s, F.lit(1))) != "").alias("joins_left"),
        (strip(F.right(s, F.lit(1))) != "").alias("joins_right"),
    ))
    start = F.struct(
        F.array().cast("array<int>").alias("starts"), F.lit(0).alias("words"),
        F.lit(False).alias("open"), F.lit(0).alias("at"),
    )

    def step(state: Column, fact: Column) -> Column:
        glued = F.when(state["open"] & fact["joins_left"], 1).otherwise(0)
        fits = state["words"] + fact["words"] - glued <= max_words
        return F.struct(
            F.when((state["at"] == 0) | ~fits, F.array_append(state["starts"], state["at"]))
            .otherwise(state["starts"]).alias("starts"),
            F.when(fits, state["words"] + fact["words"]).otherwise(fact["words"]).alias("words"),
            fact["joins_right"].alias("open"),
            (state["at"] + 1).alias("at"),
        )

    return F.aggregate(facts, start, step, lambda state: state["starts"])


def chunk_texts(parts: Column, starts: Column) -> Column:
    """The chunk texts for sentence bounds; a chunk that is only the empty tail is left out."""
    count = F.size(parts)
    texts = F.transform(starts, lambda at, i: strip(F.array_join(F.slice(
        parts, at + 1,
        F.coalesce(F.get(starts, i + 1), count) - at,
    ), " ")))
    empty_tail = (F.size(starts) > 1) & (F.element_at(starts, -1) == count - 1) & (F.element_at(parts, -1) == "")
    return F.when(empty_tail, F.slice(texts, F.lit(1), F.size(texts) - 1)).otherwise(texts)
