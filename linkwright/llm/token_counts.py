"""Token counts of whole texts by a byte-level BPE tokenizer, with huge texts shared out over tasks.

A huge text is encoded in chunks that overlap. A chunk after the first may begin inside a piece, so its first tokens
may be others than those of the whole text; but the splitting pattern looks only ahead, so from a place on where a piece of
the whole text begins, a chunk that also begins a piece there goes on exactly like the whole text. Such a place is
proven by the chunk before, whose pieces are right (by induction from the start of the text) wherever all that the
pattern could look at lies inside it. Two chunks are spliced at the first place that both have; where there is none,
the overlap is widened, in the end by the whole next chunk.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.llm.process import kept
from linkwright.llm.segments import batches, byte_tokens, cut, encode_segments, require_byte_level
from linkwright.session import written

#: Characters of a chunk, of the overlap at first, and how many times wider each new overlap is.
CHUNK_CHARS, OVERLAP_CHARS, WIDER = 1 << 15, 256, 8

#: Characters behind a piece that the splitting pattern looks at, at most: "'" may begin "'re".
LOOK_AHEAD = 3

#: Characters of texts that are worked on together, and bytes of remembered segments in a task.
SLICE_CHARS, KEPT_BYTES = 1 << 20, 24 << 20


class Counter:
    """A tokenizer with the counts of segments that it has seen, up to KEPT_BYTES."""

    def __init__(self, data: str):
        from tokenizers import Tokenizer

        require_byte_level(json.loads(data))
        self.tokenizer = Tokenizer.from_str(data)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.sizes = np.array([len(t) for t in byte_tokens(self.tokenizer)], np.int64)
        special = [len(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: A place this far from the end of a chunk is no part of a special string or a piece that goes on behind it.
        self.margin = max([0, *special]) + LOOK_AHEAD
        self.known: dict[str, int] = {}
        self.bytes = 0

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of every text, as the sum over its segments."""
        parts = [cut(t) if t else [] for t in texts]
        new = list(set().union(*parts) - self.known.keys()) if parts else []
        if new:
            _, at, order = encode_segments(self.tokenizer, self.sizes, new)
            for i, n in zip(order, np.diff(at).tolist()):
                self.known[new[i]] = n
                self.bytes += len(new[i]) + 110  # a short string and its entry
        found = [sum(map(self.known.__getitem__, p)) for p in parts]
        if self.bytes > KEPT_BYTES:
            self.known, self.bytes = {}, 0
        return found

    def pieces(self, text: str) -> tuple[int, np.ndarray, np.ndarray]:
        """Tokens of a text; where its pieces begin, in characters; and the tokens before each of them."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        words = np.array([-1 if w is None else w for w in found.word_ids], np.int64)
        first = np.flatnonzero(np.diff(words, prepend=-2) != 0)
        offsets = found.offsets  # a list made anew at every call
        places = np.array([offsets[k][0] for k in first], np.int64)
        return len(words), places, first


def _counter(file: str) -> Counter:
    def make() -> Counter:
        with open(SparkFiles.get(file), encoding="utf-8") as data:
            return Counter(data.read())

    return kept(("token counts", file), make)


def _short(texts: DataFrame, file: str) -> DataFrame:
    """(row_no..., n_tokens) of texts that are counted where they are read."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(file)
        for batch in rows:
            found: list[int] = []
            for part in batches((t.as_py() for t in batch.column(1)), SLICE_CHARS):
                found += counter.counts(part)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.select("doc_id", "text", "n_bytes").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")


def _encoded(chunks: DataFrame, file: str) -> DataFrame:
    """Per chunk its tokens, and where pieces begin in its two overlaps, with the tokens before them."""
    places = "array<struct<place: bigint, before: bigint>>"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(file)
        kind = pa.list_(pa.struct([("place", pa.int64()), ("before", pa.int64())]))
        for batch in rows:
            out: dict[str, list] = {"n": [], "left": [], "right": []}
            for r in batch.select(["first", "last", "left_end", "right_begin", "text"]).to_pylist():
                n, at, before = counter.pieces(r["text"])
                at = at + r["first"]
                left = at < r["left_end"] if r["first"] else np.zeros(len(at), bool)
                right = np.zeros(len(at), bool)
                if r["right_begin"] is not None:
                    right = (at >= r["right_begin"]) & (at <= r["last"] - counter.margin)
                out["n"].append(n)
                for name, mask in (("left", left), ("right", right)):
                    out[name].append([{"place": p, "before": b} for p, b in zip(at[mask].tolist(), before[mask].tolist())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row_no"), batch.column("no"), pa.array(out["n"], pa.int64()),
                 pa.array(out["left"], kind), pa.array(out["right"], kind)], ["row_no", "no", "n", "left", "right"])

    return chunks.mapInArrow(run, f"row_no bigint, no int, n bigint, left {places}, right {places}")


def _chunks(texts: DataFrame) -> DataFrame:
    """Chunks of texts with ``cuts``: (place, width) of the chunk starts behind the first, in order.

    A chunk goes on over the overlap behind the next cut. They are dealt out by hash, so one text meets many tasks.
    """
    starts = F.concat(F.array(F.struct(F.lit(0).cast("bigint").alias("place"), F.lit(0).cast("bigint").alias("width"))), "cuts")

    def chunk(c: Column, no: Column) -> Column:
        after = F.get("starts", no + 1)
        last = F.coalesce(F.least(after["place"] + after["width"], F.col("chars")), F.col("chars"))
        return F.struct(
            no.alias("no"), c["place"].alias("first"), last.alias("last"), (c["place"] + c["width"]).alias("left_end"),
            after["place"].alias("right_begin"),
            F.substring(F.col("text"), (c["place"] + 1).cast("int"), (last - c["place"]).cast("int")).alias("text"))

    return (texts.withColumn("starts", starts).select("row_no", F.explode(F.transform("starts", chunk)).alias("c"))
            .select("row_no", "c.*").repartition("row_no", "no"))


def _splices(encoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row_no, tokens) of texts whose chunks all meet, and (row_no, no) of the cuts where two chunks have no common place.

    With a splice at p, chunk k stands for its tokens before p less those before the splice where it begins, so a text has
    the tokens of its last chunk and, over the splices, the sum of (before p in k) - (before p in k + 1).
    """
    left = encoded.select("row_no", (F.col("no") - 1).alias("no"), F.col("left").alias("next"))
    met = (
        encoded.join(left, ["row_no", "no"], "left")
        .withColumn("shared", F.array_min(F.array_intersect("right.place", "next.place")))
        .withColumn("gain", F.when(F.col("next").isNull(), F.col("n")).otherwise(_before("right") - _before("next")))
        .select("row_no", "no", "gain")
    )
    met = written(met, "splices")
    sums = met.groupBy("row_no").agg(F.sum("gain").alias("n_tokens"), F.count_if(F.col("gain").isNull()).alias("failed"))
    failed = met.filter("gain IS NULL").select("row_no", (F.col("no") + 1).alias("no"))
    return sums.filter("failed = 0").select("row_no", "n_tokens"), failed


def _before(side: str) -> Column:
    at = F.array_position(F.col(f"{side}.place"), F.col("shared"))
    return F.get(F.col(f"{side}.before"), (at - 1).cast("int"))


def _widened(texts: DataFrame, failed: DataFrame) -> DataFrame:
    """The texts of failed cuts, these cuts with wider overlaps; a cut whose overlap would reach the next one goes."""
    cuts = texts.join(failed.select("row_no").distinct(), "row_no").select("row_no", "chars", F.posexplode("cuts").alias("p", "c"))
    cuts = cuts.select("row_no", "chars", (F.col("p") + 1).alias("no"), "c.place", "c.width")
    cuts = cuts.join(failed.withColumn("wide", F.lit(WIDER)), ["row_no", "no"], "left").withColumn(
        "width", F.col("width") * F.coalesce("wide", F.lit(1)))
    after = F.coalesce(F.lead("place").over(Window.partitionBy("row_no").orderBy("place")), F.col("chars"))
    left = cuts.withColumn("after", after).filter(F.col("place") + F.col("width") < F.col("after")).groupBy("row_no").agg(
        F.array_sort(F.collect_list(F.struct("place", "width"))).alias("cuts"))
    empty = F.array().cast("array<struct<place: bigint, width: bigint>>")
    again = failed.select("row_no").distinct().join(left, "row_no", "left")
    return texts.drop("cuts").join(again, "row_no").withColumn("cuts", F.coalesce("cuts", empty))


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = 512,
                 chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of every row's whole text.

    Tokens are those of the byte-level tokenizer in ``tokenizer_file`` (a driver's path, sent once to every executor), without
    tokens at the ends; a special string inside a text is one token, as is the library's default. Texts of more than
    ``chunk_chars`` characters are cut into overlapping chunks that are encoded in any task and spliced.

    A null text counts as empty: no tokens. Rows are treated one by one, so a null or repeated doc_id and equal rows
    stay as they are; other columns are not read. Memory: a task holds a batch of texts or a chunk; a chunk grows only over
    a run that the pattern does not split (one piece, which the tokenizer takes whole), and at most to the text.
    """
    if overlap_chars < 1 or chunk_chars <= overlap_chars:
        raise ValueError("a chunk must be longer than its overlap")
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer_file)
    file = tokenizer_file.rpartition("/")[2]
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn(
        "n_bytes", F.octet_length("text").cast("bigint"))
    # a text has no more characters than bytes, so most rows are told apart without counting characters
    huge = (F.col("n_bytes") > chunk_chars) & (F.length("text") > chunk_chars)
    found = _short(texts.filter(~huge), file)

    places = F.sequence(F.lit(chunk_chars).cast("bigint"), F.col("chars") - 1, F.lit(chunk_chars).cast("bigint"))
    left = written(
        texts.filter(huge).withColumn("row_no", F.monotonically_increasing_id())
        .withColumn("chars", F.length("text").cast("bigint"))
        .withColumn("cuts", F.transform(places, lambda p: F.struct(p.alias("place"), F.lit(overlap_chars).cast("bigint").alias("width")))),
        "huge_texts")
    named = left.select("row_no", "doc_id", "n_bytes")
    while not left.isEmpty():
        counts, failed = _splices(written(_encoded(_chunks(left), file), "chunks"))
        found = found.unionByName(named.join(counts, "row_no").select("doc_id", "n_bytes", "n_tokens"))
        left = written(_widened(left, failed), "huge_texts")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
