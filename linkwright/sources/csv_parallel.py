"""CSV with quoted line breaks, read by many tasks per file.

Whether a line end lies inside quotes depends on the number of quotes before it in the file, so a reader that starts in the
middle does not know. A scan of every file range counts its quotes; one bit per range, the parity of all quotes before it,
then tells every range how it begins. Inside a range lines are joined to records, and a record that goes over the end of
a range is joined from one piece per range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkwright.sources.csv_tables import CORRUPT, ROW_NO, quarantine
from linkwright.sources.schemas import RAW, text_schema
from linkwright.session import written

_ALL_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)

PIECE = "file string, block bigint, at bigint, number int, first boolean, odd boolean, text string"
_PIECE = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("number", pa.int32()),
                    ("first", pa.bool_()), ("odd", pa.bool_()), ("text", pa.string())])


class _Open:
    """A range's record that may go on in the next batch: where it begins, its number (0: begun in an earlier range), its lines."""

    def __init__(self, file: str, block: int, at: int, number: int, first: bool):
        self.head, self.quotes, self.lines = (file, block, at, number, first), 0, []

    def add(self, lines: pa.Array, quotes: int) -> None:
        self.lines.append(lines)
        self.quotes += quotes

    def piece(self) -> pa.RecordBatch:
        text = "\n".join(line for lines in self.lines for line in lines.to_pylist())
        return pa.RecordBatch.from_arrays(
            [pa.array([v], t) for v, t in zip((*self.head, self.quotes % 2 == 1, text), _PIECE.types)], schema=_PIECE)

    def over_the_end(self) -> bool:
        """Whether it is the rest of an earlier range's record, or open at the range's end."""
        return self.head[3] == 0 or self.quotes % 2 == 1


def _joined(lines: pa.RecordBatch, starts: np.ndarray, first: bool) -> pa.RecordBatch:
    """The lines from the first of ``starts`` to the last one, as one record from each start to the next."""
    n, edges = len(starts) - 1, pa.array(starts, pa.int32())
    text = pc.binary_join(pa.ListArray.from_arrays(edges, lines.column("text")), "\n")
    begins = lines.take(edges.slice(0, n))
    flags = np.zeros(n, bool)
    flags[:1] = first
    return pa.RecordBatch.from_arrays(
        [begins.column("file"), begins.column("block"), begins.column("at"), pa.array(np.ones(n, np.int32)), pa.array(flags),
         pa.array(np.zeros(n, bool)), text], schema=_PIECE)


def _pieces(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    """Records of ranges whose lines come in order: the whole ones, or the pieces of those that go over the end of a range."""
    current: _Open | None = None
    for batch in batches:
        blocks, files = batch.column("block").to_numpy(), batch.column("file").dictionary_encode().indices.to_numpy()
        new = np.flatnonzero((blocks[1:] != blocks[:-1]) | (files[1:] != files[:-1])) + 1
        for low, high in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
            if low == high:
                continue
            lines = batch.slice(low, high - low)
            file, block = lines.column("file")[0].as_py(), int(blocks[low])
            begun = current is not None and current.head[:2] == (file, block)
            if current is not None and not begun and current.over_the_end() != whole:
                yield current.piece()
            quotes, text = lines.column("quotes").to_numpy(), lines.column("text")
            before = np.cumsum(quotes) - quotes + (current.quotes + (current.head[3] == 0) if begun else lines.column("quoted")[0].as_py())
            starts = np.flatnonzero(before % 2 == 0)
            if not begun:
                inside = not len(starts) or starts[0] > 0
                current = _Open(file, block, lines.column("at")[0].as_py(), 0 if inside else 1, True)
            if not len(starts):
                current.add(text, int(quotes.sum()))
                continue
            rest = int(starts[0])
            current.add(text.slice(0, rest), int(quotes[:rest].sum()))
            if begun or rest:
                if current.over_the_end() != whole:
                    yield current.piece()
            if whole and len(starts) > 1:
                yield _joined(lines, starts, not begun and not rest)
            last = int(starts[-1])
            current = _Open(file, block, lines.column("at")[last].as_py(), 1, not begun and not last)
            current.add(text.slice(last), int(quotes[last:].sum()))
    if current is not None and current.over_the_end() != whole:
        yield current.piece()


def records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The records of CSV files, unparsed: file, block, at (which sort in file order), first and text. Headers are records too.

    ``first`` marks the record that begins with the first line of its range. The lines of a range are joined where they are
    read, batch by batch, so a task holds a batch and one record; only records over the end of a range are shuffled.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"),
        F.regexp_count("value", F.lit('"')).cast("bigint").alias("quotes"))
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(*_ALL_BEFORE)
    zero = F.lit(0).cast("bigint")
    begins = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes")).select(
        "file", "block", (F.coalesce(F.sum("quotes").over(in_file), zero) % 2).alias("quoted"))
    begins = F.broadcast(written(begins, "quote_parity"))  # a number per range; a join by shuffle would lose the order of lines
    placed = lines.join(begins, ["file", "block"])

    whole = placed.mapInArrow(lambda rows: _pieces(rows, True), PIECE).select("file", "block", "at", "first", "text")
    edge = Window.partitionBy("file").orderBy("block", "number").rowsBetween(*_SO_FAR)
    spread = placed.mapInArrow(lambda rows: _pieces(rows, False), PIECE).withColumn("record", F.sum("number").over(edge))
    spread = spread.groupBy("file", "record").agg(
        F.min(F.struct("block", "at", "first")).alias("start"), F.expr("listagg(text, '\\n') WITHIN GROUP (ORDER BY block, number)").alias("text"))
    return whole.unionByName(spread.select("file", "start.block", "start.at", "start.first", "text"))


def scan_raw(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """One raw table like ``read_raw`` with line breaks in quotes, split over tasks within a file, with ``row_no`` in file order.

    Quotes are those of RFC 4180: a field with a quote in it is quoted, and the quote doubled. Lines end in LF or CR LF; empty
    lines between records are skipped; every file has a header. A file whose last quote is missing ends in one malformed row.
    """
    schema = text_schema(RAW[table], (CORRUPT,))
    found = records(spark, path)
    line = F.regexp_replace("text", "\r$", "")
    header = (F.col("block") == 0) & F.col("first")
    parsed = F.from_csv("line", ", ".join(f"`{f.name}` string" for f in schema.fields), {
        "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})

    def pad(name: str):
        return F.lpad(F.col(name).cast("string"), 20, "0")

    body = found.withColumn("header", header).withColumn("line", line).filter("NOT header AND line <> ''")
    return body.select(parsed.alias("row"), F.concat_ws("#", "file", pad("block"), pad("at")).alias(ROW_NO)).select("row.*", ROW_NO)


def scan_table(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """The well-formed rows of ``scan_raw``, in a known file order."""
    return quarantine(scan_raw(spark, path, table))[0]
