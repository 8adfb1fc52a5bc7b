"""A change feed of files that are appended to, as a streaming source with offsets of its own.

Every file of a folder is one partition of the feed, and the stream's offset holds the bytes read of each. A batch reads what
was appended since the last one, cut into byte ranges, one task each, so that neither a large file nor a long pause makes a
large task. The offset grows with the number of files: let a feed have as many files as writers, not one per message.

A file may be plain text, or blocks of whole lines, each compressed for itself (``append_lines``, names in ``.zst``). Such a file
is cut into ranges and may grow like a plain one, block by block.
"""

from __future__ import annotations

import io
import struct
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from linkwright.streaming.places import opened, visible

SOURCE = "appended_lines"
RANGE_BYTES = 64 * 1024 * 1024
BLOCK = 1024 * 1024
BATCH_BYTES = 4 * 1024 * 1024
PACKED = ".zst"
#: What a block holds over what it takes, about: a range of a compressed file is smaller by that.
PACKED_SHARE = 8
#: A block is a zstd frame behind a skippable frame of eight bytes, its sizes as it is and unpacked; zstd tools can read the file.
HEAD, HEAD_BYTES, SKIPPED = "<IIII", 16, 0x184D2A50
LINES = pa.schema([("source", pa.string()), ("at", pa.int64()), ("line", pa.string())])


@dataclass
class ByteRange(InputPartition):
    """The lines of a file whose first byte is at ``begin`` or later and before ``end``."""

    source: str
    begin: int
    end: int


def ranges(start: dict, end: dict, most: int) -> list[ByteRange]:
    """What lies between two offsets, in ranges of at most ``most`` bytes.

    A file that is not in ``end`` is gone and has nothing to read. One that is shorter than what was read of it was not only
    appended to, which is an error.
    """
    out = []
    for source, until in sorted(end.items()):
        begin, size = start.get(source, 0), max(1, most // PACKED_SHARE) if source.endswith(PACKED) else most
        if until < begin:
            raise ValueError(f"{source} has {until} bytes, of which {begin} were read: files of a feed may only grow")
        out += [ByteRange(source, at, min(at + size, until)) for at in range(begin, until, size)]
    return out


def whole_bytes(file: pa.NativeFile, block: int = BLOCK) -> int:
    """The bytes up to the last line break; what follows is a line that is still being written."""
    end = file.size()
    while end:
        begin = max(0, end - block)
        file.seek(begin)
        found = file.read(end - begin).rfind(b"\n")
        if found >= 0:
            return begin + found + 1
        end = begin
    return 0


def lines(file: pa.NativeFile, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(position, line) of the lines that begin in a range, without line breaks; blank lines are left out.

    Where the range begins inside a line, that line belongs to an earlier range and is passed over in blocks, no further than
    the end of the range.
    """
    at = max(0, begin - 1)
    file.seek(at)
    reader = io.BufferedReader(file, BLOCK)
    if begin:
        ended = False
        while not ended and at < end:
            piece = reader.readline(BLOCK)
            ended = piece.endswith(b"\n") or not piece
            at += len(piece)
    while at < end:
        line = reader.readline()
        if not line:
            return
        if line.strip():
            yield at, line.rstrip(b"\r\n")
        at += len(line)


def packed(text: bytes | pa.Buffer) -> bytes:
    """A block of whole lines."""
    frame = pa.Codec("zstd").compress(text, asbytes=True)
    return struct.pack(HEAD, SKIPPED, HEAD_BYTES - 8, len(frame), len(text)) + frame


def blocks(file: pa.NativeFile, begin: int = 0) -> Iterator[tuple[int, int, int]]:
    """(position, end, unpacked bytes) of the whole blocks of a file, from one's first byte on, by their heads alone.

    The last block is left out while it is still being written.
    """
    at, size = begin, file.size()
    while at + HEAD_BYTES <= size:
        file.seek(at)
        mark, told, taken, held = struct.unpack(HEAD, file.read(HEAD_BYTES))
        if (mark, told) != (SKIPPED, HEAD_BYTES - 8):
            raise ValueError(f"no block of lines at byte {at}")
        end = at + HEAD_BYTES + taken
        if end > size:
            return
        yield at, end, held
        at = end


def packed_lines(file: pa.NativeFile, begin: int, end: int) -> Iterator[tuple[int, bytes]]:
    """``lines`` of the blocks that begin in a range, with the position of their block."""
    for at, until, held in blocks(file):
        if at >= end:
            return
        if at >= begin:
            file.seek(at + HEAD_BYTES)
            for line in pa.Codec("zstd").decompress(file.read(until - at - HEAD_BYTES), held, asbytes=True).split(b"\n"):
                if line.strip():
                    yield at, line.rstrip(b"\r\n")


class AppendedLinesReader(DataSourceStreamReader):
    def __init__(self, path: str, range_bytes: int) -> None:
        self._path, self._range_bytes = path, range_bytes
        self._packed: dict[str, int] = {}  # where the known blocks of a file end

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        from pyarrow import fs

        system, folder = opened(self._path)
        found = {}
        for info in system.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if info.is_file and visible(info.base_name):
                with system.open_input_file(info.path) as file:
                    if info.base_name.endswith(PACKED):
                        known = self._packed.get(info.base_name, 0)
                        known = known if known <= file.size() else 0
                        self._packed[info.base_name] = max((end for _, end, _ in blocks(file, known)), default=known)
                    found[info.base_name] = self._packed[info.base_name] if info.base_name.endswith(PACKED) else whole_bytes(file)
        return found

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return ranges(start, end, self._range_bytes)

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        system, folder = opened(self._path)

        def batch(found: list[tuple[int, bytes]]) -> pa.RecordBatch:
            texts = [line.decode("utf-8", "replace") for _, line in found]
            return pa.RecordBatch.from_arrays([
                pa.array([partition.source] * len(found), pa.string()), pa.array([at for at, _ in found], pa.int64()),
                pa.array(texts, pa.string())], schema=LINES)

        held, size = [], 0
        with system.open_input_file(f"{folder}/{partition.source}") as file:
            found = packed_lines if partition.source.endswith(PACKED) else lines
            for place in found(file, partition.begin, partition.end):
                held.append(place)
                size += len(place[1])
                if size >= BATCH_BYTES:
                    yield batch(held)
                    held, size = [], 0
        if held:
            yield batch(held)


class AppendedLines(DataSource):
    """Options: ``path`` (folder) and ``rangebytes`` (bytes per task). Rows: source, at, line."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return "source string, at bigint, line string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return AppendedLinesReader(self.options["path"], int(self.options.get("rangebytes", RANGE_BYTES)))


def read_appended(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """A stream of the lines appended to the files of a folder: (source, at, line), ``at`` in bytes.

    In a compressed file ``at`` is the place of the line's block.
    Each line is given once, over restarts too, as the checkpoint of the stream keeps the offsets. A line counts when its
    line break is there; bytes that are no UTF-8 are replaced; an empty folder gives nothing. A line is read whole by the
    task of the range that it begins in.
    """
    spark.dataSource.register(AppendedLines)
    return spark.readStream.format(SOURCE).option("path", path).option("rangebytes", range_bytes).load()


def append_lines(rows: DataFrame, path: str) -> None:
    """Append the texts of a frame of one column to a feed, as a new file of compressed blocks per task that has rows.

    A text is a line, so it holds no line break; null is a blank line. Files show when all tasks have ended, under the names that
    the tasks sent, so one of a task tried twice stays hidden.
    """
    system, folder = opened(path)
    system.create_dir(folder, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = opened(path)
        name, out, held, size = f"{uuid.uuid4().hex}{PACKED}", None, [], 0

        def block() -> bytes:
            return packed(b"".join(text for piece in held for text in (piece, b"\n")))

        try:
            for batch in batches:
                if batch.num_rows:
                    out = out or system.open_output_stream(f"{folder}/_{name}", compression=None)  # not once more for its name
                    texts = batch.column(0).cast(pa.string()).fill_null("")
                    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(texts)], texts), "\n")[0].as_buffer().to_pybytes()
                    held.append(joined)
                    size += len(joined)
                if size >= BATCH_BYTES:
                    out.write(block())
                    held, size = [], 0
            if held:
                out.write(block())
        finally:
            if out:
                out.close()
        if out:
            yield pa.RecordBatch.from_pydict({"file": [name]})

    for row in rows.mapInArrow(write, "file string").collect():
        system.move(f"{folder}/_{row['file']}", f"{folder}/{row['file']}")
