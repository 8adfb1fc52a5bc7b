import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from linkwright.streaming import outbox
from linkwright.streaming.appended import append_lines, blocks, lines, packed, packed_lines, ranges, read_appended, whole_bytes
from tests.conftest import rows

SCHEMA = "source string, line string"


def append(path, text):
    with open(path, "ab") as out:
        out.write(text.encode())


def drain(spark, src, out, mark, size=7):
    outbox.write_committed(read_appended(spark, str(src), size).select("source", "line"), str(out), str(mark)).awaitTermination()
    return rows(outbox.read_committed(spark, str(out), SCHEMA), "source", "line", "batch_id")


def test_a_restarted_feed_gives_each_line_once(spark, tmp_path):
    src, out, mark = (tmp_path / n for n in ("in", "out", "mark"))
    src.mkdir()
    append(src / "a", "one\ntwo is long enough for several ranges\n\nthr")
    append(src / "b", "ä\r\n")
    append(src / "_hidden", "no\n")
    first = drain(spark, src, out, mark)
    assert [r[:2] for r in first] == [("a", "one"), ("a", "two is long enough for several ranges"), ("b", "ä")]
    append(src / "a", "ee\nfour\n")
    append(src / "c", "five\n")
    second = drain(spark, src, out, mark)
    assert len(second) == 6 and [r[1] for r in second if r[2] != first[0][2]] == ["four", "three", "five"]
    assert drain(spark, src, out, mark) == second


def test_an_empty_feed_gives_nothing(spark, tmp_path):
    assert drain(spark, tmp_path / "none", tmp_path / "out", tmp_path / "mark") == []


def test_a_file_that_shrank_is_an_error():
    with pytest.raises(ValueError, match="may only grow"):
        ranges({"a": 10}, {"a": 4}, 100)
    assert ranges({"a": 10}, {}, 100) == [] == ranges({"a": 4}, {"a": 4}, 100)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab\r é", max_size=9), max_size=9), st.text(alphabet="ab", max_size=4), st.integers(1, 12), st.integers(1, 9))
def test_ranges_of_any_size_give_every_line_once(texts, tail, size, block):
    data = "".join(t + "\n" for t in texts).encode() + tail.encode()
    whole = whole_bytes(pa.BufferReader(data), block)
    assert whole == len(data) - len(tail)
    got = [line for r in ranges({}, {"f": whole}, size) for _, line in lines(pa.BufferReader(data), r.begin, r.end)]
    assert got == [t.encode().rstrip(b"\r\n") for t in texts if t.strip(" \r")]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="ab\r é", max_size=9), min_size=1, max_size=5), max_size=6), st.integers(1, 400), st.integers(0, 30))
def test_ranges_of_a_compressed_file_give_every_line_once(written, most, lost):
    """Whole blocks count, in ranges of any size; a block that is still being written does not."""
    data = b"".join(packed("".join(t + "\n" for t in texts).encode()) for texts in written)
    more = data + packed(b"late\n" * 9)[:lost]
    whole = max((end for _, end, _ in blocks(pa.BufferReader(more))), default=0)
    assert whole == len(data)
    got = [line for r in ranges({}, {"f.zst": whole}, most) for _, line in packed_lines(pa.BufferReader(more), r.begin, r.end)]
    assert got == [t.encode().rstrip(b"\r\n") for texts in written for t in texts if t.strip(" \r")]


def test_a_compressed_feed_grows_by_files_and_by_blocks(spark, tmp_path):
    src, out, mark = (tmp_path / n for n in ("in", "out", "mark"))
    texts = spark.range(3_000).repartition(2).select(F.concat(F.lit('{"document": "of the same shape", "é": '), "id", F.lit("}")).alias("value"))
    append_lines(texts.unionByName(spark.createDataFrame([(None,)], "value string")), f"file:{src}")
    files = [name for name in os.listdir(src) if name.endswith(".zst")]
    assert len(files) >= 2 and not [name for name in os.listdir(src) if name.startswith("_")]
    assert sum((src / name).stat().st_size for name in files) * 4 < 3_000 * 45
    first = drain(spark, src, out, mark, 20_000)
    assert sorted(r[1] for r in first) == sorted(r["value"] for r in texts.collect())
    with open(src / files[0], "ab") as file:
        file.write(packed(b"one\ntwo\n") + packed(b"three\n")[:-1])
    append(src / "plain", "four\n")
    second = drain(spark, src, out, mark, 20_000)
    assert sorted(r[1] for r in second if r[2] != first[0][2]) == ["four", "one", "two"]
    kept = pq.ParquetFile(next(f for f in (out / "data").iterdir() if f.suffix == ".parquet")).metadata.row_group(0).column(0)
    assert kept.compression == "ZSTD"


def test_a_batch_that_was_not_committed_shows_nothing(spark, tmp_path):
    path = outbox.prepare(str(tmp_path / "out"))
    writer = outbox.CommittedWriter(path)
    batch = pa.RecordBatch.from_pydict({"source": ["a"], "line": ["x"]})
    killed = writer.write(iter([batch]))
    assert rows(outbox.read_committed(spark, path, SCHEMA)) == []
    again = writer.write(iter([batch]))
    writer.commit([again, None, writer.write(iter([]))], 0)
    assert rows(outbox.read_committed(spark, path, SCHEMA), "line", "batch_id") == [("x", 0)]
    writer.commit([writer.write(iter([batch]))], 0)  # the batch is repeated after its commit
    assert rows(outbox.read_committed(spark, path, SCHEMA), "line", "batch_id") == [("x", 0)]
    writer.abort([killed, None], 1)
    assert not (tmp_path / "out" / "data" / killed.file).exists()


def test_a_failed_batch_is_tried_again_from_its_offsets(spark, tmp_path):
    src, out, mark = (tmp_path / n for n in ("in", "out", "mark"))
    src.mkdir()
    append(src / "a", "1\n2\nx\n")
    stream = read_appended(spark, str(src)).select("source", F.expr("CASE WHEN line = 'x' THEN raise_error('bad') ELSE line END").alias("line"))
    with pytest.raises(Exception):
        outbox.write_committed(stream, str(out), str(mark)).awaitTermination()
    assert rows(outbox.read_committed(spark, str(out), SCHEMA)) == []
    assert [r[1] for r in drain(spark, src, out, mark)] == ["1", "2", "x"]
