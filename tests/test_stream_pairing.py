import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from linkwright.session import rocksdb_state
from linkwright.streaming.pairing import answer_stream, fifo_stream
from tests.test_pairing import queue

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "k string, turn bigint, ts timestamp, id bigint, asks boolean"
CLOCK = (None, None, START + timedelta(days=9), None, None)


def fed(spark, tmp_path, batches, job):
    """The rows that ``job`` gives when every batch is a run of its own, restarted from the checkpoint."""
    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    with rocksdb_state(spark):
        for n, batch in enumerate(batches):
            spark.createDataFrame(batch, SCHEMA).coalesce(1).write.parquet(f"{src}/{n}")
            stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).parquet(src)
            (job(stream).writeStream.format("parquet").option("checkpointLocation", mark).trigger(availableNow=True)
             .start(out).awaitTermination())
    return spark.read.parquet(out).collect()


def test_answers_over_restarts_come_once_and_in_time(spark, tmp_path):
    draw = random.Random(1)
    rows = [(draw.choice("abc"), 0, START + timedelta(seconds=draw.randint(0, 600)), i, draw.random() < 0.5) for i in range(150)]
    rows.sort(key=lambda r: (r[2] + timedelta(seconds=draw.randint(0, 50))))  # out of order within a minute
    got = fed(spark, tmp_path, [rows[:70], rows[70:110], rows[110:], [CLOCK]], lambda s: answer_stream(s, "k", 30))
    assert len(got) == sum(r[4] for r in rows)
    found = {r["request_id"]: (r["response_id"], r["status"], r["wait_seconds"]) for r in got}
    for k, _, ts, i, asks in rows:
        if asks:
            near = sorted((t, j) for key, _, t, j, a in rows if key == k and not a and ts <= t <= ts + timedelta(seconds=30))
            assert found[i] == ((near[0][1], 200, (near[0][0] - ts).total_seconds()) if near else (None, 504, None))


def test_a_limit_that_has_passed_is_reported_without_another_message_of_the_key(spark, tmp_path):
    rows = [("a", 0, START, 1, True)]
    clock = [(None, None, START + timedelta(seconds=95), None, None)]
    got = fed(spark, tmp_path, [rows, clock], lambda s: answer_stream(s, "k", 30))
    assert [(r["k"], r["request_id"], r["status"]) for r in got] == [("a", 1, 504)]


def test_queues_live_over_batches_and_restarts(spark, tmp_path):
    draw = random.Random(4)
    sessions = {s: [(t, draw.random() < 0.5) for t in range(draw.randint(1, 40))] for s in "abcdefgh"}
    rows = [(s, t, START + timedelta(seconds=t), t, a) for s, m in sessions.items() for t, a in m]
    batches = [[r for r in rows if 13 * n <= r[1] < 13 * (n + 1)] for n in range(4)]
    for batch in batches:
        draw.shuffle(batch)
    got = defaultdict(dict)
    for r in fed(spark, tmp_path, [*(b for b in batches if b), [CLOCK]], lambda s: fifo_stream(s, "k", "turn", "1 hour")):
        assert r["n"] == sum(a for t, a in sessions[r["k"]] if t <= r["request"])
        got[r["k"]][r["request"]] = r["response"]
    assert got == {s: queue(m) for s, m in sessions.items() if any(a for _, a in m)}


def test_a_row_without_a_key_is_a_clock_row_only_without_asks(spark, tmp_path):
    rows = [(None, 0, START, 1, True), (None, 1, START + timedelta(seconds=3), 2, False)]
    got = fed(spark, tmp_path, [rows, [CLOCK]], lambda s: answer_stream(s, "k", 30))
    assert [(r["request_id"], r["response_id"]) for r in got] == [(1, 2)]




def test_a_slice_of_several_files_is_one_batch(spark, tmp_path, monkeypatch):
    from bindings import star
    monkeypatch.setattr(star, "FILE_ROWS", 50)
    rows_ = spark.range(800).select((F.col("id") % 97).alias("k"), F.timestamp_seconds(F.col("id")).alias("ts"), "id")
    stream, _ = star._fed(spark, rows_, "k", "1 DAYS")
    sizes = []
    stream.writeStream.foreachBatch(lambda df, n: sizes.append(df.count())).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert len(sizes) == star.SLICES + 1 and sum(sizes) == 801
