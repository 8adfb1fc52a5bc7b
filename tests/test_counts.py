from pyspark.sql import functions as F

from linkwright.session import rocksdb_state
from linkwright.streaming import counts
from tests.conftest import rows
from tests.test_streams import add, stream

SCHEMA = "id string, seq bigint, deleted boolean, kind string, label string"
FILES = [
    [("a", 1, False, "vertex", "A"), ("b", 1, False, "vertex", "A"), ("c", 1, False, "edge", "A"), ("n", 1, False, "vertex", None)],
    [("a", 2, False, "vertex", "B"), ("b", 2, True, "vertex", "A"), ("z", 1, True, "vertex", "A"), ("c", 1, False, "edge", "A")],
    [("a", 1, False, "vertex", "A"), ("b", 3, False, "vertex", "B"), ("b", 4, False, "vertex", "A"), ("n", 2, True, None, None)],
]
WANT = [
    [("edge", "A", 1), ("vertex", None, 1), ("vertex", "A", 2)],
    [("edge", "A", 1), ("vertex", None, 1), ("vertex", "B", 1)],
    [("edge", "A", 1), ("vertex", "A", 1), ("vertex", "B", 1)],
]


def test_counts_after_every_batch_over_restarts(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    with rocksdb_state(spark):
        for n, data in enumerate(FILES):
            add(spark, src, data, SCHEMA, f"f{n}")
            counts.count_feed(stream(spark, src, SCHEMA), out, mark, drain=True).awaitTermination()
            assert rows(counts.counts_after(spark, out)) == WANT[n]
    for n, want in enumerate(WANT):  # batches without a row count too
        last = spark.read.parquet(out).agg(F.max("batch_id")).first()[0]
        assert n <= last and rows(counts.counts_after(spark, out, n)) == want


def test_steps_that_cancel_are_left_out(spark):
    schema = "old_kind string, new_kind string, old_label string, new_label string, action string"
    steps = spark.createDataFrame([
        ("v", "v", "A", "A", "UPDATE"), (None, "v", None, "B", "INSERT"), ("v", None, "B", None, "DELETE"),
        (None, "v", None, "C", "LATE"), (None, "v", None, "D", "INSERT")], schema)
    assert rows(counts.count_steps(steps)) == [("v", "D", 1)]
    assert counts.count_steps(steps.filter("false")).count() == 0
