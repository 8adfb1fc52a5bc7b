import random

import pytest

from linkwright.sources import csv_parallel
from linkwright.sources.csv_tables import CORRUPT, ROW_NO, read_raw
from linkwright.sources.schemas import RAW

TABLE = "CR_CTasks"


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def quoted(text):
    return '"' + text.replace('"', '""') + '"' if any(c in text for c in ',"\n\r') else text


def write(path, rows, end="\n"):
    path.write_text("".join(end * (k % 9 == 5) + ",".join(quoted(v) for v in r) + end for k, r in enumerate([RAW[TABLE], *rows])), newline="")


def drawn(seed, n):
    draw = random.Random(seed)
    parts = ["a", "b,", '"', '""', "\n", "\n\n", " x ", "é", "said: \"no\"\n", "1"]
    for k in range(n):
        width = len(RAW[TABLE]) + (k % 11 == 3) - 2 * (k % 13 == 4)
        yield [f"T{k}", *("".join(draw.choice(parts) for _ in range(draw.randint(0, 5))) for _ in range(width - 2)), f"end{k}"]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_the_multi_line_reader(spark, tmp_path, small_ranges, end):
    for k in range(3):
        write(tmp_path / f"f{k}.csv", list(drawn(k, 60)), end)
    want = read_raw(spark, str(tmp_path), TABLE)
    got = csv_parallel.scan_raw(spark, str(tmp_path), TABLE)
    columns = [*RAW[TABLE], CORRUPT]

    def table(df):
        kept = [[(v or "").rstrip("\r\n") if c == CORRUPT else v for c, v in zip(columns, r)] for r in df.select(*columns).collect()]
        return sorted(str(r) for r in kept)

    assert table(got) == table(want) and len(table(got)) == 180
    assert sum(r[CORRUPT] is not None for r in got.collect()) > 20


def test_a_file_is_many_tasks_and_rows_keep_its_order(spark, tmp_path, small_ranges):
    write(tmp_path / "f.csv", [[f"T{k}", *["x\n\"y\""] * (len(RAW[TABLE]) - 1)] for k in range(100)])
    assert spark.read.option("lineSep", "\n").text(str(tmp_path)).rdd.getNumPartitions() > 8
    found = csv_parallel.scan_table(spark, str(tmp_path), TABLE).orderBy(ROW_NO).collect()
    assert [r[0] for r in found] == [f"T{k}" for k in range(100)]


def test_a_record_over_many_ranges_and_odd_files(spark, tmp_path, small_ranges):
    rest = [""] * (len(RAW[TABLE]) - 2)
    write(tmp_path / "f.csv", [["A", "line\n" * 900, *rest], ["B", "x" * 3000, *rest], ["C", '"' * 1001, *rest], ["D", "", *rest]])
    (tmp_path / "header.csv").write_text(",".join(RAW[TABLE]) + "\n")
    (tmp_path / "empty.csv").write_text("")
    got = {r[0]: r[1] for r in csv_parallel.scan_table(spark, str(tmp_path), TABLE).collect()}
    assert got == {"A": "line\n" * 900, "B": "x" * 3000, "C": '"' * 1001, "D": None}


@pytest.mark.parametrize("rows_per_batch", ["1", "3"])
def test_records_go_over_batches_and_only_edges_are_shuffled(spark, tmp_path, small_ranges, rows_per_batch):
    for k in range(2):
        write(tmp_path / f"f{k}.csv", list(drawn(7 + k, 30)))

    def table(df):
        columns = [*RAW[TABLE], CORRUPT]
        return sorted(str([(v or "").rstrip("\r\n") if c == CORRUPT else v for c, v in zip(columns, r)]) for r in df.select(*columns).collect())

    want = table(read_raw(spark, str(tmp_path), TABLE))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows_per_batch)
    try:
        found = csv_parallel.scan_raw(spark, str(tmp_path), TABLE)
        assert table(found) == want and len(want) == 60
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    # no window holds the lines of a range: the one left numbers the pieces over the ends of ranges
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Join" in plan
