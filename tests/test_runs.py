import pytest
from pyspark.sql import functions as F

from linkwright.streaming import runs
from tests.conftest import rows

SCHEMA = "k string, v int, at int"


def batch(spark, data):
    return spark.createDataFrame(data, SCHEMA).coalesce(1)


def add(spark, number, data, store, fan=3):
    runs.add_batch(batch(spark, data), number, store, "k", [F.col("at").desc()], fan)


def test_newest_rows_over_merged_runs(spark, tmp_path):
    store = str(tmp_path / "store")
    want = {}
    for n in range(11):
        data = [(f"k{(n * 5 + i * i) % 13}", n * 100 + i, i) for i in range(6)] + ([(None, n, 0)] if n in (2, 7) else [])
        want |= {k: v for k, v, _ in data}
        add(spark, n, data, store)
    levels = [r.level for r in runs.manifest(store).runs]
    assert levels == [2, 0, 0]  # 11 batches in threes: 9 + 1 + 1
    assert rows(runs.current(spark, store, "k"), "k", "v") == rows(spark.createDataFrame(list(want.items()), "k string, v int"))
    found = runs.lookup(spark, store, "k", ["k3", "zz"])
    assert rows(found, "k", "v") == [("k3", want["k3"])]
    assert runs.lookup(spark, store, "k", ["zz"]).count() == 0
    assert runs.unnamed(store)  # merged runs stay for readers that still use them


def test_repeated_and_stopped_batches(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    add(spark, 0, [("a", 1, 1), ("a", 2, 2)], store)
    add(spark, 0, [("a", 9, 9)], store)  # delivered again
    with monkeypatch.context() as m:
        m.setattr(runs, "_commit", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            add(spark, 1, [("b", 1, 1)], store)
    assert rows(runs.current(spark, store, "k"), "k", "v") == [("a", 2)]
    add(spark, 1, [("b", 1, 1)], store)
    add(spark, 2, [], store)
    assert rows(runs.current(spark, store, "k"), "k", "v") == [("a", 2), ("b", 1)]
    assert runs.manifest(store).last_batch == 2 and len(runs.manifest(store).runs) == 2


def test_new_store_and_only_empty_batches(spark, tmp_path):
    store = str(tmp_path / "store")
    with pytest.raises(ValueError):
        runs.current(spark, store, "k")
    add(spark, 0, [], store)
    assert runs.current(spark, store, "k").count() == 0 and runs.current(spark, store, "k").columns == ["k", "v", "at"]


def test_files_outside_the_range_are_not_opened(spark, tmp_path):
    store = str(tmp_path / "store")
    numbers = spark.range(20_000).select("id", (F.col("id") * 2).alias("v")).repartition(4)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        runs.add_batch(numbers, 0, store, "id", ["v"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(runs.manifest(store).runs[0].files) > 1
    found = runs.lookup(spark, store, "id", [7])
    assert rows(found) == [(7, 14)] and len(found.inputFiles()) == 1


def test_runs_stay_few():
    levels, most = [], 0
    for _ in range(1000):
        levels.append(0)
        while (level := runs.due(levels, 8)) is not None:
            levels = [n for n in levels if n != level] + [level + 1]
        most = max(most, len(levels))
    assert most <= 7 * 4
