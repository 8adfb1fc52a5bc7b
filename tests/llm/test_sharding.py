import random
from collections import Counter

from pyspark.sql import functions as F

from linkwright.llm import sharding


def plain_best_fit(items, capacity):
    """Bin of every item by looking at all bins."""
    rooms, place = [], {}
    for k in sorted(range(len(items)), key=lambda k: (-items[k][0], items[k][1])):
        size = items[k][0]
        fits = [room for room in rooms if room[0] >= size]
        spot = min(fits, key=lambda room: room[0]) if fits and size <= capacity else None
        if spot is None:
            spot = [capacity if size <= capacity else size, len(rooms)]
            rooms.append(spot)
        spot[0] -= size
        place[k] = spot[1]
    return len(rooms)


def places(sizes, capacity):
    """(size, bin) of every item, from the runs."""
    runs, bins = sharding.best_fit_decreasing(sizes, capacity)
    order = [size for size, count in sorted(sizes, reverse=True) for _ in range(count)]
    assert [r[0] for r in runs] == [0, *[r[1] for r in runs[:-1]]][:len(runs)] and (not runs or runs[-1][1] == len(order))
    return [(order[k], bin_ + (k - first) // each) for first, last, bin_, each in runs for k in range(first, last)], bins


def loads(placed):
    load = Counter()
    for size, at in placed:
        load[at] += size
    return load


def test_the_tree_fits_as_tightly_as_looking_at_all_bins():
    draw = random.Random(1)
    for _ in range(60):
        items = [(draw.choice([0, 1, 5, draw.randint(1, 130)]), k) for k in range(draw.randint(0, 80))]
        placed, bins = places(list(Counter(size for size, _ in items).items()), 100)
        assert len(placed) == len(items) and bins == plain_best_fit(items, 100)
        assert {at for _, at in placed} == set(range(bins))
        alone = {at: size for size, at in placed if size > 100}
        assert all(load <= 100 or load == alone[at] for at, load in loads(placed).items())


def test_many_small_groups_are_packed_like_single_items():
    draw = random.Random(4)
    sizes = list(Counter(min(int(draw.expovariate(0.02)) + 1, 900) for _ in range(100_000)).items())
    placed, bins = places(sizes, 50_000)
    assert len(placed) == 100_000 and bins == plain_best_fit([(s, k) for s, n in sizes for k in range(n)], 50_000)
    assert max(loads(placed).values()) <= 50_000


def test_smallest_capacity_is_near_an_even_share():
    draw = random.Random(2)
    sizes = list(Counter(draw.randint(1, 50) for _ in range(2000)).items())
    even = sum(size * n for size, n in sizes) / 8
    capacity = sharding.smallest_capacity(sizes, 8)
    assert sharding.best_fit_decreasing(sizes, capacity)[1] <= 8 and capacity < 1.01 * even


def test_a_group_stays_together_and_fixed_capacity_is_kept(spark):
    rows = spark.range(3000).select((F.col("id") % 700).alias("key"), F.lit(10).alias("size"), F.lit("own").alias("shard_name"))
    got = sharding.assign(rows, "key", "size", capacity=1000)
    assert got.groupBy("key").agg(F.countDistinct("shard").alias("n")).filter("n > 1").count() == 0
    load = [r[1] for r in got.groupBy("shard").agg(F.sum("size")).collect()]
    assert max(load) <= 1000 and len(load) <= 31 and "shard_name" in got.columns


def test_a_hundred_thousand_groups_fall_into_the_bins_of_best_fit(spark):
    rows = spark.range(100_000).select(F.col("id").alias("key"), (F.col("id") % 90 + 1).alias("size"))
    got = sharding.assign(rows, "key", "size", shards=8).groupBy("shard").agg(F.sum("size").alias("load")).collect()
    sizes = [(r[0], r[1]) for r in rows.groupBy("size").count().collect()]
    placed, bins = places(sizes, sharding.smallest_capacity(sizes, 8))
    assert sorted(r["load"] for r in got) == sorted(loads(placed).values()) and len(got) == bins == 8
    assert max(r["load"] for r in got) < 1.001 * sum(r["load"] for r in got) / 8


def test_columns_stay_whatever_their_names(spark):
    rows = spark.range(30).select((F.col("id") % 7).alias("k"), F.lit(3).alias("w"))
    for name in ("key", "size", "own_0", "OWN_1", "rank", "spot", "first", "bin", "_unit", "_key", "a b", "shard"):
        rows = rows.withColumn(name, F.col("k"))
    got = sharding.assign(rows, "k", "w", capacity=15)
    assert [c for c in got.columns if c != "shard"] == [c for c in rows.columns if c != "shard"] and got.count() == 30
    assert sharding.assign(rows.filter("false"), "k", "w", shards=3).count() == 0


def test_numbers_have_no_gaps_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 50)
    rows = spark.range(1000).select("id", (F.col("id") % 3).cast("int").alias("shard"))
    got = sharding.numbered(rows.union(rows.limit(5)), ["id"]).collect()
    for shard in range(3):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_nulls_copies_empty_tables_and_extra_columns(spark):
    rows = [(1, None), (2, ""), (None, "a"), (3, "copy"), (3, "copy"), (4, "copy"), (5, "é" * 30_000)] + [(k, f"t{k}") for k in range(6, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("shard", F.lit("own")).withColumn("size", F.lit(1))
    got = sharding.shard_documents(docs, 4).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["size"] == 16 and by[1][0]["text_crc32"] == 0 and by[5][0]["size"] == 60_016
    assert by[1][0]["shard"] == by[2][0]["shard"]
    assert len({r["shard"] for k in (3, 4) for r in by[k]}) == 1
    assert Counter(r["shard"] for r in got)[by[5][0]["shard"]] == 1  # larger than a share, so alone
    for shard in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert sharding.shard_documents(docs.filter("false"), 4).count() == 0
