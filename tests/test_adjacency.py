import pytest

from linkwright.operators import adjacency, graph
from tests.conftest import rows

EDGES = "src string, label string, dst string, src_label string, dst_label string, src_table string, row_no string"


def edge(src, label, dst, n):
    return (src, label, dst, "L", "L", "T", str(n))


@pytest.fixture(scope="module")
def edges(spark):
    found = [edge(f"n{i}", "MENTIONS", "hub", i) for i in range(300)] + [edge(f"n{i}", "X", f"n{i % 7}", i) for i in range(300)]
    return spark.createDataFrame([*found, edge("n1", "MENTIONS", "n1", 1), edge("n1", "MENTIONS", "n1", 2)], EDGES)


@pytest.fixture(scope="module")
def stored(spark, edges, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("adjacency"))
    return adjacency.store_adjacency(edges, "adjacent_edges", path, 8, slice_edges=20), path


def seeds(spark):
    return spark.createDataFrame([("hub", 1), ("n1", 2), ("n1", 3), ("none", 4), (None, 5)], "seed_id string, mark int")


def test_hops_equal_the_unbucketed_ones(spark, edges, stored):
    names = ["mark", "seed_id", "direction", "edge_label", "other_id", "other_label", "src_table", "row_no"]
    assert rows(adjacency.neighborhood(seeds(spark), stored[0]), *names) == rows(graph.neighborhood(seeds(spark), edges), *names)
    got, want = adjacency.two_hop(seeds(spark), stored[0]), graph.two_hop(seeds(spark), edges)
    assert rows(got, "via_id", *names) == rows(want, "via_id", *names) and got.count() > 900


def test_a_hub_is_cut_into_slices(spark, stored):
    hub = stored[0].ends(spark).filter("node = 'hub'").groupBy("slice").count().collect()
    assert len(hub) == 15 and max(r["count"] for r in hub) < 60
    assert rows(stored[0].ends(spark).filter("node = 'n200'").select("slice").distinct()) == [(0,)]


def test_no_edge_is_shuffled(spark, stored):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = adjacency.two_hop(seeds(spark), stored[0])._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    scans = [i for i, line in enumerate(plan) if "FileScan" in line and "adjacent_edges" in line]
    assert len(scans) == 2
    for scan in scans:
        join = max(j for j in range(scan) if "SortMergeJoin" in plan[j] and _holds(plan, j, scan))
        assert not any("Exchange" in plan[j] and _holds(plan, j, scan) for j in range(join, scan))


def _holds(plan, at, leaf):
    """Whether the node in line ``at`` is an ancestor of that in line ``leaf``: no line between them is indented as little."""
    def depth(line):
        return len(line) - len(line.lstrip(" :+-*"))
    return all(depth(line) > depth(plan[at]) for line in plan[at + 1:leaf + 1])


def test_another_session_attaches_the_stored_table(spark, edges, stored):
    again = adjacency.attach(spark, "attached_edges", stored[1], 8)
    assert rows(again.ends(spark)) == rows(stored[0].ends(spark))


def test_no_edges(spark, edges, tmp_path):
    empty = adjacency.store_adjacency(edges.limit(0), "no_edges", str(tmp_path), 4)
    assert adjacency.two_hop(seeds(spark), empty).count() == 0
