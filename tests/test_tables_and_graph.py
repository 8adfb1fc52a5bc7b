"""A small set of raw CSV tables with one defect of each kind, loaded into tables and a graph."""

import pytest
from pyspark.sql import functions as F

from linkwright.operators import graph
from linkwright.operators.validate import duplicate_keys, orphans, placeholder_parents
from linkwright.plans import graph_load
from linkwright.plans.retrieval import table_chunks
from linkwright.sources import csv_tables
from linkwright.sources.schemas import ACTIVITIES, CHANGES, ISSUES, PAGES, RAW, TASKS
from tests.conftest import rows


def line(columns, **values):
    def cell(text):
        return '"' + text.replace('"', '""') + '"' if any(c in text for c in ',"\n') else text
    return ",".join(cell(values.get(c, "")) for c in columns)


def issue(key, **more):
    return line(ISSUES, JIRA_ID=key, JIRA_Team="Red Team", JIRA_Title=more.pop("title", key), **more)


FILES = {
    "JIRA_Issues_Detailed": (ISSUES, [
        issue("I1", title="first", JIRA_Linked_Issue_ID_Target="I2", JIRA_Link_Type="blocks", CR_ID_Link_From_CSV_Example="C1",
              JIRA_Components="API;;Core", JIRA_Created_Date="2023-01-02", JIRA_Confidence="80", JIRA_Effort_Story_Points="0.5"),
        issue("I1", title="second", JIRA_Watcher_User="ann"),
        issue("I2", JIRA_Linked_Issue_ID_Target="I2", JIRA_Link_Type="relates to"),
        issue("I3", JIRA_Linked_Issue_ID_Target="I1", JIRA_Created_Date="soon", JIRA_Confidence=" "),
        issue("I4", JIRA_Linked_Issue_ID_Target="I9", JIRA_Link_Type="blocks"),
        "I5,short",
    ]),
    "CR_Main": (CHANGES, [
        line(CHANGES, CR_ID="C1", CR_State="New", CR_Title='say "hi", all', Linked_Jira_ID="I1", CR_Team_Assignment_Group="Blue",
             CR_Created_At_From_CSV_Example="2023-01-01"),
        line(CHANGES, CR_ID="C1", CR_State="Closed", CR_Title="later", Linked_Jira_ID="I1", Linked_Confluence_ID="P1",
             CR_Team_Assignment_Group="Blue", CR_Created_At_From_CSV_Example="2023-02-01"),
        line(CHANGES, CR_ID="C2", CR_State="New", CR_Team_Assignment_Group="Red Team"),
        line(CHANGES, CR_ID="C3", CR_Team_Assignment_Group="Phantom") + ",extra",
    ]),
    "Confluence_Pages_Detailed": (PAGES, [
        line(PAGES, Confluence_ID="P1", Confluence_Team_Association="Blue", Confluence_Content_Summary="two\nlines",
             Confluence_Linked_Jira_ID="I1;I2;;I1", Confluence_Linked_CR_ID="C2;C9"),
        line(PAGES, Confluence_ID="P2"),
    ]),
    "JIRA_Activities": (ACTIVITIES, [line(ACTIVITIES, Activity_ID="A1", JIRA_ID="I7", Activity_Timestamp="2023-01-02 10:30")]),
    "CR_CTasks": (TASKS, [line(TASKS, CTASK_ID="T1", CR_ID="C1", CTASK_Start_Time="2023-01-02 09:00")]),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    for name, (columns, lines) in FILES.items():
        (root / name).mkdir()
        (root / name / "data.csv").write_text("\n".join([",".join(columns), *lines]) + "\n")
    return str(root)


@pytest.fixture(scope="module")
def loaded(spark, folder, tmp_path_factory):
    vertices, edges = graph_load.load_graph(spark, folder, str(tmp_path_factory.mktemp("graph")))
    return vertices, edges


def test_malformed_rows_are_set_aside(spark, folder):
    bad = {t: graph_load.malformed_rows(spark, folder, t).count() for t in graph_load.TABLES}
    assert bad == {"JIRA_Issues_Detailed": 1, "CR_Main": 1, "Confluence_Pages_Detailed": 0, "JIRA_Activities": 0, "CR_CTasks": 0}
    good = graph_load.read_tables(spark, folder)
    assert good["JIRA_Issues_Detailed"].count() == 5 and good["CR_Main"].count() == 3
    assert rows(good["Confluence_Pages_Detailed"], "Confluence_Content_Summary") == [(None,), ("two\nlines",)]
    assert ('say "hi", all',) in rows(good["CR_Main"], "CR_Title")


def test_single_line_reading_breaks_the_quoted_line(spark, folder):
    path = f"{folder}/Confluence_Pages_Detailed"
    good, bad = csv_tables.quarantine(csv_tables.read_raw(spark, path, "Confluence_Pages_Detailed", multi_line=False))
    assert (good.count(), bad.count()) == (1, 2)


def test_row_numbers_follow_the_file(spark, folder):
    read = graph_load.read_tables(spark, folder)["JIRA_Issues_Detailed"].orderBy("row_no")
    assert [r["JIRA_Title"] for r in read.collect()][:2] == ["first", "second"]


def test_csv_export_reads_back(spark, folder, tmp_path):
    table = graph_load.read_tables(spark, folder)["CR_Main"].drop("row_no")
    csv_tables.write_csv(table, str(tmp_path / "CR_Main"))
    assert rows(csv_tables.read_table(spark, str(tmp_path / "CR_Main"), "CR_Main").drop("row_no")) == rows(table)


def test_vertices_take_the_first_row(spark, loaded):
    found = {r["id"]: (r["label"], r["props"]) for r in loaded[0].collect()}
    assert sorted(k for k in found if k.startswith("TEAM-")) == ["TEAM-Blue", "TEAM-Red_Team"]
    assert sorted(k for k in found if not k.startswith("TEAM-")) == ["C1", "C2", "I1", "I2", "I3", "I4", "P1", "P2"]
    assert found["I1"][1]["JIRA_Title"] == "first" and found["C1"][1]["CR_State"] == "New"
    assert "JIRA_Sprint" not in found["I1"][1]


def test_edges_keep_parallels_and_drop_dangling(spark, loaded):
    got = rows(loaded[1], "src", "label", "dst")
    team = [("I1",) * 2, ("I2",), ("I3",), ("I4",)]
    expected = [(i, "BELONGS_TO", "TEAM-Red_Team") for t in team for i in t] + [
        ("C1", "BELONGS_TO", "TEAM-Blue"), ("C1", "BELONGS_TO", "TEAM-Blue"), ("C2", "BELONGS_TO", "TEAM-Red_Team"),
        ("P1", "BELONGS_TO", "TEAM-Blue"), ("C1", "REFERS_TO", "I1"), ("C1", "REFERS_TO", "I1"), ("C1", "REFERS_TO", "P1"),
        ("I1", "MENTIONS", "C1"), ("I1", "blocks", "I2"), ("I2", "relates to", "I2"),
        ("P1", "REFERS_TO", "I1"), ("P1", "REFERS_TO", "I2"), ("P1", "REFERS_TO", "I1"), ("P1", "REFERS_TO", "C2")]
    assert got == sorted(expected)
    labels = {r["id"]: r["label"] for r in loaded[0].collect()}
    assert all(labels[r["src"]] == r["src_label"] and labels[r["dst"]] == r["dst_label"] for r in loaded[1].collect())


def test_distinct_edges_are_the_set_of_the_parallel_ones(spark, folder, loaded):
    t = graph_load.read_tables(spark, folder)
    _, single = graph.build_graph(t["CR_Main"], t["JIRA_Issues_Detailed"], t["Confluence_Pages_Detailed"], parallel=False)
    assert rows(single, "src", "label", "dst") == sorted(set(rows(loaded[1], "src", "label", "dst")))


def test_null_text_option(spark, folder):
    t = graph_load.read_tables(spark, folder)
    vertices, _ = graph.build_graph(t["CR_Main"], t["JIRA_Issues_Detailed"], t["Confluence_Pages_Detailed"], null_text="None")
    assert vertices.filter("id = 'I1'").first()["props"]["JIRA_Sprint"] == "None"


def test_dangling_report(spark, loaded):
    bad = graph.link_edges(spark.createDataFrame([("I1", "nowhere", "1"), ("lost", "I1", "2")], "s string, d string, n string"),
                           "s", "REFERS_TO", "d", ("JIRA", None), "x", "n")
    assert rows(graph.dangling(bad, loaded[0]), "src", "dst", "missing_end") == [("I1", "nowhere", "dst"), ("lost", "I1", "src")]
    assert graph.with_target(bad, loaded[0]).count() == 1


def test_traversals(spark, loaded):
    vertices, edges = loaded
    seed = spark.createDataFrame([("I2",)], "seed_id string")
    assert rows(graph.neighborhood(seed, edges), "direction", "edge_label", "other_id") == [
        ("in", "REFERS_TO", "P1"), ("in", "blocks", "I1"), ("in", "relates to", "I2"),
        ("out", "BELONGS_TO", "TEAM-Red_Team"), ("out", "relates to", "I2")]
    hops = graph.two_hop(spark.createDataFrame([("C1",)], "seed_id string"), edges)
    assert {r["via_id"] for r in hops.collect()} == {"I1"} and hops.count() == 8
    assert rows(graph.keyword_seeds(vertices, "say", ["CR_Title", "JIRA_Title"])) == [("C1",)]
    assert rows(graph.keyword_seeds(vertices, "Say", ["CR_Title", "JIRA_Title"])) == []
    counts = {(r["kind"], r["label"]): r["n"] for r in graph.graph_counts(vertices, edges).collect()}
    assert counts["vertex", "JIRA"] == 4 and counts["edge", "BELONGS_TO"] == 9


def test_insert_if_absent(spark, loaded, tmp_path):
    vertices, edges = loaded
    path = str(tmp_path / "g")
    graph.replace_graph(vertices, edges, path)
    batch = spark.createDataFrame([("I1", "JIRA", {"a": "new"}), ("N1", "CR", {"a": "1"}), ("N1", "CR", {"a": "2"})], "id string, label string, props map<string,string>")
    graph.append_absent(batch, path)
    stored = spark.read.parquet(f"{path}/vertices")
    assert stored.count() == vertices.count() + 1 and stored.filter("id = 'I1'").first()["props"]["JIRA_Title"] == "first"
    again = edges.filter("src = 'C1'").unionByName(edges.filter("src = 'C2'").withColumn("dst", F.lit("TEAM-Blue")))
    graph.append_absent_edges(again, path)
    assert spark.read.parquet(f"{path}/edges").count() == edges.count() + 1


def test_normal_tables_load_parents_first(spark, folder, tmp_path):
    normal = graph_load.normal_tables(graph_load.read_tables(spark, folder))
    issues = {r["JIRA_ID"]: r for r in normal["JiraIssues"].collect()}
    assert sorted(issues) == ["I1", "I2", "I3", "I4", "I7", "I9"]
    assert issues["I7"]["JIRA_Title"] == "Placeholder for I7"
    assert (str(issues["I1"]["JIRA_Created_Date"]), issues["I1"]["JIRA_Confidence"], str(issues["I1"]["JIRA_Effort_Story_Points"])) == ("2023-01-02", 80, "0.5")
    assert issues["I3"]["JIRA_Created_Date"] is None and issues["I3"]["JIRA_Confidence"] is None
    assert rows(normal["JiraIssueComponents"], "JIRA_ID", "ordinal", "value") == [("I1", 1, "API"), ("I1", 2, "Core")]
    assert rows(normal["ChangeRequestMaster"], "CR_ID", "CR_State") == [("C1", "Closed"), ("C2", "New")]
    assert normal["ChangeRequests"].count() == 3
    assert rows(normal["JiraIssueWatchers"]) == [("I1", "ann")]
    graph_load.write_tables(spark, normal, str(tmp_path / "out"))
    assert str(spark.read.parquet(str(tmp_path / "out" / "CR_CTasks")).first()["CTASK_Start_Time"]) == "2023-01-02 09:00:00"


def test_missing_parent_stops_the_load(spark, folder, tmp_path):
    normal = graph_load.normal_tables(graph_load.read_tables(spark, folder))
    normal["JiraIssues"] = normal["JiraIssues"].filter("JIRA_ID <> 'I7'")
    with pytest.raises(ValueError, match="I7"):
        graph_load.write_tables(spark, normal, str(tmp_path / "out"))


def test_key_checks(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1, "one")], "k int, title string")
    assert rows(duplicate_keys(child.filter("k IS NOT NULL"), ["k"])) == [(2, 2)]
    assert rows(orphans(child, "k", parent, "k")) == [(2,), (2,)]
    assert rows(placeholder_parents(child, "k", parent, "k", "title")) == [(1, "one"), (2, "Placeholder for 2")]


def test_all_rows_become_chunks(spark, folder):
    chunks = table_chunks(graph_load.read_tables(spark, folder), RAW)
    assert chunks.count() == 5 + 3 + 2 + 1 + 1
    assert rows(chunks.filter("node_type = 'CTASK'"), "node_id", "text") == [("T1", "CTASK_ID: T1 | CR_ID: C1 | CTASK_Start_Time: 2023-01-02 09:00")]


def test_first_generation_graph(spark):
    changes = spark.createDataFrame([("C1", "T\n1", "Open", "d", "u", None)], "cr_id string, cr_title string, cr_status string, created_at string, updated_by_user string, team_name string")
    issues = spark.createDataFrame([("J1", "s1", "C1"), ("J2", "s2", "C1"), ("J3", "s3", None)], "jira_id string, jira_summary string, cr_id string")
    enriched = spark.createDataFrame([("P1", "topic", "text"), ("P2", "other", None)], "confluence_doc_id string, doc_topic string, doc_content string")
    pages = spark.createDataFrame([("P1", "C1"), ("P2", None)], "confluence_doc_id string, cr_id string")
    vertices, edges = graph.build_simple_graph(changes, issues, enriched, pages)
    found = {r["id"]: r["props"] for r in vertices.collect()}
    assert sorted(found) == ["C1", "J1", "J2", "J3", "P1", "P2"]
    assert found["C1"]["cr_title"] == "T 1" and found["C1"]["team_name"] == "None" and found["J3"]["cr_id"] == ""
    assert found["P2"]["jira_id"] == "J3" and found["P2"]["doc_content"] == "None"
    assert rows(edges, "src", "label", "dst") == [
        ("J1", "MENTIONS", "C1"), ("J2", "MENTIONS", "C1"), ("P1", "REFERS_TO", "J1"), ("P1", "REFERS_TO", "J2"), ("P2", "REFERS_TO", "J3")]


def test_simple_graph_deals_out_the_pairs_of_one_change(spark):
    """Issues and pages without a change pair all with all, by many tasks; a pair that comes by two changes is one edge."""
    left = spark.range(300).select(F.lit(None).cast("string").alias("a"), F.concat(F.lit("P"), "id").alias("p")).unionByName(
        spark.createDataFrame([("x", "P1"), ("y", "P1"), ("z", "P2")], "a string, p string"))
    right = spark.range(200).select(F.lit(None).cast("string").alias("b"), F.concat(F.lit("I"), "id").alias("i")).unionByName(
        spark.createDataFrame([("x", "I1"), ("y", "I1"), ("q", "I2")], "b string, i string"))
    plain = left.join(right, F.col("a").eqNullSafe(F.col("b")))
    for most in (1_000, 10**9):
        assert rows(graph.dealt_pairs(left, right, "a", "b", "p", True, most), "p", "i") == rows(plain, "p", "i")
        assert graph.dealt_pairs(left, right, "a", "b", "p", False, most).count() == 2
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dealt = graph.dealt_pairs(left, right, "a", "b", "p", True, 1_000).filter("a IS NULL")
        assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 60_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    changes = spark.createDataFrame([("C1", "t", "s", "1", "u", "n"), ("C2", "t", "s", "1", "u", "n")],
                                    "cr_id string, cr_title string, cr_status string, created_at string, updated_by_user string, team_name string")
    issues = spark.createDataFrame([("J1", "a", "C1"), ("J1", "a", "C2"), ("J2", "b", None)], "jira_id string, jira_summary string, cr_id string")
    enriched = spark.createDataFrame([("P1", "d", "c"), ("P2", "d", "c")], "confluence_doc_id string, doc_topic string, doc_content string")
    pages = spark.createDataFrame([("P1", "C1"), ("P1", "C2"), ("P2", None)], "confluence_doc_id string, cr_id string")
    _, edges = graph.build_simple_graph(changes, issues, enriched, pages)
    assert rows(edges.filter("label = 'REFERS_TO'"), "src", "dst", "dst_label") == [("P1", "J1", "Jira"), ("P2", "J2", "Jira")]


def test_copies_of_a_large_key_grow_with_the_root_of_its_pairs(spark):
    """Both sides of a key are sliced; a side that goes whole to every slice of the other is copied as a square."""
    left = spark.range(3_000).select(F.lit(None).cast("string").alias("a"), F.concat(F.lit("P"), "id").alias("p"))
    right = spark.range(1_000).select(F.lit(None).cast("string").alias("b"), F.concat(F.lit("I"), "id").alias("i"))
    dealt, copied = graph.dealt_sides(left, right, "a", "b", "p", True, 1_000)
    assert dealt.count() + copied.count() < 4 * (3_000_000 * 3_000) ** 0.5
    assert dealt.groupBy("_slice").count().join(copied.groupBy(F.col("_of").alias("_slice")).agg(F.count("*").alias("n")), "_slice").agg(
        F.max(F.col("count") * F.col("n"))).first()[0] < 10_000
    pairs = graph.dealt_pairs(left, right, "a", "b", "p", True, 1_000)
    assert pairs.count() == pairs.distinct().count() == 3_000_000
    few = right.limit(3)
    for one, two, keys in ((left, few, ("a", "b")), (few, left, ("b", "a"))):
        assert graph.dealt_pairs(one, two, *keys, one.columns[1], True, 10).distinct().count() == 9_000


def test_counted_targets_are_those_of_the_join(spark, monkeypatch):
    """Missing ids, ids of two vertices, a rare label and null labels; no whole edge is shuffled for the usual ones."""
    schema = "src string, label string, dst string, src_label string, dst_label string, src_table string, row_no string"
    edges = spark.createDataFrame(
        [(f"I{n}", "M", f"C{n % 7}", "JIRA", None, "t", str(n)) for n in range(40)] + [
            ("I1", "M", "gone", "JIRA", None, "t", "a"), ("I2", "M", "two", "JIRA", None, "t", "b"), ("I3", "M", "page", None, None, "t", "c"),
            ("I3", "M", "page", "JIRA", None, "t", "c"), ("I3", "M", "page", "JIRA", None, "t", "c"), ("I4", "B", "any", "JIRA", "Team", "t", "d"),
            ("I5", "M", "bare", "JIRA", None, "t", "e"), ("I6", "M", None, "JIRA", None, "t", "f"), ("I7", "M", None, "JIRA", "CR", "t", "g")], schema)
    vertices = spark.createDataFrame([(f"C{n}", "CR") for n in range(7)] + [
        ("two", "CR"), ("two", "JIRA"), ("two", "CR"), ("page", "Confluence"), ("bare", None), (None, "CR")], "id string, label string")
    want = rows(graph.with_target(edges, vertices))
    got = graph.with_counted_target(edges, vertices)
    assert got.columns == edges.columns and rows(got) == want
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(graph, "MAX_LISTED_KEYS", 1)
    assert rows(graph.with_counted_target(edges, vertices)) == want
    none = edges.filter("dst_label IS NOT NULL")
    assert rows(graph.with_counted_target(none, vertices)) == rows(graph.with_target(none, vertices))


def test_hops_leave_out_ends_at_other_labels(spark, loaded):
    _, edges = loaded
    seeds = spark.createDataFrame([("C1",), ("C2",), ("none",)], "seed_id string")
    assert graph.incident(edges, ["CR"]).count() < graph.incident(edges).count()
    assert rows(graph.neighborhood(seeds, edges, ["CR"])) == rows(graph.neighborhood(seeds, edges))
    assert rows(graph.two_hop(seeds, edges, labels=["JIRA"])) == rows(graph.two_hop(seeds, edges))
