import os

import pytest
from pyspark.sql import functions as F

from bindings import star
from linkwright.functions import fixed_text as fixed
from linkwright.operators import context
from linkwright.operators.embed import echo_model
from linkwright.plans import retrieval
from linkwright.session import shared_folder
from tests.conftest import rows

VERTICES = [("I1", "JIRA", {"t": "login bug"}), ("I2", "JIRA", {}), ("C1", "CR", {"t": "Login work"}), ("P1", "Confluence", {"t": "login notes"})]
EDGES = [("I1", "MENTIONS", "C1"), ("I1", "MENTIONS", "C1"), ("I2", "MENTIONS", "C1"), ("P1", "REFERS_TO", "I1")]
REQUESTS = [("a", "I1", "C1", "login"), ("b", "", "C1", None), ("c", None, None, "login"), ("d", None, "", None), ("e", "I9", None, None)]


@pytest.fixture(scope="module")
def graph(spark):
    labels = {v[0]: v[1] for v in VERTICES}
    vertices = spark.createDataFrame(VERTICES, "id string, label string, props map<string,string>")
    edges = spark.createDataFrame([(*e, labels[e[0]], labels[e[2]], "t", str(i)) for i, e in enumerate(EDGES)],
                                  "src string, label string, dst string, src_label string, dst_label string, src_table string, row_no string")
    return vertices, edges


def block(key):
    label, props = next((v[1], v[2]) for v in VERTICES if v[0] == key)
    return f"id: {key}\nlabel: {label}\n" + "".join(f"{k}: {v}\n" for k, v in sorted(props.items())) + "\n---\n"


def paths(start, heads):
    out = []
    for i, (s, label, d) in enumerate(EDGES):
        mark = f"id: {s}/{label}/{d}/t/{i}\nlabel: {label}\n\n---\n"
        out += [(label, "out", d, i, mark)] if s == start else []
        out += [(label, "in", s, i, mark)] if d == start else []
    return "".join(heads + mark + block(o) for _, _, o, _, mark in sorted(out))


def contexts(requests, graph, **options):
    found = {}
    for r in sorted(context.graph_context(requests, *graph, ["t"], **options).collect(), key=lambda r: r["part_no"]):
        found.setdefault(r["request_id"], []).append(r["context"])
    return found


def test_request_contexts(spark, graph):
    requests = spark.createDataFrame(REQUESTS, "request_id string, jira_id string, cr_id string, keyword string")
    got = {k: "".join(v) for k, v in contexts(requests, graph, sections=()).items()}
    assert got["a"] == paths("I1", block("I1"))
    assert got["b"].count("id: C1\n") == 7 + 5 and got["b"].startswith(block("C1") + block("I1"))
    assert got["c"] == paths("I1", block("I1")) + paths("P1", block("P1"))
    assert got["d"] == fixed.NO_INPUT and got["e"] == ""


def test_two_hop_context_counts_every_parallel_path(spark, graph):
    requests = spark.createDataFrame([("b", None, "C1", None)], "request_id string, jira_id string, cr_id string, keyword string")
    text = "".join(contexts(requests, graph, sections=())["b"])
    # I1 is reached over two parallel edges and has three incident edges; I2 over one, with one.
    assert text.count("label: MENTIONS\n") + text.count("label: REFERS_TO\n") == 2 * 3 + 1


def test_long_keyword_lists_give_the_same_matches(spark, graph):
    words = ["login", "Login", "bug", "n", "no", "notes", "login bug", "x", "work", "lo"]
    keywords = spark.createDataFrame([(w,) for w in words], "keyword string")
    short = rows(context.keyword_matches(graph[0], keywords, ["t"]))
    assert rows(context.keyword_matches(graph[0], keywords, ["t"], listed=2)) == short
    assert ("login", "P1") in short and ("login", "C1") not in short and ("n", "I1") in short


def test_node_context_of_bare_and_hub_nodes(spark, graph):
    nodes = spark.createDataFrame([("C1",), ("Z",)], "node_id string")
    got = {r["node_id"]: r["context"] for r in context.node_context(nodes, graph[1]).collect()}
    assert got["C1"] == "--- Related to node C1 ---\nMENTIONS → JIRA [I1]\nMENTIONS → JIRA [I1]\nMENTIONS → JIRA [I2]"
    assert got["Z"] == "--- Related to node Z ---"
    parts = sorted((r["part_no"], r["context"]) for r in context.node_context(nodes, graph[1], part_bytes=30).collect() if r["node_id"] == "C1")
    assert len(parts) > 1 and "\n".join(text for _, text in parts) == got["C1"]


@pytest.mark.parametrize("wave_bytes", [300, 10**9])
@pytest.mark.parametrize("part_bytes", [70, 200, 4_000_000])
def test_node_context_in_waves(spark, part_bytes, wave_bytes):
    """Parallel edges, hubs cut in parts and nodes asked for twice, in one wave or several; hops are not stored."""
    found = [("H", f"I{n % 9}", "M") for n in range(30)] + [(f"I{n}", "H", "R") for n in range(4)] + [("I1", "I1", "S")]
    edges = spark.createDataFrame([(s, kind, d, "L", "Größe", "t", str(n)) for n, (s, d, kind) in enumerate(found)],
                                  "src string, label string, dst string, src_label string, dst_label string, src_table string, row_no string")
    asked = ["H", "H", "I1", "I2", "I3", "I3", "bare", None]
    nodes = spark.createDataFrame([(n,) for n in asked], "node_id string")
    want = []
    for node in dict.fromkeys(asked):
        lines = [f"--- Related to node {node} ---"] if node else []
        lines += sorted([f"{kind} → Größe [{d}]" for s, d, kind in found if s == node] + [f"{kind} → L [{s}]" for s, d, kind in found if d == node])
        lines = [line for line in lines for _ in range(asked.count(node))]
        parts, at = {}, 0
        for line in lines:
            parts.setdefault(at // part_bytes, []).append(line)
            at += len(line.encode()) + 1
        want += [(node, k, "\n".join(part)) for k, part in parts.items()] or [(node, 0, None)]
    stored = set(os.listdir(shared_folder(spark)))
    got = context.node_context(nodes, edges, part_bytes, wave_bytes)
    assert got.columns == ["node_id", "part_no", "context"]
    assert rows(got) == sorted(want, key=lambda r: tuple((v is not None, str(v)) for v in r))
    new = [name.rsplit("-", 1)[0] for name in set(os.listdir(shared_folder(spark))) - stored]
    assert "hops" not in new and (new.count("texts") > 1) == (wave_bytes == 300 and part_bytes > 70)


DUMP = ("\n=== Global Jira Data ===\n" + block("I1") + block("I2") + "\n=== Global CR Data ===\n" + block("C1")
        + "\n=== Global Confluence Data ===\n" + block("P1"))


@pytest.mark.parametrize("part_bytes", [40, 4_000_000])
def test_global_context(spark, graph, part_bytes):
    parts = context.global_context(graph[0], part_bytes=part_bytes).orderBy("section_no", "part_no").collect()
    assert "".join(r["text"] for r in parts) == DUMP


@pytest.mark.parametrize("part_bytes", [60, 4_000_000])
def test_a_context_ends_with_the_dump_however_it_is_cut(spark, graph, part_bytes):
    requests = spark.createDataFrame([*REQUESTS, ("f", "I1", None, "x")], "request_id string, jira_id string, cr_id string, keyword string")
    got = {k: "".join(v) for k, v in contexts(requests, graph, part_bytes=part_bytes).items()}
    assert got["a"] == got["f"] == paths("I1", block("I1")) + DUMP
    assert got["e"] == DUMP and got["d"] == fixed.NO_INPUT


def test_one_answer_per_request(spark, graph):
    requests = spark.createDataFrame(REQUESTS, "request_id string, jira_id string, cr_id string, keyword string")
    plain = retrieval.answer_requests(requests, *graph, ["t"], lambda texts: texts, sections=()).collect()
    of = {r["request_id"]: r["answer"] for r in plain}
    assert of["d"] == fixed.SERVICE_PROMPT.format(context=fixed.NO_INPUT, question="Give me details about None").strip()
    assert "Give me details about C1" in of["b"] and all(r["n_parts"] == 1 for r in plain)
    cut = {r["request_id"]: r for r in retrieval.answer_requests(
        requests, *graph, ["t"], lambda texts: ["<" + str(len(t)) + ">" if "details" not in t[:40] else t for t in texts], part_bytes=50).collect()}
    assert len(cut) == len(REQUESTS) and cut["a"]["n_parts"] > 3 and cut["d"]["n_parts"] == 1
    seen = []
    for r in sorted(context.graph_context(requests, *graph, ["t"], part_bytes=50).filter("request_id = 'a'").collect(), key=lambda r: r["part_no"]):
        seen.append(echo_model([fixed.SERVICE_PROMPT.format(context=r["context"], question="Give me details about I1")])[0])
    last = echo_model([fixed.SERVICE_PROMPT.format(context="\n\n".join(seen), question="Give me details about I1")])[0]
    echoed = retrieval.answer_requests(requests, *graph, ["t"], echo_model, part_bytes=50).filter("request_id = 'a'").first()
    assert echoed["answer"] == last


def test_vector_hits_get_graph_context(spark, graph):
    chunks = spark.createDataFrame([("k1", "I1", "JIRA", "one", [1.0, 0.0]), ("k2", "P1", "Confluence", "two", [0.0, 1.0])],
                                   "chunk_id string, node_id string, node_type string, text string, embedding array<float>")
    queries = spark.createDataFrame([("q", [1.0, 0.1], "why?")], "query_id string, embedding array<float>, question string")
    got = retrieval.vector_graph_context(queries, chunks, graph[1], k=1, dims=2).first()
    assert (got["node_id"], got["rank"], got["part_no"], got["preview"]) == ("I1", 1, 0, "one...")
    assert got["metadata"] == {"node_id": "I1", "node_type": "JIRA"}
    assert got["prompt"] == fixed.SHORT_PROMPT.format(question="why?", context=(
        "\n### Context for JIRA I1:\none\n\n--- Related to node I1 ---\nMENTIONS → CR [C1]\nMENTIONS → CR [C1]\nREFERS_TO → Confluence [P1]"))


def test_page_summaries_keep_the_error_as_text(spark):
    def broken(texts):
        if "bad" in texts[0]:
            raise RuntimeError("no model")
        return [" fine \n"]
    pages = spark.createDataFrame([("a", "good"), ("b", "bad")], "id string, doc_topic string")
    assert rows(retrieval.page_summaries(pages, broken), "id", "doc_content") == [("a", "fine"), ("b", "AI error: no model")]


def test_long_keyword_lists_meet_few_texts_and_hashes_change_no_path(spark, monkeypatch):
    number = F.lpad(F.col("id").cast("string"), 9, "0")
    vertices = spark.range(4000).select(F.concat(F.lit("v"), "id").alias("id"), F.lit("CR").alias("label"),
                                        F.create_map(F.lit("t"), F.concat(F.lit("Customer#"), number)).alias("props"))
    keywords = spark.range(0, 4000, 7).select(F.concat(F.lit("#"), number).alias("keyword"))
    found = context.keyword_matches(vertices, keywords, ["t"])
    assert rows(found) == sorted((f"#{n:09d}", f"v{n}") for n in range(0, 4000, 7))
    grams = [r["g"] for r in keywords.select(F.explode(context._grams(F.col("keyword"), [context.GRAM])).alias("g")).collect()]
    assert max(map(len, grams)) == 8
    edges = spark.createDataFrame([("I1", "MENTIONS", "v7", "JIRA", "CR", "t", "1"), ("I2", "MENTIONS", "v8", "JIRA", "CR", "t", "2")],
                                  "src string, label string, dst string, src_label string, dst_label string, src_table string, row_no string")
    routes = spark.createDataFrame([("change", "v7"), ("issue", "I2"), ("keyword", "#000000008")], "route string, value string")
    sent = rows(context.route_hops(routes, vertices, edges, ["t"]))
    monkeypatch.setattr(context, "MAX_SENT_STARTS", 0)
    assert len(sent) == 3 and rows(context.route_hops(routes, vertices, edges, ["t"])) == sent


@pytest.mark.parametrize("part_bytes", [40, 4_000_000])
def test_the_dump_reads_every_vertex_once(spark, graph, part_bytes):
    seen = spark.sparkContext.accumulator(0)

    def look(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    vertices = graph[0].mapInArrow(look, graph[0].schema)
    parts = context.global_context(vertices, part_bytes=part_bytes).orderBy("section_no", "part_no").collect()
    assert "".join(r["text"] for r in parts) == DUMP and seen.value == graph[0].count()


def test_the_dump_loads_no_edge(spark, monkeypatch):
    made = {"star_vertices": 0, "star_edges": 0}

    def counted(name):
        def make(spark, folder):
            made[name] += 1
            return spark.createDataFrame([("PAGE-1", "Confluence", {"doc_topic": "a"})], "id string, label string, props map<string,string>")
        return make

    for name in made:
        monkeypatch.setattr(star, name, counted(name))
    monkeypatch.setattr(star, "_stored", {})
    parts = star.global_context(spark, "/no/folder").collect()
    assert made == {"star_vertices": 1, "star_edges": 0}
    assert any("doc_topic: a" in r["text"] for r in parts)
