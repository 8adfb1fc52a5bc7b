"""Text contexts from graph neighbourhoods, for many nodes or many requests at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.functions.fixed_text import GLOBAL_SECTIONS, NO_INPUT, NODE_HEADER, NODE_LINE, RECORD_END, render
from linkwright.functions.text import contains_any
from linkwright.functions.values import map_lines
from linkwright.operators.graph import back_along, incident
from linkwright.operators.skew import MAX_LISTED_KEYS, PART_BYTES, repeated_parts, text_parts
from linkwright.session import shuffles_freed, written

MAX_LISTED_KEYWORDS = 64

#: Characters by which keywords meet texts. Fewer are shared by a fixed share of the texts, whose candidates grow as a square.
GRAM = 8

#: Starting points, by number, whose hashes are sent to the edges.
MAX_SENT_STARTS = 2_000_000

#: Bytes of the texts of nodes, without hubs, that are in shuffle files at a time; about a third of it there.
WAVE_BYTES = 6_000_000_000

ASKED = ["request_id", "jira_id", "cr_id", "keyword"]


def node_context(
    nodes: DataFrame, edges: DataFrame, part_bytes: int = PART_BYTES, wave_bytes: int = WAVE_BYTES
) -> DataFrame:
    """Header and one line per incident edge for each distinct ``node_id``: (node_id, part_no, context).

    Lines are in text order, that is by edge label first. The text of a hub comes in several parts that, joined by line
    breaks in the order of ``part_no``, are the whole text.

    Lines and headers meet in one shuffle by node, without a join before it; what has no header was not asked for. Texts of more
    than ``wave_bytes`` together are made and stored in waves, by a hash of the node, so that no more than a wave is in
    shuffle files at a time. The lines of hubs are counted, as parallel edges give equal ones, and go by ranges.
    """
    spark = nodes.sparkSession
    asked = written(nodes.select("node_id"), "nodes", "zstd")
    ends = incident(edges).filter(F.col("node").isNotNull())
    hashes = asked.select(F.xxhash64("node_id").alias("_hash")).distinct()
    if hashes.limit(MAX_LISTED_KEYS + 1).count() <= MAX_LISTED_KEYS:
        ends = ends.join(F.broadcast(hashes), F.xxhash64("node") == F.col("_hash"), "left_semi")
    line = render(NODE_LINE, edge=F.col("edge_label"), kind=F.col("other_label"), other=F.col("other_id"))
    lines = ends.select(F.col("node").alias("node_id"), line.alias("line")).filter(F.col("line").isNotNull())
    header = render(NODE_HEADER, node=F.col("node_id"))

    def bytes_of(text: Column) -> Column:
        return (F.octet_length(text) + 1).cast("bigint")

    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    sizes = lines.select("node_id", bytes_of(F.col("line")).alias("_bytes"), zero.alias("_copies")).unionByName(
        asked.select("node_id", zero.alias("_bytes"), one.alias("_copies")))
    sums = sizes.groupBy("node_id").agg(F.sum("_bytes").alias("_bytes"), F.sum("_copies").alias("_copies")).withColumn(
        "_bytes", F.col("_copies") * (F.col("_bytes") + F.coalesce(bytes_of(header), zero)))
    # one row per hub, and one for all other nodes
    hub = F.when(F.col("_bytes") > part_bytes, F.col("node_id"))
    with shuffles_freed(spark):
        found = written(sums.groupBy(hub.alias("_hub")).agg(F.sum("_bytes").alias("_bytes"), F.max("_copies").alias("_copies")), "weights")
    hubs = found.filter(F.col("_hub").isNotNull()).select("_hub", "_copies")
    listed = hubs.limit(MAX_LISTED_KEYS + 1).count()
    known = F.broadcast(hubs) if listed <= MAX_LISTED_KEYS else hubs
    total = found.filter(F.col("_hub").isNull()).agg(F.sum("_bytes")).first()[0] or 0
    at_hub = F.col("node_id") == F.col("_hub")

    def stored(texts: DataFrame) -> DataFrame:
        with shuffles_freed(spark):
            return written(texts, "texts", "zstd")

    def small(rows: DataFrame, other: DataFrame) -> DataFrame:
        meeting = rows.withColumn("_asked", zero).unionByName(other.select("node_id", F.lit(None).cast("string").alias("line"), one.alias("_asked")))
        if listed:
            meeting = meeting.join(known, at_hub, "left_anti")
        texts = meeting.repartition("node_id").groupBy("node_id").agg(
            F.sort_array(F.collect_list("line")).alias("_lines"), F.sum("_asked").cast("int").alias("_copies")).filter("_copies > 0")
        many = F.flatten(F.transform("_lines", lambda each: F.array_repeat(each, F.col("_copies"))))
        text = F.when(F.col("_copies") == 1, F.concat_ws("\n", header, F.col("_lines"))).otherwise(
            F.concat_ws("\n", F.array_repeat(header, F.col("_copies")), many))
        return texts.select("node_id", zero.alias("part_no"), F.when(F.col("node_id").isNotNull(), text).alias("context"))

    def large() -> DataFrame:
        counted = lines.join(known, at_hub).groupBy("node_id", "line").agg((F.count(F.lit(1)) * F.max("_copies")).alias("copies"))
        first = hubs.select(F.col("_hub").alias("node_id"), F.col("_copies").alias("copies")).select(
            "node_id", F.lit(0).alias("below"), header.alias("line"), "copies")
        rows = first.unionByName(counted.select("node_id", F.lit(1).alias("below"), "line", "copies"))
        return repeated_parts(rows, ["node_id"], "line", ["below", "line"], "copies", "context", "\n", part_bytes, "zstd")

    waves = max(1, -(-int(total) // wave_bytes))
    with shuffles_freed(spark):
        of_hubs = large() if listed else None
    if waves == 1:
        texts = small(lines, asked)
        return texts.unionByName(of_hubs) if listed else texts

    def wave(rows: DataFrame, k: int) -> DataFrame:
        return rows.filter(F.coalesce(F.pmod(F.xxhash64("node_id"), F.lit(waves)), zero) == k)

    done = [stored(of_hubs)] if listed else []
    return reduce(DataFrame.unionByName, done + [stored(small(wave(lines, k), wave(asked, k))) for k in range(waves)])


def vertex_block(id: Column, label: Column, props: Column) -> Column:
    """A vertex as ``key: value`` lines and a closing rule."""
    body = map_lines(props)
    return F.concat(F.lit("id: "), id, F.lit("\nlabel: "), label, F.lit("\n"),
                    F.when(body == "", F.lit("")).otherwise(F.concat(body, F.lit("\n"))), F.lit(RECORD_END))


def edge_block(id: Column, label: Column) -> Column:
    return F.concat(F.lit("id: "), id, F.lit("\nlabel: "), label, F.lit("\n" + RECORD_END))


def edge_id(seed: Column) -> Column:
    """An edge's id: its ends, its label and the row that it comes from, as (source, label, target, table, row)."""
    out = F.col("direction") == "out"
    return F.concat_ws("/", F.when(out, seed).otherwise(F.col("other_id")), "edge_label",
                       F.when(out, F.col("other_id")).otherwise(seed), "src_table", "row_no")


def keyword_matches(
    vertices: DataFrame, keywords: DataFrame, properties: Sequence[str], listed: int = MAX_LISTED_KEYWORDS
) -> DataFrame:
    """(keyword, id) for every vertex holding the keyword in one of the named properties.

    Up to ``listed`` distinct keywords are tested in one scan of the vertices. A longer list meets the texts by an equi-join
    on each keyword's rarest ``GRAM`` characters (the whole of a shorter keyword), then the match is checked.
    """
    distinct = keywords.select("keyword").filter(F.col("keyword") != "").distinct()
    found = [r["keyword"] for r in distinct.limit(listed + 1).collect()]
    texts = [F.col("props")[p] for p in properties]
    if not found:
        return vertices.select(F.lit("").alias("keyword"), "id").filter(F.lit(False))
    if len(found) <= listed:
        hits = F.filter(F.array(*[F.lit(k) for k in sorted(found)]), lambda k: contains_any(texts, k))
        return vertices.select(F.explode(hits).alias("keyword"), "id")
    size = F.least(F.char_length("keyword"), F.lit(GRAM))
    sizes = sorted(r["size"] for r in distinct.select(size.alias("size")).distinct().collect())  # at most GRAM
    grams = F.array_distinct(F.flatten(F.array(*[_grams(F.coalesce(t, F.lit("")), sizes) for t in texts])))
    with_text = vertices.filter(F.coalesce(*texts).isNotNull())
    spread = with_text.select("id", F.explode(grams).alias("_gram"))
    own = distinct.select("keyword", size.alias("_size"), F.explode(F.array_distinct(_grams(F.col("keyword"), sizes))).alias("_gram"))
    own = own.filter(F.char_length("_gram") == F.col("_size")).drop("_size")
    used = spread.join(own.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    wanted = own.join(used, "_gram").groupBy("keyword").agg(F.min_by("_gram", F.struct("_n", "_gram")).alias("_gram"))
    near = spread.join(wanted, "_gram").select("id", "keyword")
    return with_text.join(near, "id").filter(contains_any(texts, F.col("keyword"))).select("keyword", "id")


def _grams(text: Column, sizes: Sequence[int]) -> Column:
    """All substrings of the given sizes, with shorter ones at the end of the text."""
    def cut(size: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.char_length(text), F.lit(1)))
        return F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
    return F.concat(*[cut(size) for size in sizes])


def routed(requests: DataFrame) -> DataFrame:
    """Requests with how they are answered (``route``) and for what (``value``); both null without any input.

    An issue id is used before a change id, a change id before a keyword.
    """
    issue, change, word = (F.nullif(c, F.lit("")) for c in ("jira_id", "cr_id", "keyword"))
    route = F.when(issue.isNotNull(), "issue").when(change.isNotNull(), "change").when(word.isNotNull(), "keyword")
    return requests.withColumn("route", route).withColumn("value", F.coalesce(issue, change, word))


def route_hops(
    routes: DataFrame, vertices: DataFrame, edges: DataFrame, properties: Sequence[str], through: str = "MENTIONS"
) -> DataFrame:
    """One row per path of every distinct (route, value): route, value, seed_id, via_id, edge and other end.

    A change goes back along ``through`` edges first. All three kinds meet in a single hop over the edge table. The
    starting points are written first: if they are few, Spark sends them to the edges and shuffles no edge.
    """
    def of(name: str) -> DataFrame:
        return routes.filter(F.col("route") == name)

    found = keyword_matches(vertices, of("keyword").select(F.col("value").alias("keyword")), properties)
    hits = of("keyword").join(found.withColumnsRenamed({"keyword": "value", "id": "seed_id"}), "value")
    direct = of("issue").withColumn("seed_id", F.col("value")).unionByName(hits).withColumn("via_id", F.lit(None).cast("string"))
    behind = back_along(of("change").withColumn("seed_id", F.col("value")), edges, through)
    starts = written(direct.unionByName(behind), "starts")
    ends, at = incident(edges), F.coalesce("via_id", "seed_id")
    # Ends at other nodes are left out before the shuffle by their hash, as long as the hashes of the starting points are few.
    hashes = starts.select(F.xxhash64(at).alias("_hash")).distinct()
    if hashes.count() <= MAX_SENT_STARTS:
        ends = ends.join(F.broadcast(hashes), F.xxhash64("node") == F.col("_hash"), "left_semi")
    return ends.join(starts, F.col("node") == at).drop("node")


def route_context(
    routes: DataFrame, vertices: DataFrame, edges: DataFrame, properties: Sequence[str],
    through: str = "MENTIONS", part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The paths of every distinct (route, value) as text: (route, value, part_no, context).

    One that finds nothing has an empty text. The paths are written once as ids; the blocks of the vertices on them come
    from one vertex scan.
    """
    hops = written(route_hops(routes, vertices, edges, properties, through), "hops")
    ids = hops.select(F.explode(F.array("seed_id", "via_id", "other_id")).alias("id")).filter(F.col("id").isNotNull()).distinct()
    used = vertices.join(written(ids, "ids"), "id")
    blocks = written(used.select("id", vertex_block(F.col("id"), F.col("label"), F.col("props")).alias("block")), "blocks")

    def block(end: str) -> DataFrame:
        return blocks.select(F.col("id").alias(f"{end}_id"), F.col("block").alias(f"{end}_block"))

    edge = edge_block(edge_id(F.coalesce("via_id", "seed_id")), F.col("edge_label"))
    paths = hops.join(block("seed"), "seed_id").join(block("other"), "other_id").join(block("via"), "via_id", "left").withColumn(
        "path_text", F.concat("seed_block", F.coalesce("via_block", F.lit("")), edge, "other_block"))
    # A null line per route keeps those that find nothing; no text is joined afterwards.
    lines = paths.unionByName(routes, allowMissingColumns=True)
    parts = text_parts(
        lines, ["route", "value"], "path_text", ["seed_id", "via_id", "edge_label", "direction", "other_id", "src_table", "row_no"],
        [], "body", sep="", part_bytes=part_bytes)
    return parts.select("route", "value", "part_no", F.coalesce("body", F.lit("")).alias("context"))


def graph_context(
    requests: DataFrame, vertices: DataFrame, edges: DataFrame, properties: Sequence[str], through: str = "MENTIONS",
    part_bytes: int = PART_BYTES, sections: Sequence[tuple[str, str]] = GLOBAL_SECTIONS,
) -> DataFrame:
    """The context of each request as (request columns, part_no, context), in parts that joined in order are the text.

    First the paths of what the request names, built once for equal requests, then the dump of the labels named in
    ``sections`` (heading, label), the same for all. A request without any input gets a fixed message and nothing else. The
    dump is built once and repeated for every request, so give few or no sections to many requests.
    """
    asked = routed(requests.select(*ASKED))
    routes = written(asked.filter(F.col("route").isNotNull()).select("route", "value").distinct(), "routes")
    own = written(route_context(routes, vertices, edges, properties, through, part_bytes), "contexts")
    found = asked.join(own, ["route", "value"])
    if sections:
        shared = written(global_context(vertices, sections, part_bytes), "sections")
        place = shared.select("section_no", "part_no").withColumn(
            "_at", F.row_number().over(Window.orderBy("section_no", "part_no")) - 1)
        shared = shared.join(place, ["section_no", "part_no"]).select("_at", F.col("text").alias("context"))
        last = own.groupBy("route", "value").agg(F.max("part_no").alias("_last"))
        wide = asked.join(last, ["route", "value"]).withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(shared.count() - 1))))
        found = found.select(*ASKED, "part_no", "context").unionByName(
            wide.join(shared, "_at").select(*ASKED, (F.col("_last") + 1 + F.col("_at")).alias("part_no"), "context"))
    none = asked.filter(F.col("route").isNull()).select(
        *ASKED, F.lit(0).cast("bigint").alias("part_no"), F.lit(NO_INPUT).alias("context"))
    return found.select(*ASKED, "part_no", "context").unionByName(none)


def global_context(
    vertices: DataFrame, sections: Sequence[tuple[str, str]] = GLOBAL_SECTIONS, part_bytes: int = PART_BYTES
) -> DataFrame:
    """The dump of whole labels as (section_no, part_no, text); the parts of a section, joined in order, are its text.

    The blocks are made once and stored: they are read to find the large labels, for the bounds of the ranges and to be dealt out.
    """
    spark = vertices.sparkSession
    labels = [label for _, label in sections]
    blocks = vertices.filter(F.col("label").isin(*labels)).select(
        "label", F.lit(1).alias("below"), "id", vertex_block(F.col("id"), F.col("label"), F.col("props")).alias("block"))
    headings = F.broadcast(spark.createDataFrame(
        [(i, heading, label) for i, (heading, label) in enumerate(sections)], "section_no bigint, heading string, label string"))
    first = headings.select("label", F.lit(0).alias("below"), F.lit("").alias("id"), F.col("heading").alias("block"))
    blocks = written(blocks.unionByName(first), "blocks")
    parts = text_parts(blocks, ["label"], "block", ["below", "id"], [], "text", sep="", part_bytes=part_bytes)
    return parts.join(headings, "label").select("section_no", "part_no", "text")
