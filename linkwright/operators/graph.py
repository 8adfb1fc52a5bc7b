"""Property graph as two tables, and the traversals over them.

vertices(id, label, props map) and edges(src, label, dst, src_label, dst_label, src_table, row_no).
An edge carries the labels of its ends, so a traversal that shows no properties never reads the
vertex table. Parallel edges are kept unless ``distinct_edges`` is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.functions.text import contains_any, one_line, split_list, team_id
from linkwright.functions.values import map_lines, property_map
from linkwright.operators.skew import first_row, MAX_LISTED_KEYS
from linkwright.session import shuffles_freed, written

EDGE = ["src", "label", "dst"]

#: Pairs of one key that a task makes, about.
PAIRS = 2_000_000


# --- build --------------------------------------------------------------------------------------

def team_vertices(*names: tuple[DataFrame, str]) -> DataFrame:
    """One Team vertex per distinct non-null name over all given columns."""
    columns = [rows.select(F.col(c).alias("team_name")) for rows, c in names]
    every = reduce(DataFrame.unionByName, columns).filter(F.col("team_name").isNotNull()).distinct()
    return every.select(
        team_id(F.col("team_name")).alias("id"), F.lit("Team").alias("label"),
        F.create_map(F.lit("team_name"), F.col("team_name")).alias("props"),
    )


def entity_vertices(
    rows: DataFrame, label: str, key: str, order: Sequence[str],
    columns: Sequence[str] | None = None, null_text: str | None = None,
) -> DataFrame:
    """One vertex per key, its properties taken from the first row in order.

    An empty order says that the key is unique already.
    """
    columns = list(columns or [c for c in rows.columns if c not in order or c == key])
    picked = rows.filter(F.col(key).isNotNull()).select(*dict.fromkeys([key, *columns, *order]))
    return (first_row(picked, [key], order) if order else picked).select(
        F.col(key).alias("id"), F.lit(label).alias("label"), property_map(columns, null_text).alias("props"),
    )


def link_edges(
    rows: DataFrame, src: str, label: str | Column, dst: str | Column, ends: tuple[str, str | None], table: str, row_no: str
) -> DataFrame:
    """One edge per row whose source, label and target are set. ``ends`` names the labels of both ends."""
    label = F.lit(label) if isinstance(label, str) else label
    dst = F.col(dst) if isinstance(dst, str) else dst
    edges = rows.select(
        F.col(src).alias("src"), label.alias("label"), dst.alias("dst"),
        F.lit(ends[0]).cast("string").alias("src_label"), F.lit(ends[1]).cast("string").alias("dst_label"),
        F.lit(table).alias("src_table"), F.col(row_no).cast("string").alias("row_no"),
    )
    return edges.filter(F.col("src").isNotNull() & F.col("label").isNotNull() & F.col("dst").isNotNull())


@dataclass(frozen=True)
class Link:
    """How a column of a row names a target: edge label, target text, and whether it is a ``;`` list."""

    label: str | Column
    target: str
    many: bool = False
    target_label: str | None = None
    as_team: bool = False


def row_edges(rows: DataFrame, src: str, src_label: str, links: Sequence[Link], table: str, row_no: str) -> DataFrame:
    """All links of a row as edges, in one scan of the rows."""
    def ends(link: Link) -> Column:
        label = F.lit(link.label) if isinstance(link.label, str) else link.label

        def edge(dst: Column) -> Column:
            return F.struct(label.alias("label"), dst.alias("dst"), F.lit(link.target_label).cast("string").alias("dst_label"))

        if not link.many:
            return F.array(edge(team_id(F.col(link.target)) if link.as_team else F.col(link.target)))
        return F.transform(F.coalesce(split_list(F.col(link.target)), F.array().cast("array<string>")), edge)
    every = F.concat(*[ends(link) for link in links])
    edges = rows.select(
        F.col(src).alias("src"), F.lit(src_label).alias("src_label"), F.lit(table).alias("src_table"),
        F.col(row_no).cast("string").alias("row_no"), F.inline(every))
    whole = F.col("src").isNotNull() & F.col("label").isNotNull() & F.col("dst").isNotNull()
    return edges.filter(whole).select(*EDGE, "src_label", "dst_label", "src_table", "row_no")


def team_link(team: str) -> Link:
    """The edge of a row to its team, made in the same scan as its other links."""
    return Link("BELONGS_TO", team, target_label="Team", as_team=True)


def distinct_edges(edges: DataFrame) -> DataFrame:
    """One edge per (src, label, dst), with the smallest lineage; combined map-side."""
    rest = ["src_label", "dst_label", "src_table", "row_no"]
    return edges.groupBy(*EDGE).agg(F.min(F.struct(*rest)).alias("_first")).select(*EDGE, *[f"_first.{c}" for c in rest])


def with_target(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges whose target exists, with the target's label; edges that come with a target's label are taken as they are.

    One join; hub targets are split by skew handling.
    """
    known = vertices.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
    columns = [F.coalesce("dst_label", "_label").alias("dst_label") if c == "dst_label" else F.col(c) for c in edges.columns]
    # an edge that needs no lookup gets a key of its own that no id has, so such edges do not gather in one task
    lookup = F.when(F.col("dst_label").isNull(), F.col("dst")).otherwise(F.concat(F.lit("\0"), F.col("src")))
    found = edges.join(known, lookup == F.col("_id"), "left").filter(F.col("dst_label").isNotNull() | F.col("_id").isNotNull())
    return found.select(*columns)


def with_counted_target(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """As ``with_target``, without a shuffle of whole edges: only the distinct targets meet the vertices, in a job of its own.

    Targets of the edges with one label and source label mostly have one label too. That one is given to all of them, except to
    those that are listed: missing targets, ids of several vertices and other labels. A list that is too long to broadcast
    goes the way of ``with_target``.
    """
    kind, known = ["src_label", "label"], vertices.select(F.col("id").alias("_id"), F.struct(F.col("label").alias("l")).alias("_of"))
    targets = edges.filter(F.col("dst_label").isNull()).select(*kind, "dst").distinct()
    found = written(targets.join(known, F.col("dst") == F.col("_id"), "left").groupBy(*kind, "dst").agg(
        F.collect_list("_of").alias("_ends")), "targets")
    single = found.filter(F.size("_ends") == 1).groupBy(*kind, "_ends").agg(F.count(F.lit(1)).alias("_n"))
    usual = written(single.groupBy(*kind).agg(F.max_by("_ends", F.struct("_n", "_ends")).alias("_usual")), "usual")

    def alike(rows: DataFrame, other: DataFrame, names: Sequence[str], how: str) -> DataFrame:
        marked = other.withColumnsRenamed({c: f"_at_{c}" for c in names})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in names])
        return rows.join(marked, same, how).drop(*[f"_at_{c}" for c in names])

    others = alike(found, usual, kind, "left").filter(~F.col("_ends").eqNullSafe(F.col("_usual"))).drop("_usual")
    others = written(others.withColumn("_open", F.lit(True)), "other_targets")
    if others.limit(MAX_LISTED_KEYS + 1).count() > MAX_LISTED_KEYS or usual.limit(MAX_LISTED_KEYS + 1).count() > MAX_LISTED_KEYS:
        return with_target(edges, vertices)
    met = alike(alike(edges, F.broadcast(usual), kind, "left"), F.broadcast(others), [*kind, "dst"], "left")
    own = F.array(F.struct(F.col("dst_label").alias("l")))
    ends = F.when(F.col("dst_label").isNotNull(), own).when(F.col("_open"), F.col("_ends")).otherwise(F.col("_usual"))
    spread = met.withColumn("_end", F.explode(ends))
    return spread.select(*[F.col("_end.l").alias(c) if c == "dst_label" else F.col(c) for c in edges.columns])


def dangling(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges with a missing end, with the name of that end."""
    ids = vertices.select(F.col("id").alias("_id"))
    return reduce(DataFrame.unionByName, [
        edges.join(ids, F.col(end) == F.col("_id"), "left_anti").withColumn("missing_end", F.lit(end))
        for end in ("src", "dst")
    ])


def build_graph(
    changes: DataFrame, issues: DataFrame, pages: DataFrame, row_no: str = "row_no",
    null_text: str | None = None, parallel: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The four vertex labels and all edges from the raw tables.

    A source end always exists, because its vertex comes from the same row; so does a team. Only
    the targets of cross-table links are checked.
    """
    vertices = reduce(DataFrame.unionByName, [
        team_vertices((changes, "CR_Team_Assignment_Group"), (issues, "JIRA_Team"),
                      (pages, "Confluence_Team_Association")),
        entity_vertices(changes, "CR", "CR_ID", [row_no], null_text=null_text),
        entity_vertices(issues, "JIRA", "JIRA_ID", [row_no], null_text=null_text),
        entity_vertices(pages, "Confluence", "Confluence_ID", [row_no], null_text=null_text),
    ])
    links = reduce(DataFrame.unionByName, [
        row_edges(changes, "CR_ID", "CR", [
            team_link("CR_Team_Assignment_Group"), Link("REFERS_TO", "Linked_Jira_ID"), Link("REFERS_TO", "Linked_Confluence_ID"),
        ], "CR_Main", row_no),
        row_edges(issues, "JIRA_ID", "JIRA", [
            team_link("JIRA_Team"), Link("MENTIONS", "CR_ID_Link_From_CSV_Example"),
            Link(F.col("JIRA_Link_Type"), "JIRA_Linked_Issue_ID_Target"),
        ], "JIRA_Issues_Detailed", row_no),
        row_edges(pages, "Confluence_ID", "Confluence", [
            team_link("Confluence_Team_Association"), Link("REFERS_TO", "Confluence_Linked_Jira_ID", many=True),
            Link("REFERS_TO", "Confluence_Linked_CR_ID", many=True),
        ], "Confluence_Pages_Detailed", row_no),
    ])
    edges = with_target(links, vertices)
    return vertices, edges if parallel else distinct_edges(edges)


def build_simple_graph(
    changes: DataFrame, issues: DataFrame, enriched: DataFrame, pages: DataFrame, null_keys_match: bool = True
) -> tuple[DataFrame, DataFrame]:
    """First-generation graph: three labels, fixed property lists, one edge per pair.

    Page keys are restored by a left join on the page id. A page's vertex names the smallest issue of its change, found
    before the join, so no page is fanned out over the issues of its change; its edges go to all of them. With
    ``null_keys_match`` a page without a change belongs to the issues without one: that pairs all of them.
    """
    def same(left: str, right: str) -> Column:
        return F.col(left).eqNullSafe(F.col(right)) if null_keys_match else F.col(left) == F.col(right)

    keyed = enriched.join(pages.select("confluence_doc_id", "cr_id"), "confluence_doc_id", "left")
    first = issues.groupBy(F.col("cr_id").alias("_cr")).agg(F.min("jira_id").alias("jira_id"))
    named = keyed.join(first, same("cr_id", "_cr"), "left").drop("_cr")

    def text(column: str) -> Column:
        return one_line(F.coalesce(F.col(column), F.lit("None"))).alias(column)

    def link(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit("")).alias(column)

    issue_rows = issues.select("jira_id", text("jira_summary"), link("cr_id"))
    page_rows = named.select("confluence_doc_id", text("doc_topic"), text("doc_content"), link("jira_id"), link("cr_id"))
    change_rows = changes.select("cr_id", text("cr_title"), *[
        F.coalesce(F.col(c), F.lit("None")).alias(c)
        for c in ("cr_status", "created_at", "updated_by_user", "team_name")])
    vertices = reduce(DataFrame.unionByName, [
        entity_vertices(issue_rows, "Jira", "jira_id", ["jira_summary", "cr_id"], ["jira_summary", "cr_id"]),
        entity_vertices(page_rows, "Confluence", "confluence_doc_id", ["jira_id", "cr_id", "doc_topic", "doc_content"],
                        ["doc_topic", "doc_content", "jira_id", "cr_id"]),
        entity_vertices(change_rows, "CR", "cr_id", ["created_at", "cr_status", "cr_title"],
                        ["cr_title", "cr_status", "created_at", "updated_by_user", "team_name"]),
    ])
    none = F.lit(None).cast("string")
    issues_to_changes = link_edges(issues.withColumn("_row", none), "jira_id", "MENTIONS", "cr_id",
                                   ("Jira", None), "JIRA_Issues", "_row")
    # Edges ask for the ids of the vertices only, which need no first row. Targets are looked up per issue, before an issue
    # meets its pages, and a page of one change meets an issue once.
    ids = reduce(DataFrame.unionByName, [
        rows.select(F.col(key).alias("id")).filter(F.col("id").isNotNull()).distinct().withColumn("label", F.lit(label))
        for rows, key, label in ((issues, "jira_id", "Jira"), (enriched, "confluence_doc_id", "Confluence"), (changes, "cr_id", "CR"))])
    known = ids.select(F.col("id").alias("jira_id"), F.col("label").alias("_label"))
    ends = issues.select("jira_id", F.col("cr_id").alias("_cr")).repartition("jira_id").distinct().join(known, "jira_id")
    starts = keyed.select("confluence_doc_id", "cr_id").filter(F.col("confluence_doc_id").isNotNull()).distinct().withColumn(
        "_changes", F.count(F.lit(1)).over(Window.partitionBy("confluence_doc_id")))
    pairs = dealt_pairs(starts, ends, "cr_id", "_cr", "confluence_doc_id", null_keys_match)
    shown = [F.col("confluence_doc_id").alias("src"), F.lit("REFERS_TO").alias("label"), F.col("jira_id").alias("dst"),
             F.lit("Confluence").alias("src_label"), F.col("_label").alias("dst_label"),
             F.lit("Confluence_Enriched").alias("src_table"), none.alias("row_no")]
    to_changes = with_target(distinct_edges(issues_to_changes), ids)
    once, again = (pairs.filter(which).select(*shown) for which in ("_changes = 1", "_changes > 1"))
    return vertices, to_changes.unionByName(once).unionByName(again.distinct())


def dealt_pairs(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread: str, null_keys_match: bool, most: int = PAIRS
) -> DataFrame:
    """The inner join of two frames on one key each, where a key may have very many pairs although its rows are few.

    Skew handling goes by bytes read and does not see that. So both sides of a key with more than ``most`` pairs are cut into
    slices, and every slice of one side meets every slice of the other, about that many pairs at a time.
    Columns of both sides are kept and must differ in name.
    """
    dealt, copied = dealt_sides(left, right, left_key, right_key, spread, null_keys_match, most)
    return dealt.join(copied, _same(left_key, right_key, null_keys_match) & (F.col("_slice") == F.col("_of"))).drop("_slice", "_of")


def dealt_sides(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, spread: str, null_keys_match: bool, most: int
) -> tuple[DataFrame, DataFrame]:
    """Both sides of ``dealt_pairs``, copied to the blocks of pairs that they are in (``_slice``, ``_of``).

    The numbers of slices are in the proportion of the rows, so blocks are about square: the copies of n and m rows grow with the root
    of n times m times the number of blocks. Left rows are sliced by a hash of the column ``spread``, right rows by all of theirs.
    The list of large keys is sent to all tasks: it has at most a row per ``most`` pairs of the result.
    """
    def counted(rows: DataFrame, key: str, out: str) -> DataFrame:
        return rows.groupBy(F.col(key).alias(f"_key{out}")).agg(F.count(F.lit(1)).alias(out))

    n, m, one = F.col("_n").cast("double"), F.col("_m").cast("double"), F.lit(1).cast("bigint")
    blocks = F.ceil(n * m / most)
    large = counted(left, left_key, "_n").join(counted(right, right_key, "_m"), _same("_key_n", "_key_m", null_keys_match)).filter(
        n * m > most).select(
        F.col("_key_n").alias("_large"), F.least(F.ceil(F.sqrt(blocks * n / m)), F.col("_n")).cast("bigint").alias("_rows"), "_m", blocks.alias("_blocks"))
    large = F.broadcast(large.select(
        "_large", "_rows", F.least(F.ceil(F.col("_blocks") / F.col("_rows")), F.col("_m")).cast("bigint").alias("_columns")))
    rows, columns = F.coalesce("_rows", one), F.coalesce("_columns", one)
    first, at = F.pmod(F.xxhash64(spread), rows) * columns, F.pmod(F.xxhash64(*right.columns), columns)
    dealt = left.join(large, _same(left_key, "_large", null_keys_match), "left").withColumn(
        "_slice", F.explode(F.sequence(first, first + columns - 1))).drop("_large", "_rows", "_columns")
    copied = right.join(large, _same(right_key, "_large", null_keys_match), "left").withColumn(
        "_of", F.explode(F.sequence(at, at + (rows - 1) * columns, columns))).drop("_large", "_rows", "_columns")
    return dealt, copied


def _same(a: str, b: str, null_keys_match: bool) -> Column:
    return F.col(a).eqNullSafe(F.col(b)) if null_keys_match else F.col(a) == F.col(b)


# --- store --------------------------------------------------------------------------------------

def replace_table(rows: DataFrame, key: str, path: str) -> None:
    """Drop what is stored and write vertices (``key`` id) or edges (``key`` src), partitioned by label.

    Every task writes a file per label that it holds; rows are not shuffled for it. Sorted files let a lookup by id skip most of
    their row groups. A stored graph is kept, so it is compressed well.
    """
    with shuffles_freed(rows.sparkSession):
        rows.sortWithinPartitions("label", key).write.mode("overwrite").option("compression", "zstd").partitionBy("label").parquet(path)


def replace_graph(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    """Drop a stored graph and write both tables."""
    replace_table(vertices, "id", f"{path}/vertices")
    replace_table(edges, "src", f"{path}/edges")


def absent_vertices(batch: DataFrame, stored: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """The vertices of a batch to insert: first per id, and only where the id is not stored."""
    known = stored.select(F.col("id").alias("_id"))
    fresh = batch.join(known, F.col("id") == F.col("_id"), "left_anti")
    return first_row(fresh, ["id"], order)


def absent_edges(batch: DataFrame, stored: DataFrame) -> DataFrame:
    """The edges of a batch to insert: distinct, and only where (src, label, dst) is not stored."""
    return distinct_edges(batch).join(stored.select(*EDGE), EDGE, "left_anti")


def append_absent(batch: DataFrame, path: str, order: Sequence[str | Column] | None = None) -> None:
    """Insert-if-absent of vertices into a stored graph.

    Of several candidates for an id the first in ``order`` is stored; by default that of the smallest label and properties.
    """
    stored = batch.sparkSession.read.parquet(f"{path}/vertices")
    absent_vertices(batch, stored, list(order or ["label", map_lines(F.col("props"))])).write.mode("append").partitionBy("label").parquet(f"{path}/vertices")


def append_absent_edges(batch: DataFrame, path: str) -> None:
    stored = batch.sparkSession.read.parquet(f"{path}/edges")
    absent_edges(batch, stored).write.mode("append").partitionBy("label").parquet(f"{path}/edges")


# --- read ---------------------------------------------------------------------------------------

def graph_counts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Row counts by kind and label."""
    def counted(rows: DataFrame, kind: str) -> DataFrame:
        return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "label", "n")
    return counted(vertices, "vertex").unionByName(counted(edges, "edge"))


def incident(edges: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Every edge from both of its ends, in one scan; a self-loop shows twice. ``labels`` keeps the ends at such vertices."""
    def end(node: str, direction: str, other: str) -> Column:
        return F.struct(F.col(node).alias("node"), F.col(f"{node}_label").alias("_node_label"), F.lit(direction).alias("direction"),
                        F.col(other).alias("other_id"), F.col(f"{other}_label").alias("other_label"))
    ends = F.array(end("src", "out", "dst"), end("dst", "in", "src"))
    if labels is not None:
        ends = F.filter(ends, lambda e: e["_node_label"].isin(*labels))
    return edges.select(F.col("label").alias("edge_label"), "src_table", "row_no", F.inline(ends)).drop("_node_label")


def neighborhood(seeds: DataFrame, edges: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """One hop in both directions from the seed ids (column ``seed_id``, more columns are kept).

    ``labels`` says that all seeds that are vertices have one of these labels; other ends are then not shuffled.
    """
    return incident(edges, labels).join(seeds, F.col("node") == F.col("seed_id")).drop("node")


def back_along(seeds: DataFrame, edges: DataFrame, through: str) -> DataFrame:
    """The sources (``via_id``) of the ``through`` edges into each seed, one row per parallel edge."""
    back = edges.filter(F.col("label") == through).select(F.col("src").alias("via_id"), F.col("dst").alias("_seed"))
    return back.join(seeds, F.col("_seed") == F.col("seed_id")).drop("_seed")


def two_hop(seeds: DataFrame, edges: DataFrame, through: str = "MENTIONS", labels: Sequence[str] | None = None) -> DataFrame:
    """From each seed back along ``through`` edges, then one hop in both directions.

    Every parallel ``through`` edge gives its own paths. The middle vertex is ``via_id``; ``labels`` says what labels middle
    vertices have, as in ``neighborhood``.
    """
    middle = back_along(seeds, edges, through)
    return incident(edges, labels).join(middle, F.col("node") == F.col("via_id")).drop("node")


def keyword_seeds(vertices: DataFrame, keyword: str, properties: Sequence[str]) -> DataFrame:
    """Ids of the vertices with the keyword in one of the named properties."""
    values = [F.col("props")[p] for p in properties]
    return vertices.filter(contains_any(values, F.lit(keyword))).select(F.col("id").alias("seed_id"))
