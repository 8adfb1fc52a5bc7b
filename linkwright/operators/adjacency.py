"""Edges stored from both of their ends, bucketed and sorted by node, so that a hop shuffles only its starting points.

A node with very many edges would fill its bucket alone, and a bucketed side is never split at run time. So its edges are dealt
over slices when the table is stored, the buckets are made of (node, slice), and a starting point asks for all slices of its node.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwright.operators.graph import incident

SLICE_EDGES = 100_000
COLUMNS = ["edge_label", "src_table", "row_no", "direction", "other_id", "other_label"]


@dataclass(frozen=True)
class Adjacency:
    """A stored table (catalog name) of edge ends, and where the slices of its large nodes are listed."""

    table: str
    hubs: str

    def ends(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)

    def slices(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("node string, slices bigint").parquet(self.hubs)


def store_adjacency(edges: DataFrame, table: str, path: str, buckets: int, slice_edges: int = SLICE_EDGES) -> Adjacency:
    """Write both ends of every edge as table ``table`` below ``path``; a self-loop is stored twice, as ``incident`` shows it.

    A node of more than ``slice_edges`` ends is cut into slices of about that many, by a hash of the whole row. Only such
    nodes are listed, at most one for every ``slice_edges`` ends. Below the session's shuffle partitions Spark would shuffle
    the buckets after all, so there are at least as many of them.
    """
    spark = edges.sparkSession
    buckets = max(buckets, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ends = incident(edges)
    large = ends.groupBy("node").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > slice_edges)
    large.select("node", F.ceil(F.col("_n") / slice_edges).alias("slices")).write.mode("overwrite").parquet(f"{path}/hubs")
    stored = Adjacency(table, f"{path}/hubs")
    slices = stored.slices(spark).withColumnRenamed("node", "_node")
    dealt = ends.join(slices, F.col("node") == F.col("_node"), "left").withColumn(
        "slice", F.pmod(F.xxhash64(*COLUMNS), F.coalesce("slices", F.lit(1)))).select("node", "slice", *COLUMNS)
    (dealt.repartition(buckets, "node", "slice").write.mode("overwrite").format("parquet").option("path", f"{path}/ends")
     .bucketBy(buckets, "node", "slice").sortBy("node", "slice").saveAsTable(table))
    return stored


def attach(spark: SparkSession, table: str, path: str, buckets: int) -> Adjacency:
    """Name a stored adjacency in the catalog of another session; ``buckets`` as it was stored."""
    fields = ", ".join(f"`{c}` string" for c in COLUMNS)
    spark.sql(f"""CREATE TABLE IF NOT EXISTS {table} (`node` string, `slice` bigint, {fields}) USING parquet
        CLUSTERED BY (`node`, `slice`) SORTED BY (`node`, `slice`) INTO {buckets} BUCKETS LOCATION '{path}/ends'""")
    return Adjacency(table, f"{path}/hubs")


def hop(starts: DataFrame, at: str, stored: Adjacency) -> DataFrame:
    """Every edge at the node in column ``at`` of each row, with the columns of the row. A null node has none."""
    spark = starts.sparkSession
    slices = stored.slices(spark).withColumnRenamed("node", "_hub")
    asked = starts.join(slices, F.col(at) == F.col("_hub"), "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("slices", F.lit(1)) - 1))).drop("_hub", "slices")
    ends = stored.ends(spark)
    return asked.join(ends, (F.col(at) == F.col("node")) & (F.col("_slice") == F.col("slice"))).drop("node", "slice", "_slice")


def neighborhood(seeds: DataFrame, stored: Adjacency) -> DataFrame:
    """As ``graph.neighborhood``, from the stored ends."""
    return hop(seeds, "seed_id", stored)


def two_hop(seeds: DataFrame, stored: Adjacency, through: str = "MENTIONS") -> DataFrame:
    """As ``graph.two_hop``, from the stored ends; both hops shuffle their starting points and no edge."""
    back = hop(seeds, "seed_id", stored).filter((F.col("direction") == "in") & (F.col("edge_label") == through))
    return hop(back.withColumn("via_id", F.col("other_id")).drop(*COLUMNS), "via_id", stored)
