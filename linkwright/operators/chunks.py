"""Rows and documents as text chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.functions.text import MAX_WORDS, chunk_starts, chunk_texts, flatten_row, sentences

CHUNK = ["chunk_id", "node_id", "node_type", "text"]


def row_chunks(rows: DataFrame, node_type: str, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One chunk per row, all its columns as one text. The id is a hash of the content."""
    node = F.col(key).cast("string")
    text = flatten_row(rows, columns)
    return rows.select(
        F.sha2(F.concat_ws("|", F.lit(node_type), node, text), 256).alias("chunk_id"),
        node.alias("node_id"), F.lit(node_type).alias("node_type"), text.alias("text"),
    )


def document_chunks(
    rows: DataFrame, key: str, text: str, node_type: str = "Confluence", max_words: int = MAX_WORDS
) -> DataFrame:
    """Whole sentences packed into chunks of at most ``max_words`` words; ids ``{key}_chunk_{n}``.

    A sentence over the limit stays whole. An empty text gives one empty chunk.
    """
    split = rows.select(F.col(key).cast("string").alias("node_id"), sentences(F.col(text)).alias("_parts"))
    bounds = split.withColumn("_starts", chunk_starts(F.col("_parts"), max_words))
    texts = bounds.select("node_id", F.posexplode(chunk_texts(F.col("_parts"), F.col("_starts"))).alias("_n", "text"))
    return texts.select(
        F.concat("node_id", F.lit("_chunk_"), F.col("_n").cast("string")).alias("chunk_id"),
        "node_id", F.lit(node_type).alias("node_type"), "text", F.col("_n").cast("bigint").alias("ordinal"),
    )
