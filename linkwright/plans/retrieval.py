"""Questions to vector hits to graph context to prompts and answers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.functions import fixed_text as fixed
from linkwright.functions.text import preview
from linkwright.operators.chunks import row_chunks
from linkwright.operators.context import graph_context, node_context
from linkwright.operators.embed import Complete, Embed, completion, embed_rows, embedding
from linkwright.operators.search import TOP_K, cosine_topk
from linkwright.operators.skew import PART_BYTES
from linkwright.session import written

ROW_KINDS = [
    ("CR_Main", "CR", "CR_ID"), ("CR_CTasks", "CTASK", "CTASK_ID"), ("JIRA_Issues_Detailed", "JIRA", "JIRA_ID"),
    ("JIRA_Activities", "ACTIVITY", "Activity_ID"), ("Confluence_Pages_Detailed", "CONFLUENCE", "Confluence_ID"),
]


def table_chunks(tables: dict[str, DataFrame], schemas: dict[str, list[str]]) -> DataFrame:
    """The rows of all five tables as chunks."""
    return reduce(DataFrame.unionByName, [row_chunks(tables[t], kind, key, schemas[t]) for t, kind, key in ROW_KINDS])


def embedded_chunks(chunks: DataFrame, embed: Embed) -> DataFrame:
    return embed_rows(chunks, embed)


def vector_graph_context(
    queries: DataFrame, chunks: DataFrame, edges: DataFrame, k: int = TOP_K, dims: int = 1536, part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The k nearest chunks of each query with their text and graph context, and a prompt.

    ``queries`` has query_id, embedding and question; ``chunks`` has chunk_id, node_id, node_type,
    text and embedding. Only ids and vectors go through the search; texts and graph are met by the
    few hits afterwards. The neighbourhood of a node hit by several queries is built once.
    """
    hits = cosine_topk(queries, chunks, k, dims, id_col="chunk_id")
    return hits_context(hits.withColumnRenamed("id", "chunk_id"), queries, chunks, edges, part_bytes)


def hits_context(
    hits: DataFrame, queries: DataFrame, chunks: DataFrame, edges: DataFrame, part_bytes: int = PART_BYTES
) -> DataFrame:
    """Preview, metadata, graph context and prompt for the rows of a search result.

    The hits are k rows per query; with their texts they are written once, after one scan of the chunks. Spark then knows
    their size, and with few hits the edges are not shuffled.
    """
    few = written(hits, "hits")
    found = written(chunks.select("chunk_id", "node_id", "node_type", "text").join(few, "chunk_id"), "found")
    context = node_context(found.select("node_id").distinct(), edges, part_bytes)
    block = fixed.render(fixed.HIT_BLOCK, kind=F.col("node_type"), node=F.col("node_id"),
                         text=F.coalesce("text", F.lit("")), context=F.col("context"))
    full = found.join(context, "node_id").join(queries.select("query_id", "question"), "query_id")
    return full.select(
        "query_id", "rank", "chunk_id", "node_id", "node_type", "score", preview(F.col("text")).alias("preview"),
        F.create_map(F.lit("node_id"), F.col("node_id"), F.lit("node_type"), F.col("node_type")).alias("metadata"),
        "part_no", "context",
        prompt(block, F.col("question"), fixed.SHORT_PROMPT).alias("prompt"),
    )


def question_graph_context(
    questions: DataFrame, chunks: DataFrame, edges: DataFrame, embed: Embed, k: int = TOP_K, dims: int = 1536,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Text to context in one plan: embed chunks and questions, search, and show what was found.

    ``questions`` has query_id and question; ``chunks`` has chunk_id, node_id, node_type and text. The embedded chunks are
    stored once: that is the index, and it holds the texts as well.
    """
    index = written(embedded_chunks(chunks.select("chunk_id", "node_id", "node_type", "text"), embed), "index")
    asked = written(questions.withColumn("embedding", embedding(F.col("question"), embed)), "questions")
    hits = cosine_topk(asked, index, k, dims, id_col="chunk_id").withColumnRenamed("id", "chunk_id")
    return hits_context(hits, asked, index, edges, part_bytes)


def prompt(context: Column, question: Column, layout: str = fixed.LONG_PROMPT) -> Column:
    return fixed.render(layout, context=context, question=question)


def request_question() -> Column:
    """The standard question for a request: its issue id, else change id, else keyword."""
    subject = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("jira_id", "cr_id", "keyword")], F.lit("None"))
    return fixed.render(fixed.SERVICE_QUESTION, subject=subject)


def answer_requests(
    requests: DataFrame, vertices: DataFrame, edges: DataFrame, properties: Sequence[str], complete: Complete,
    through: str = "MENTIONS", part_bytes: int = PART_BYTES, sections: Sequence[tuple[str, str]] = fixed.GLOBAL_SECTIONS,
) -> DataFrame:
    """One answer per request: (request_id, n_parts, answer).

    A context of one part is answered in one call. A longer one is asked part by part; the answers of the parts, in order,
    are the context of one last call with the same question.
    """
    context = graph_context(requests, vertices, edges, properties, through, part_bytes, sections)
    question = request_question()
    asked = context.select("request_id", "part_no", question.alias("question"),
                           prompt(F.col("context"), question, fixed.SERVICE_PROMPT).alias("prompt"))
    parts = written(asked.select("request_id", "part_no", "question", completion(F.col("prompt"), complete).alias("answer")), "answers")
    ordered = F.expr("listagg(answer, '\\n\\n') WITHIN GROUP (ORDER BY part_no)")
    found = parts.groupBy("request_id", "question").agg(F.count(F.lit(1)).alias("n_parts"), ordered.alias("answer"))
    again = completion(prompt(F.col("answer"), F.col("question"), fixed.SERVICE_PROMPT), complete)
    alone = found.filter("n_parts = 1").select("request_id", "n_parts", "answer")
    return alone.unionByName(found.filter("n_parts > 1").select("request_id", "n_parts", again.alias("answer")))


def page_summaries(pages: DataFrame, complete: Complete, topic: str = "doc_topic", out: str = "doc_content") -> DataFrame:
    """Pages with a model-written column; a failing call leaves its error text."""
    asked = fixed.render(fixed.SUMMARY_PROMPT, topic=F.coalesce(F.col(topic), F.lit("None")))
    return pages.withColumn(out, completion(asked, complete))
