"""Approximate cosine search over product-quantised lists.

A unit vector is cut into parts, and each part is stored as the number of its nearest code vector: one byte a part. A
query makes a table of its dot products with all code vectors; the score of a stored vector is then a sum of table
entries. Only lists near the query are read, only bytes are read from them, and the best candidates are scored exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwright.functions.vectors import cosine, has_dims
from linkwright.operators.search import SCORE_DIGITS, TOP_K, build_lists, nearest_lists, read_index, write_index
from linkwright.session import written

PARTS, CODES = 16, 256

#: Rows that the code vectors are fitted on, at most (those with the smallest hash of their id), and rounds of k-means.
TRAIN_ROWS, ROUNDS = 20_000, 12

#: Candidates per query that are scored exactly, and bytes of tables that a task holds.
DEPTH, TABLE_BYTES = 100, 64 * 1024 * 1024

ROWS_PER_STEP = 1024


def _units(column: pa.Array, dims: int) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return rows / np.maximum(np.linalg.norm(rows, axis=1), 1e-300)[:, None]


def _nearest(parts: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Number of the nearest code vector of every row."""
    return np.argmin((codes**2).sum(1) - 2 * parts @ codes.T, axis=1)


def _fitted(parts: np.ndarray, codes: int) -> np.ndarray:
    """``codes`` centres of the rows by k-means from evenly drawn rows; fewer different rows are repeated."""
    seen = np.unique(parts, axis=0)
    centres = seen[np.linspace(0, len(seen) - 1, codes).astype(int)]
    for _ in range(ROUNDS if len(seen) > codes else 0):
        of = _nearest(parts, centres)
        count = np.bincount(of, minlength=codes)
        total = np.zeros_like(centres)
        np.add.at(total, of, parts)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def fit_codes(docs: DataFrame, dims: int, id_col: str = "id", vector_col: str = "embedding", parts: int = PARTS,
              codes: int = CODES, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Code vectors (parts, codes, dims / parts), each part fitted by a task of its own on a bounded sample."""
    if dims % parts or not 0 < codes <= 256:
        raise ValueError("the parts must divide the dimensions, and a code must fit a byte")
    width = dims // parts
    usable = has_dims(F.col(vector_col), dims) & F.exists(vector_col, lambda x: x != 0)
    sample = docs.filter(usable).select(id_col, vector_col).orderBy(F.xxhash64(id_col), id_col).limit(train_rows).select(vector_col)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _units(batch.column(0), dims).reshape(-1, parts, width)
            for p in range(parts):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), p, np.int32)), pa.array(list(rows[:, p]), pa.list_(pa.float64()))], ["part", "piece"])

    def fit(table: pa.Table) -> pa.Table:
        rows = table["piece"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        return pa.table({"part": table["part"].slice(0, 1), "codes": pa.array([_fitted(rows, codes).ravel()], pa.list_(pa.float64()))})

    found = (sample.mapInArrow(cut, "part int, piece array<double>").groupBy("part")
             .applyInArrow(fit, "part int, codes array<double>").collect())  # one row per part
    books = np.zeros((parts, codes, width))
    for row in found:
        books[row["part"]] = np.array(row["codes"]).reshape(codes, width)
    return books


def with_codes(listed: DataFrame, books: np.ndarray, vector_col: str = "embedding") -> DataFrame:
    """``listed`` with ``code``: a byte per part. Every row is coded."""
    parts, _, width = books.shape
    at = listed.columns.index(vector_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _units(batch.column(at), parts * width).reshape(-1, parts, width)
            code = np.stack([_nearest(rows[:, p], books[p]) for p in range(parts)], axis=1).astype(np.uint8)
            yield batch.append_column("code", pa.array([c.tobytes() for c in code], pa.binary()))

    return listed.mapInArrow(run, T.StructType([*listed.schema.fields, T.StructField("code", T.BinaryType())]))


def build_index(docs: DataFrame, path: str, n_lists: int, dims: int, id_col: str = "id", **options) -> None:
    """Write the lists with vectors and codes, the centres and the code vectors below ``path``."""
    listed, centres = build_lists(docs, n_lists, dims)
    books = fit_codes(docs, dims, id_col, **options)
    write_index(with_codes(listed, books), centres, path)
    rows = [(p, c, [float(x) for x in books[p, c]]) for p in range(books.shape[0]) for c in range(books.shape[1])]
    docs.sparkSession.createDataFrame(rows, "part int, code int, piece array<double>").write.mode("overwrite").parquet(f"{path}/codes")


def open_index(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(lists, centres, code vectors) of a stored index."""
    listed, centres = read_index(spark, path)
    rows = spark.read.parquet(f"{path}/codes").orderBy("part", "code").collect()
    parts = rows[-1]["part"] + 1
    return listed, centres, np.array([r["piece"] for r in rows]).reshape(parts, len(rows) // parts, -1)


def _candidates(near: DataFrame, asked: list, books: np.ndarray, depth: int, id_col: str, schema: str) -> DataFrame:
    """Per task the ``depth`` best ids of every query by code; ``asked`` are rows (query_id, embedding, lists)."""
    parts, _, width = books.shape
    names = np.array([r["query_id"] for r in asked])
    vectors = np.array([r["embedding"] for r in asked], np.float64)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-300)[:, None]
    of_list: dict[int, list[int]] = {}
    for q, row in enumerate(asked):
        for number in row["lists"]:
            of_list.setdefault(number, []).append(q)
    sent = near.sparkSession.sparkContext.broadcast((names, vectors, {n: np.array(q) for n, q in of_list.items()}, books))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, vectors, of_list, books = sent.value
        tables = np.einsum("qpw,pcw->pqc", vectors.reshape(-1, parts, width), books).astype(np.float32)
        best = np.full((len(names), depth), -np.inf, np.float32)
        found, kind = None, None
        for whole in batches:
            for batch in (whole.slice(k, ROWS_PER_STEP) for k in range(0, whole.num_rows, ROWS_PER_STEP)):
                ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
                if found is None:
                    found, kind = np.empty(best.shape, ids.dtype), batch.column(0).type
                codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, parts)
                for number in np.unique(lists):
                    asking, rows = of_list.get(int(number)), np.flatnonzero(lists == number)
                    if asking is None:
                        continue
                    scores = sum(tables[p][asking][:, codes[rows, p]] for p in range(parts))
                    scores = np.concatenate([best[asking], scores], axis=1)
                    names_of = np.concatenate([found[asking], np.broadcast_to(ids[rows], (len(asking), len(rows)))], axis=1)
                    top = np.argpartition(-scores, depth - 1, axis=1)[:, :depth]
                    best[asking], found[asking] = np.take_along_axis(scores, top, 1), np.take_along_axis(names_of, top, 1)
        if found is not None:
            q, k = np.nonzero(best > -np.inf)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[q].tolist()), pa.array(found[q, k], kind), pa.array(best[q, k].astype(np.float64))],
                ["query_id", "id", "score"])

    return near.select(id_col, "list_id", "code").mapInArrow(scan, schema)


def pq_topk(queries: DataFrame, listed: DataFrame, centres: np.ndarray, books: np.ndarray, probes: int, k: int = TOP_K,
            id_col: str = "id", depth: int = DEPTH) -> DataFrame:
    """The k best documents per query among its ``probes`` nearest lists: (query_id, id, score, rank), scores exact.

    The ``depth`` best by code in each query's lists are scored exactly; ties go to the smaller id. Queries of another length
    or of zeros have no hits. Queries are taken in blocks whose tables a task can hold; the codes stream past a block.
    ``id_col`` must be unique.
    """
    dims = books.shape[0] * books.shape[2]
    usable = has_dims(F.col("embedding"), dims) & F.exists("embedding", lambda x: x != 0)
    asked = written(nearest_lists(queries.filter(usable).select("query_id", "embedding"), centres, probes), "asked")
    limit = max(1, TABLE_BYTES // (4 * books.shape[0] * books.shape[1]))
    blocks = max(1, -(-2 * asked.count() // limit))
    kinds = dict(asked.dtypes)["query_id"], dict(listed.dtypes)[id_col]
    schema = f"query_id {kinds[0]}, id {kinds[1]}, score double"
    found = [queries.sparkSession.createDataFrame([], schema)]
    for n in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == n).collect()  # at most about ``limit``
        if rows:
            probed = sorted({number for r in rows for number in r["lists"]})
            found.append(_candidates(listed.filter(F.col("list_id").isin(probed)), rows, books, depth, id_col, schema))
    by_code = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    near = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(by_code)).filter(F.col("rank") <= depth)
    near = written(near.select("query_id", "id"), "candidates")
    vectors = listed.select(F.col(id_col).alias("id"), F.col("embedding").alias("stored"))
    exact = near.join(vectors, "id").join(asked.select("query_id", "embedding"), "query_id").select(
        "query_id", "id", F.round(cosine(F.col("embedding"), F.col("stored")), SCORE_DIGITS).alias("score"))
    return exact.withColumn("rank", F.row_number().over(by_code)).filter(F.col("rank") <= k)
