"""Cosine top-k over a table of vectors, exact or over the nearest coarse lists."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkwright.functions.vectors import has_dims
from linkwright.session import written

TOP_K = 5
DIMS = 1536
MAX_QUERY_BYTES = 64 * 1024 * 1024
SCORE_DIGITS = 12
ROWS_PER_STEP = 4096

#: Rows that k-means is trained on, about, and the most that all centres together may take in a task.
TRAIN_ROWS, MAX_CENTRE_BYTES = 1_000_000, 256 * 1024 * 1024


@dataclass
class Questions:
    """A bounded block of unit query vectors; ``scopes`` maps a scope to the rows searching in it."""

    ids: np.ndarray
    matrix: np.ndarray
    scopes: dict | None


def _unit(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.linalg.norm(matrix, axis=1)
    return matrix / np.where(size == 0, 1, size)[:, None], size > 0


def _stack(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    return found.sort_values(["q", "score", "id"], ascending=[True, False, True]).groupby("q", sort=False).head(k)


def _scored(ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray, questions: Questions, k: int) -> pd.DataFrame:
    """The k best rows of one block for the questions in ``rows``, ties by id."""
    unit, usable = _unit(vectors)
    unit, ids = unit[usable], ids[usable]
    scores = np.round(questions.matrix[rows] @ unit.T, SCORE_DIGITS)
    if scores.shape[1] > k:
        floor = np.partition(scores, -k, axis=1)[:, -k]
        at = np.nonzero(scores >= floor[:, None])
    else:
        at = np.nonzero(np.ones_like(scores, dtype=bool))
    return _best(pd.DataFrame({"q": rows[at[0]], "score": scores[at], "id": ids[at[1]]}), k)


def _scan(batches: Iterator[pa.RecordBatch], questions: Questions, k: int, dims: int) -> pd.DataFrame:
    """Running best k per question over the batches of one task: memory is questions x k."""
    best = pd.DataFrame({"q": np.array([], dtype=int), "score": np.array([], dtype=float), "id": []})
    every = np.arange(len(questions.ids))
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_PER_STEP):
            step = batch.slice(at, ROWS_PER_STEP)
            ids = step.column(0).to_pandas().to_numpy()
            vectors = _stack(step.column(1), dims)
            if questions.scopes is None:
                groups = [(slice(None), every)]
            else:
                scope = step.column(2).to_pandas().to_numpy()
                groups = [(scope == s, questions.scopes[s]) for s in pd.unique(scope) if s in questions.scopes]
            found = [_scored(ids[pick], vectors[pick], rows, questions, k) for pick, rows in groups]
            if found:
                best = _best(pd.concat([best, *found]) if len(best) else pd.concat(found), k)
    return best


def _result_schema(docs: DataFrame, queries: DataFrame, id_col: str) -> T.StructType:
    return T.StructType([
        T.StructField("query_id", queries.schema["query_id"].dataType),
        T.StructField("id", docs.schema[id_col].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def _as_batch(best: pd.DataFrame, questions: Questions, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(list(questions.ids[best["q"].to_numpy(dtype=int)]), schema.field(0).type),
        pa.array(list(best["id"]), schema.field(1).type),
        pa.array(best["score"].to_numpy(dtype=float), schema.field(2).type),
    ], schema=schema)


def _questions(rows: pd.DataFrame, dims: int, scoped: bool) -> Questions:
    matrix = np.array([np.asarray(v, dtype=np.float64) for v in rows["embedding"]]).reshape(-1, dims)
    unit, usable = _unit(matrix)
    rows, unit = rows[usable].reset_index(drop=True), unit[usable]
    scopes = None
    if scoped:
        scopes = {}
        for i, wanted in enumerate(rows["scope"]):
            for s in (wanted if isinstance(wanted, (list, np.ndarray)) else [wanted]):
                scopes.setdefault(s, []).append(i)
        scopes = {s: np.array(at) for s, at in scopes.items()}
    return Questions(rows["query_id"].to_numpy(), unit, scopes)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def cosine_topk(
    queries: DataFrame, docs: DataFrame, k: int = TOP_K, dims: int = DIMS, id_col: str = "id",
    vector_col: str = "embedding", scope_col: str | None = None, max_query_bytes: int = MAX_QUERY_BYTES,
) -> DataFrame:
    """Exact k best documents per query: (query_id, id, score, rank); ties go to the smaller id.

    ``queries`` has query_id and embedding, and with ``scope_col`` a ``scope``: the value, or array
    of values, that a document must have in that column to be looked at. Vectors of another length
    and zero vectors are left out.

    A query set within ``max_query_bytes`` is sent to every task once and the documents stream past
    it without a shuffle; only k rows per query and task leave a task. A larger set is cut into
    blocks, and the documents stream past one block after the other.
    """
    spark = docs.sparkSession
    columns = [id_col, vector_col, *([scope_col] if scope_col else [])]
    corpus = docs.filter(has_dims(F.col(vector_col), dims)).select(*columns)
    asked = queries.filter(has_dims(F.col("embedding"), dims)).select(
        "query_id", "embedding", *(["scope"] if scope_col else []))
    schema = _result_schema(docs, queries, id_col)
    limit = max(1, max_query_bytes // (8 * dims))
    rows = asked.limit(limit + 1).toPandas()
    if len(rows) > limit:
        return _ranked(_block_hits(asked, corpus, k, dims, schema, scope_col is not None, limit), k)
    block = _questions(rows, dims, scope_col is not None)
    sent = spark.sparkContext.broadcast((block.ids, block.matrix, block.scopes))
    return _ranked(_task_hits(corpus, sent, k, dims, schema), k)


def _task_hits(corpus: DataFrame, sent, k: int, dims: int, schema: T.StructType) -> DataFrame:
    arrow = _arrow(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Questions(*sent.value)
        best = _scan(batches, block, k, dims)
        if len(best):
            yield _as_batch(best, block, arrow)

    return corpus.mapInArrow(scan, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _block_hits(
    asked: DataFrame, corpus: DataFrame, k: int, dims: int, schema: T.StructType, scoped: bool, limit: int
) -> DataFrame:
    """One pass of the documents per block of at most ``limit`` queries; no document is shuffled or copied."""
    spark = corpus.sparkSession
    stored = written(asked, "asked")
    blocks = max(1, -(-2 * stored.count() // limit))
    number = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    found = []
    for n in range(blocks):
        block = _questions(stored.filter(number == n).toPandas(), dims, scoped)
        if len(block.ids):
            sent = spark.sparkContext.broadcast((block.ids, block.matrix, block.scopes))
            found.append(_task_hits(corpus, sent, k, dims, schema))
    return reduce(DataFrame.unionByName, found)


# --- coarse lists -------------------------------------------------------------------------------

def build_lists(
    docs: DataFrame, n_lists: int, dims: int = DIMS, vector_col: str = "embedding", seed: int = 42,
    max_iter: int = 10, train_rows: int = TRAIN_ROWS,
) -> tuple[DataFrame, np.ndarray]:
    """Assign every vector to its nearest of ``n_lists`` k-means centres: (docs + list_id, centres).

    About ``train_rows`` rows place the centres; every row is assigned. The centres go to all tasks, so there are at most
    as many as MAX_CENTRE_BYTES holds.
    """
    if n_lists * dims * 8 > MAX_CENTRE_BYTES:
        raise ValueError(f"{n_lists} centres of {dims} numbers are more than a task should hold; use fewer lists")
    usable = has_dims(F.col(vector_col), dims) & F.exists(vector_col, lambda x: x != 0)
    good = docs.filter(usable).withColumn("_vector", array_to_vector(F.col(vector_col).cast("array<double>")))
    train, rows = good.select("_vector"), good.count()
    if rows > train_rows:
        train = train.sample(train_rows / rows, seed)
    model = KMeans(k=n_lists, seed=seed, maxIter=max_iter, distanceMeasure="cosine",
                   featuresCol="_vector", predictionCol="list_id").fit(train)
    return model.transform(good).drop("_vector"), np.array(model.clusterCenters())


def write_index(listed: DataFrame, centres: np.ndarray, path: str) -> None:
    """The index: documents partitioned by list, and the centres. A long list is split over many files."""
    spark = listed.sparkSession
    listed.hint("rebalance", "list_id").write.mode("overwrite").partitionBy("list_id").parquet(f"{path}/lists")
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    spark.createDataFrame(rows, "list_id int, centre array<double>").write.mode("overwrite").parquet(f"{path}/centres")


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    centres = spark.read.parquet(f"{path}/centres").orderBy("list_id").collect()
    return spark.read.parquet(f"{path}/lists"), np.array([r["centre"] for r in centres])


def nearest_lists(queries: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """The queries with ``lists``: the numbers of their ``probes`` nearest lists."""
    unit, _ = _unit(centres)
    keep = min(probes, len(unit))
    sent = queries.sparkSession.sparkContext.broadcast(unit)

    @F.pandas_udf("array<int>")
    def pick(vectors: pd.Series) -> pd.Series:
        found = []
        for at in range(0, len(vectors), ROWS_PER_STEP // 16):
            step = np.vstack([np.asarray(v, dtype=np.float64) for v in vectors[at:at + ROWS_PER_STEP // 16]])
            found += list(np.argsort(-(step @ sent.value.T), axis=1, kind="stable")[:, :keep].astype(np.int32))
        return pd.Series(found)

    return queries.withColumn("lists", pick("embedding"))


def ann_topk(
    queries: DataFrame, listed: DataFrame, centres: np.ndarray, probes: int, k: int = TOP_K,
    dims: int = DIMS, id_col: str = "id", scope_col: str | None = None,
) -> DataFrame:
    """The k best documents per query among its nearest lists, with exact scores.

    The probed list numbers cut the index by partition before anything is read; a long list is
    read by many tasks, none of which needs the rest of it. With ``scope_col`` the queries have a ``scope``, the value that
    a document must have in that column (a node id or a node type); documents without it are not scored.
    """
    asked = nearest_lists(queries.filter(has_dims(F.col("embedding"), dims)), centres, probes)
    probed = asked.select(F.explode("lists").alias("list_id")).distinct().collect()  # at most one row per list
    near = listed.filter(F.col("list_id").isin([r["list_id"] for r in probed]))
    if scope_col is None:
        return cosine_topk(asked.withColumn("scope", F.col("lists")), near, k, dims, id_col, scope_col="list_id")
    wanted = F.transform("lists", lambda n: F.concat_ws("/", n, F.col("scope")))
    spots = near.withColumn("_spot", F.concat_ws("/", F.col("list_id"), F.col(scope_col))).filter(F.col(scope_col).isNotNull())
    return cosine_topk(asked.filter("scope IS NOT NULL").withColumn("scope", wanted), spots, k, dims, id_col, scope_col="_spot")
