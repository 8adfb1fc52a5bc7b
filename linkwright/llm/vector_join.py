"""Exact near-duplicate join of vectors in a metric space cut into cells by pivots.

Cosine of at least c means a chord of at most r = sqrt(2 - 2c) between unit vectors. Each vector lives in the cell of
its nearest pivot. The plane halfway between two pivots parts their cells, so by the triangle inequality a vector
farther than r from that plane has no partner beyond it; nearer ones are replicated into the other cell, unless they
are farther from its pivot than the cell's radius plus r. Then each cell finds all partners of its own vectors by
itself. Large cells are cut into blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linkwright.llm.components import components
from linkwright.session import written

#: Vectors per cell aimed at, pivots per label at most, and pivots in all at most. Beyond those, cells grow and are cut
#: into more blocks; nothing is left out.
CELL_ROWS, LABEL_PIVOTS, ALL_PIVOTS = 2000, 64, 16_384

#: Vectors on each side of a block.
BLOCK_ROWS = 4000

#: Room for rounding of squared chords in the geometric bounds; a chord near 0 is off by up to its root (the cosine itself
#: is compared as it is).
SLACK = 1e-9

SPACE = ["label", "dims"]


def _usable() -> Column:
    """Whether a row can be linked at all."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    return F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite & some


def _classes(rows: DataFrame) -> DataFrame:
    """Equal vectors of a label once: node, label, dims, smallest vec_id, copies, embedding."""
    return (rows.filter("node IS NOT NULL").groupBy("node")
            .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("copies"),
                 F.first("label").alias("label"), F.first("embedding").alias("embedding"))
            .select("node", "label", F.size("embedding").alias("dims"), "vec_id", "copies", "embedding"))


def units(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors of one length as unit vectors in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims)
    values = values / np.abs(values).max(1, keepdims=True)
    return values / np.sqrt((values * values).sum(1, keepdims=True))


def _pivots(classes: DataFrame) -> dict[tuple, np.ndarray]:
    """Pivots by label: rows with the smallest hashes, one per CELL_ROWS rows; at most ALL_PIVOTS rows are read."""
    sizes = (classes.groupBy(*SPACE).count()
             .withColumn("wanted", F.least(F.ceil(F.col("count") / CELL_ROWS), F.lit(LABEL_PIVOTS))).filter("wanted > 1"))
    total = sizes.agg(F.sum("wanted")).first()[0] or 0
    sizes = sizes.withColumn("wanted", F.floor(F.col("wanted") * min(1.0, ALL_PIVOTS / max(total, 1))))
    by_draw = F.row_number().over(Window.partitionBy(*SPACE).orderBy(F.xxhash64("node"), "node"))
    drawn = classes.withColumn("place", by_draw).filter(F.col("place") <= LABEL_PIVOTS)
    rows = drawn.join(sizes, SPACE).filter("place <= wanted").orderBy(*SPACE, "place").select(*SPACE, "embedding").toArrow()
    found: dict[tuple, list] = {}
    for label, dims, vector in zip(*(rows.column(k).to_pylist() for k in range(3)), strict=True):
        found.setdefault((label, dims), []).append(vector)
    return {space: units(pa.array(of, pa.list_(pa.float64())), space[1]) for space, of in found.items()}


def _by_space(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows of a batch by label and length."""
    spaces = list(zip(batch.column("label").to_pylist(), batch.column("dims").to_pylist(), strict=True))
    for space in dict.fromkeys(spaces):
        yield space, batch.filter(pa.array([s == space for s in spaces]))


def _homes(classes: DataFrame, pivots: dict[tuple, np.ndarray]) -> DataFrame:
    """``classes`` with the nearest pivot and the distance to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for space, rows in _by_space(batch):
                own = pivots.get(space)
                if own is None:
                    home, far = np.zeros(len(rows), np.int32), np.zeros(len(rows))
                else:
                    chord = _chords(units(rows.column("embedding"), space[1]), own)
                    home = chord.argmin(1).astype(np.int32)
                    far = chord[np.arange(len(home)), home]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(home), pa.array(far)], names)

    names = [*classes.columns, "home", "far"]
    return classes.mapInArrow(run, StructType([*classes.schema.fields]).add("home", "integer").add("far", "double"))


def _chords(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * vectors @ pivots.T, 0))


def _apart(pivots: np.ndarray) -> np.ndarray:
    """Distances of all pivots, from differences, as the dot product cancels where pivots nearly coincide."""
    return np.stack([np.sqrt(((pivots - pivot) ** 2).sum(1)) for pivot in pivots])


def _spread(homes: DataFrame, pivots: dict[tuple, np.ndarray], radii: dict[tuple, np.ndarray], reach: float) -> DataFrame:
    """A row for every cell that a vector is needed in; ``own`` in its home."""
    wide = reach + SLACK ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for space, rows in _by_space(batch):
                own = pivots.get(space)
                if own is None:
                    at, cell, mine = np.arange(len(rows)), np.zeros(len(rows), np.int32), np.ones(len(rows), bool)
                else:
                    home = rows.column("home").to_numpy()
                    chord = _chords(units(rows.column("embedding"), space[1]), own)
                    near = chord[np.arange(len(home)), home][:, None]
                    # not divided by the distance of the pivots: they may coincide, but for rounding
                    beyond = chord * chord - near * near > 2 * _apart(own)[home] * wide + SLACK
                    keep = ~beyond & (chord <= radii[space] + wide)
                    keep[np.arange(len(home)), home] = True
                    at, cell = np.nonzero(keep)
                    mine = cell == home[at]
                taken = rows.select(kept).take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(cell.astype(np.int32)), pa.array(mine)], [*kept, "cell", "own"])

    kept = ["node", "label", "dims", "copies", "embedding"]
    return homes.mapInArrow(run, StructType([*homes.select(kept).schema.fields]).add("cell", "integer").add("own", "boolean"))


def _block_links(table: pa.Table, least: float) -> pa.Table:
    """Links of one block: per own vector the copies it is linked with, and its smallest partner over any path inside."""
    role = table.column("role").to_numpy()
    ids, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
    dims = int(table.column("dims")[0].as_py())
    vectors = units(table.column("embedding").combine_chunks(), dims)
    mine, others = np.flatnonzero(role != 1), np.flatnonzero(role != 0)
    linked = vectors[mine] @ vectors[others].T >= least
    linked &= ids[mine][:, None] != ids[others][None, :]
    count = linked @ copies[others]
    a, b = np.nonzero(linked)
    root = ids.copy()
    while len(a):
        low = np.minimum(root[mine[a]], root[others[b]])
        before = root.copy()
        np.minimum.at(root, mine[a], low)
        np.minimum.at(root, others[b], low)
        if (before == root).all():
            break
    some = np.union1d(mine, np.flatnonzero(root != ids))
    n = np.zeros(len(ids), np.int64)
    n[mine] = count
    return pa.table({"node": pa.array(ids[some]), "n": pa.array(n[some]), "root": pa.array(root[some])})


def linked_vectors(vectors: DataFrame, least: float) -> DataFrame:
    """Link vectors (vec_id long, embedding, label) of equal labels whose cosine is at least ``least`` (over 0).

    Returns per row: vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reachable over
    links, itself included) and kept (vec_id = component_id).

    A vector that is null, zero or empty, holds null, NaN or infinite components, or has a null label or vec_id is linked
    with nothing (n_links 0, its own component); so are vectors of different lengths with each other. Equal vectors of
    a label are one class that is compared once and counted with its copies; links inside a class are counted too.
    Rows of one vec_id are taken for separate vectors that share a name. Other columns are not read. An empty table
    gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", "label")
    rows = rows.withColumn("node", F.when(_usable(), F.xxhash64("label", "embedding")))
    classes = written(_classes(rows), "classes")
    pivots = _pivots(classes)
    homes = written(_homes(classes, pivots), "homes")
    radii = {space: np.full(len(of), -np.inf) for space, of in pivots.items()}
    for row in homes.groupBy(*SPACE, "home").agg(F.max("far").alias("far")).join(
            _known(homes, pivots), SPACE).collect():  # one row per pivot
        radii[row["label"], row["dims"]][row["home"]] = row["far"]
    spread = written(_spread(homes, pivots, radii, float(np.sqrt(2 - 2 * least))), "spread")

    cell = [*SPACE, "cell"]
    cells = spread.groupBy(*cell).agg(
        F.greatest(F.ceil(F.count_if("own") / BLOCK_ROWS), F.lit(1)).cast("int").alias("n_own"),
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("n_all"))
    draw = F.xxhash64("node")
    as_own = F.transform(F.sequence(F.lit(0), F.col("n_all") - 1), lambda k: F.struct(
        F.pmod(draw, F.col("n_own")).cast("int").alias("x"), k.alias("y"), F.lit(0).alias("role")))
    as_other = F.transform(F.sequence(F.lit(0), F.col("n_own") - 1), lambda k: F.struct(
        k.alias("x"), F.pmod(F.xxhash64("node", F.lit(7)), F.col("n_all")).cast("int").alias("y"), F.lit(1).alias("role")))
    both = F.array(F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), F.when(F.col("own"), 2).otherwise(1).alias("role")))
    tasks = F.when((F.col("n_own") == 1) & (F.col("n_all") == 1), both).when(
        F.col("own"), F.concat(as_own, as_other)).otherwise(as_other)
    dealt = spread.join(cells, cell).select(*cell, "node", "copies", "embedding", F.explode(tasks).alias("task")).select(
        *cell, "node", "copies", "embedding", "task.x", "task.y", "task.role")
    found = written(dealt.groupBy(*cell, "x", "y").applyInArrow(
        lambda table: _block_links(table, least), "node bigint, n bigint, root bigint"), "block-links")

    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    groups = components(found.filter("root != node").select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = (classes.select("node", "vec_id", "copies").join(counts, "node", "left").join(groups, "node", "left")
              .select("node", "vec_id", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
                      F.coalesce("component", "node").alias("component")))
    smallest = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    placed = placed.join(smallest, "component").select("node", "n_links", "component_id")
    return (
        rows.select("vec_id", "node").join(placed, "node", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _known(homes: DataFrame, pivots: dict[tuple, np.ndarray]) -> DataFrame:
    """Labels that have pivots."""
    kind = homes.schema["label"].dataType.simpleString()
    return F.broadcast(homes.sparkSession.createDataFrame(list(pivots), f"label {kind}, dims int"))
