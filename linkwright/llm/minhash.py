"""Near-duplicate documents by one-permutation hashing, banded buckets and star-shaped candidate edges.

A document's set is its distinct word 5-shingles. One hash per shingle gives the whole signature: the upper bits
choose a bin, the smallest hash in a bin is its value, and an empty bin copies the first filled bin in a fixed
random order of its own (optimal densification). Documents with equal sets are one class from the start.

Buckets of equal band keys give candidates as stars, one edge from every member to one hub, so a bucket of n
classes costs n - 1 edges. Links are confirmed on the full sets. Buckets whose classes are still in different
components get other hubs, and at last an exact join of what differs from the hub, so no link is lost for want of a
lucky hub, and no group is ever compared pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkwright.llm.components import components
from linkwright.llm.names import free_names
from linkwright.llm.process import kept
from linkwright.llm.words import Words, mix, run_hash, words
from linkwright.session import written

SHINGLE = 5

#: A pair of similarity 0.75 shares no band with a chance of (1 - 0.75 ** 5) ** 48, two in a million.
BANDS, ROWS_PER_BAND = 48, 5
BINS = BANDS * ROWS_PER_BAND

#: One bit per bin gives a first estimate: at similarity 0.75 an eighth of the bits differ on average. A candidate with
#: over MOST_BITS of 240 differing bits is six standard deviations away from that and is not read.
MOST_BITS = 62

#: Classes in a bucket that is settled by its pairs, and orders by which larger ones choose other hubs (a class meets
#: about so many of them).
FEW_MEMBERS, OTHER_HUBS = 8, 4

#: Pairs of texts whose sets a task holds at a time.
ROWS_PER_STEP = 500

#: Up to this many candidates are looked up in the documents by a list sent to all tasks (24 bytes each); more of
#: them are joined by shuffle.
SENT_IDS = 500_000


def _probes() -> np.ndarray:
    """For every bin a random order of all bins."""
    def make() -> np.ndarray:
        draws = mix(np.arange(BINS * BINS, dtype=np.uint64), 17).reshape(BINS, BINS)
        return np.argsort(draws, axis=1, kind="stable").astype(np.int32)

    return kept(("probes", BINS), make)


def shingles(part: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles of a slice, in order; a text of fewer words is one shingle."""
    first, hashes = part.runs(SHINGLE)
    rows = np.searchsorted(part.at, first, "right") - 1
    counts = part.counts
    for size in range(1, SHINGLE):
        short = np.flatnonzero(counts == size)
        rows = np.append(rows, short)
        hashes = np.append(hashes, run_hash(part.hashes, part.at[short], size))
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def densified(signature: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Empty bins copy the first filled bin in their own order; filled bins, and rows without any, stay as they are."""
    order = _probes()
    row, bin_ = np.nonzero(~filled & filled.any(1)[:, None])
    source = signature.copy()
    step = 0
    while len(row):
        probe = order[bin_, step]
        hit = filled[row, probe]
        signature[row[hit], bin_[hit]] = source[row[hit], probe[hit]]
        row, bin_ = row[~hit], bin_[~hit]
        step += 1
    return signature


def sketch(part: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per row: set size, 128-bit digest of the set, bits of the signature (four 60-bit words), band keys."""
    return sketch_of(len(part.at) - 1, *shingles(part))


def sketch_of(n_rows: int, rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``sketch`` of sets given by row and hash, in order."""
    sizes = np.bincount(rows, minlength=n_rows)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    digest = np.zeros((n_rows, 2), np.uint64)
    for k in range(2):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes, 31 + k), dtype=np.uint64)])
        digest[:, k] = total[starts[1:]] - total[starts[:-1]]
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.ones(len(rows), bool)  # hashes rise within a row, so the first of a bin is its smallest
    first[1:] = (rows[1:] != rows[:-1]) | (bins[1:] != bins[:-1])
    signature, filled = np.zeros((n_rows, BINS), np.uint64), np.zeros((n_rows, BINS), bool)
    signature[rows[first], bins[first]] = hashes[first]
    filled[rows[first], bins[first]] = True
    signature = densified(signature, filled)
    each = BINS // 4
    weight = np.uint64(1) << np.arange(each, dtype=np.uint64)
    own = mix(signature ^ mix(np.arange(BINS, dtype=np.uint64), 42), 41)  # one value has another bit in every bin
    bits = ((own & np.uint64(1)).reshape(n_rows, 4, each) * weight).sum(2, dtype=np.uint64)
    banded = signature.reshape(n_rows, BANDS, ROWS_PER_BAND)
    keys = np.zeros((n_rows, BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
    for k in range(ROWS_PER_BAND):
        keys = mix(keys ^ banded[:, :, k], 51)
    return sizes, digest, bits, keys


_SKETCH = "text_hash bigint, n_shingles bigint, d0 bigint, d1 bigint, b0 bigint, b1 bigint, b2 bigint, b3 bigint, bands array<bigint>"


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, set size, digest, signature bits and band keys of every (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words(batch.column(2), "spaced"):
                sizes, digest, bits, keys = sketch(part)
                n = len(sizes)
                flat = pa.array(keys.reshape(-1).view(np.int64))
                bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * BANDS), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, n), batch.column(1).slice(part.first, n), pa.array(sizes.astype(np.int64)),
                     *(pa.array(np.ascontiguousarray(of[:, k]).view(np.int64))
                       for of in (digest, bits) for k in range(of.shape[1])), bands], names)

    names = ["doc_id", "text_hash", "n_shingles", "d0", "d1", "b0", "b1", "b2", "b3", "bands"]
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, f"doc_id bigint, {_SKETCH}")


def _near(a: str, b: str) -> Column:
    """Whether size and bits of two classes (columns prefixed ``a``, ``b``) leave a similarity of 0.75 possible."""
    differ = sum((F.bit_count(F.col(f"{a}b{k}").bitwiseXOR(F.col(f"{b}b{k}"))) for k in range(4)), F.lit(0))
    fits = 4 * F.least(f"{a}n_shingles", f"{b}n_shingles") >= 3 * F.greatest(f"{a}n_shingles", f"{b}n_shingles")
    return fits & (differ <= F.lit(MOST_BITS))


def _sets(texts: pa.Array) -> list[np.ndarray]:
    found: list[np.ndarray] = []
    for part in words(texts, "spaced"):
        rows, hashes = shingles(part)
        found += np.split(hashes, np.cumsum(np.bincount(rows, minlength=len(part.at) - 1))[:-1])
    return found


def _with_texts(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``pairs`` (a, b, ...) of classes with one text of each, as text_a and text_b, sorted by b within a partition.

    Texts of other classes are neither shuffled nor sent to Python.
    """
    some = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = written(classes.join(some, "node").select("node", "doc_id", F.col("text_hash").alias("wanted_hash")), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= SENT_IDS else wanted
    texts = (docs.join(wanted, "doc_id").filter(F.xxhash64("text") == F.col("wanted_hash"))
             .groupBy("node").agg(F.first("text").alias("text")))
    return (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .select(*pairs.columns, "text_a", "text_b")
    )


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, whose sets are held together."""
    for batch in batches:
        for first in range(0, len(batch), ROWS_PER_STEP):
            yield batch.slice(first, ROWS_PER_STEP)


def _met(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Place, set of a and set of b of every row; the set of b is made once per run of rows."""
    hubs = batch.column(1).to_numpy(zero_copy_only=False)
    new = np.flatnonzero(np.append(True, hubs[1:] != hubs[:-1])) if len(hubs) else np.empty(0, np.int64)
    of_b = _sets(batch.column(batch.schema.get_field_index("text_b")).take(pa.array(new)))
    run = np.searchsorted(new, np.arange(len(hubs)), "right") - 1
    for k, mine in enumerate(_sets(batch.column(batch.schema.get_field_index("text_a")))):
        yield k, mine, of_b[run[k]]


def _among(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted array ``of``, which is not empty."""
    at = np.searchsorted(of, values)
    at[at == len(of)] = 0
    return of[at] == values


def _similar(both: int, a: int, b: int) -> bool:
    return 100 * both >= 75 * (a + b - both)


def confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets have 100 * intersection >= 75 * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            linked = np.zeros(len(batch), bool)
            for k, a, b in _met(batch):
                linked[k] = _similar(int(_among(a, b).sum()), len(a), len(b))
            yield batch.select([0, 1]).filter(pa.array(linked))

    return _with_texts(pairs, classes, docs).mapInArrow(run, "a bigint, b bigint")


def _differences(stars: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """How the set of a differs from the set of its hub b, for rows (a, b, component).

    n is the size of a's set, ``tokens`` the shingles that only one of the two has, ``linked`` whether the two are.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            n, linked, tokens = [], [], []
            for _, a, b in _met(batch):
                added, lacking = a[~_among(a, b)], b[~_among(b, a)]
                n.append(len(a))
                linked.append(_similar(len(a) - len(added), len(a), len(b)))
                tokens.append(np.concatenate([added, lacking]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n, pa.int64()), pa.array(linked, pa.bool_()), pa.array(tokens, pa.list_(pa.int64()))],
                ["a", "b", "component", "n", "linked", "tokens"])

    return _with_texts(stars, classes, docs).mapInArrow(
        run, "a bigint, b bigint, component bigint, n bigint, linked boolean, tokens array<bigint>")


def _candidates(pairs: DataFrame, classes: DataFrame, tested: DataFrame | None) -> DataFrame:
    """Distinct pairs (a > b) that were not tested before and that size and bits leave possible; stored."""
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    if tested is not None:
        pairs = pairs.join(tested, ["a", "b"], "left_anti")
    narrow = classes.select("node", "n_shingles", "b0", "b1", "b2", "b3")
    for side in "ab":
        pairs = pairs.join(narrow.withColumnsRenamed({c: f"{side}_{c}" for c in narrow.columns}),
                           F.col(side) == F.col(f"{side}_node"))
    return written(pairs.filter(_near("a_", "b_")).select("a", "b"), "pairs")


def _open_buckets(shared: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, node, component) of the buckets whose classes lie in more than one component; stored."""
    placed = shared.join(groups, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    return written(placed.join(mixed.select("key"), "key"), "open")


def _links_left(left: DataFrame, links: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (a, b) between classes that share a bucket of ``left`` (key, node, component) but no component.

    Pairs are found by a prefix-filtered join in the space of differences from a hub: if d and e shingles differ from the
    hub, sets of sizes n and m are linked exactly if they share at least (d + e - (n + m) / 7) / 2 of those shingles. So, in
    any common order, they share one among the first of each, d (or e) less that many plus one. The order is by rarity
    among the hub's classes: what near copies of one text have in common is part of the hub or differs in most of them, and
    comes last. A large group of near copies thus gives few candidates. The hub of a bucket is its class with the most links
    so far.
    """
    ends = links.select(F.col("a").alias("node")).union(links.select("b")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    hubs = left.join(ends, "node", "left").groupBy("key").agg(
        F.max_by("node", F.struct(F.coalesce("degree", F.lit(0)), "node")).alias("b"))
    stars = (left.join(hubs, "key").filter("node != b")
             .select(F.col("node").alias("a"), "b", "component").distinct())
    found = written(_differences(written(stars, "stars"), classes, docs), "differences")
    every = found.select("a", "b", F.explode("tokens").alias("token"))
    common = every.groupBy("b", "token").agg(F.count(F.lit(1)).alias("n_having"))
    ranked = every.join(common, ["b", "token"]).groupBy("a", "b").agg(
        F.array_sort(F.collect_list(F.struct("n_having", "token"))).alias("ranked"))
    d, n = F.size("ranked"), F.col("n")
    most = d - F.greatest(F.ceil(d - n / 3), F.lit(1)) + 1  # a partner never asks for more of the order than this
    first = found.drop("tokens").join(ranked, ["a", "b"]).select(
        "a", "b", "component", "n", "linked", d.alias("d"), F.posexplode(F.slice("ranked", F.lit(1), most.cast("int"))).alias("place", "t"))
    first = written(first.filter("t.n_having > 1").select("a", "b", "component", "n", "linked", "d", "place", "t.token"), "prefixes")
    other = first.select("b", "token", *[F.col(c).alias(f"{c}_2") for c in ("a", "component", "n", "d", "linked", "place")])
    shared = F.greatest(F.ceil((7 * (F.col("d") + F.col("d_2")) - F.col("n") - F.col("n_2")) / 14), F.lit(1))
    pairs = first.join(other, ["b", "token"]).filter(
        (F.col("a") > F.col("a_2")) & (F.col("component") != F.col("component_2")) & ~(F.col("linked") & F.col("linked_2"))
        & (F.col("place") <= F.col("d") - shared) & (F.col("place_2") <= F.col("d_2") - shared))
    pairs = _candidates(pairs.select("a", F.col("a_2").alias("b")), classes, None)
    of_stars = found.filter("linked").select("a", "b")
    return of_stars if pairs.isEmpty() else of_stars.union(confirmed(pairs, classes, docs))


def _links(shared: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, component) of all linked classes, from the buckets ``shared`` (key, node, hub).

    Small buckets are settled by their few pairs. Larger ones get some other hubs, to join what belongs together and to
    find a class that is linked with many, and then the join of differences.
    """
    def grouped(links: DataFrame) -> DataFrame:
        return written(components(links), "groups")

    members = shared.select("key", "node")
    tested = _candidates(
        shared.filter("node != hub").select(F.col("node").alias("a"), F.col("hub").alias("b")), classes, None)
    links = written(confirmed(tested, classes, docs), "links")
    groups = grouped(links)
    left = _open_buckets(members, groups)
    if left.isEmpty():
        return groups
    left = left.join(left.groupBy("key").agg(F.count(F.lit(1)).alias("size")), "key")
    few, many = left.filter(F.col("size") <= FEW_MEMBERS), left.filter(F.col("size") > FEW_MEMBERS)
    other = few.select("key", F.col("node").alias("b"), F.col("component").alias("component_b"))
    pairs = few.join(other, "key").filter("node > b AND component != component_b").select(F.col("node").alias("a"), "b")
    draw = F.xxhash64("node", F.pmod("key", F.lit(OTHER_HUBS)))
    hubs = many.groupBy("key").agg(F.min_by(F.struct("node", "component"), draw).alias("hub"))
    pairs = pairs.union(many.join(hubs, "key").filter("component != hub.component")
                        .select(F.col("node").alias("a"), F.col("hub.node").alias("b")))
    fresh = _candidates(pairs, classes, tested)
    links = written(links.union(confirmed(fresh, classes, docs)), "links")
    groups = grouped(links)
    left = _open_buckets(many.select("key", "node"), groups)
    if left.isEmpty():
        return groups
    return grouped(links.union(written(_links_left(left, links, classes, docs), "links")))


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, class_id, component (a class) and component_id of every row."""
    drawn = written(sketches(docs), "sketches").withColumn("node", F.xxhash64("d0", "d1", "n_shingles")).drop("d0", "d1")
    real = drawn.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(real.dropDuplicates(["node"]), "classes")
    members = classes.select("node", F.explode("bands").alias("key"))
    hubs = members.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last")).filter("hub < last")
    shared = written(members.join(hubs.select("key", "hub"), "key"), "shared")
    groups = _links(shared, classes, docs)

    placed = (real.groupBy("node").agg(F.min("doc_id").alias("class_id")).join(groups, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    least = placed.groupBy("component").agg(F.min("class_id").alias("component_id"))
    placed = placed.join(least, "component").select("node", "class_id", "component", "component_id")
    node = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("node"))
    return (
        drawn.select("doc_id", "text_hash", "n_shingles", node.alias("node")).join(placed, "node", "left")
        .select("doc_id", "text_hash", "n_shingles", F.coalesce("class_id", "doc_id").alias("class_id"), "component",
                F.coalesce("component_id", "doc_id").alias("component_id"))
    )


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Link documents (doc_id long, text) whose shingle sets have a similarity of 0.75 or more.

    Returns per row: doc_id, n_shingles (size of its set), class_id (smallest doc_id with an equal set), component_id
    (smallest doc_id reachable over links, itself included) and kept (doc_id = component_id).

    Words are runs of other than blanks, A-Z lower-cased; a text of fewer than five words is one shingle, all its words.
    A text without words or a null text has an empty set and is linked with nothing. A row with a null doc_id is linked
    with nothing, has null ids and is kept. Every row is a document: rows that share a doc_id are linked by their texts
    only. Other columns are not read. An empty table gives no rows.
    """
    return _grouped(_read(docs)).select(
        "doc_id", "n_shingles", "class_id", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of every group of near duplicates, one with the smallest doc_id.

    Columns stay. Where rows of a group share that doc_id, the one with the smallest hash of its text stays. Rows with a null
    doc_id stay.
    """
    found = written(_grouped(_read(docs)), "found")
    key = docs["doc_id"].cast("bigint")
    id_, hash_ = free_names(docs, 2)
    gone = found.filter("doc_id != component_id").select(F.col("doc_id").alias(id_)).distinct()
    repeated = found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(id_))
    repeated = written(repeated, "repeated")
    if repeated.isEmpty():
        return docs.join(gone, key == F.col(id_), "left_anti")
    alone = docs.join(repeated, key == F.col(id_), "left_anti").join(gone, key == F.col(id_), "left_anti")
    kept_rows = (found.join(repeated, F.col("doc_id") == F.col(id_), "left_semi").filter("doc_id = component_id")
                 .groupBy(F.col("doc_id").alias(id_), F.coalesce("component", "text_hash")).agg(F.min("text_hash").alias(hash_)))
    several = docs.join(kept_rows, (key == F.col(id_)) & (F.xxhash64(docs["text"].cast("string")) == F.col(hash_)), "left_semi")
    return alone.union(several.dropDuplicates(["doc_id", "text"]))
