"""Best-fit-decreasing bin packing of indivisible groups into shards.

A group is all rows with one key. Groups of one size are alike, so the packing sees (size, number of groups) only: a list
as long as there are different sizes, however many groups there are, and the one thing that reaches the driver. Its
result says which groups of a size, counted along the key, go to which shard; every group finds its shard by its
number in the order of falling size, which no single task gives out.
"""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.llm.names import free_names
from linkwright.operators.skew import ordinal_in_group, surrogate_key
from linkwright.session import written

#: Neighbouring group numbers that look up their shard together.
RANKS_TOGETHER = 64

#: Rows that are numbered together, about.
BLOCK_ROWS = 200_000


class _Node:
    __slots__ = ("room", "bins", "rank", "left", "right")

    def __init__(self, room: int, number: int, rank: float):
        self.room, self.bins, self.rank = room, [number], rank
        self.left: _Node | None = None
        self.right: _Node | None = None


class RoomTree:
    """Open bins by remaining room: a search tree kept balanced by random ranks (a treap)."""

    def __init__(self) -> None:
        self._root: _Node | None = None
        self._rank = random.Random(0).random

    def add(self, room: int, number: int) -> None:
        self._root = self._add(self._root, room, number)

    def _add(self, node: _Node | None, room: int, number: int) -> _Node:
        if node is None:
            return _Node(room, number, self._rank())
        if room == node.room:
            node.bins.append(number)
        elif room < node.room:
            node.left = self._add(node.left, room, number)
            if node.left.rank < node.rank:
                top = node.left
                node.left, top.right = top.right, node
                return top
        else:
            node.right = self._add(node.right, room, number)
            if node.right.rank < node.rank:
                top = node.right
                node.right, top.left = top.left, node
                return top
        return node

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (room, bin) of the tightest bin with room for ``size``; None if none has."""
        best, node = None, self._root
        while node is not None:
            if node.room >= size:
                best, node = node, node.left
            else:
                node = node.right
        if best is None:
            return None
        number = best.bins.pop()
        if not best.bins:
            self._root = self._drop(self._root, best.room)
        return best.room, number

    def _drop(self, node: _Node, room: int) -> _Node | None:
        if room < node.room:
            node.left = self._drop(node.left, room)
        elif room > node.room:
            node.right = self._drop(node.right, room)
        else:
            return self._joined(node.left, node.right)
        return node

    def _joined(self, low: _Node | None, high: _Node | None) -> _Node | None:
        if low is None or high is None:
            return low or high
        if low.rank < high.rank:
            low.right = self._joined(low.right, high)
            return low
        high.left = self._joined(low, high.left)
        return high


def best_fit_decreasing(sizes: Iterable[tuple[int, int]], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Runs (first, last, bin, each) over the items in falling order of size, and the number of bins.

    ``sizes`` are (size, count). Larger items first; each enters the tightest bin that still has room, else a new one. An
    item over the capacity gets a bin of its own. After an item the same bin is the tightest one again as long as it has
    room, so equal items go in together: items ``first`` to ``last`` - 1 fill bins from ``bin`` on, ``each`` in one.
    """
    runs, tree, bins, done = [], RoomTree(), 0, 0
    for size, count in sorted(sizes, reverse=True):
        while count:
            found = tree.take(size) if size <= capacity else None
            if found is not None:
                room, number = found
                n = each = count if size == 0 else min(count, room // size)
                left, filled = room - n * size, 1
            else:
                number, each = bins, 1 if size > capacity else count if size == 0 else capacity // size
                filled = max(1, count // each)
                n = min(count, filled * each)
                bins += filled
                left = 0 if size > capacity else capacity - min(n, each) * size
            if left:
                for k in range(filled):
                    tree.add(left, number + k)
            runs.append((done, done + n, number, each))
            done, count = done + n, count - n
    return runs, bins


def smallest_capacity(sizes: list[tuple[int, int]], shards: int) -> int:
    """The smallest capacity found by bisection that needs at most ``shards`` bins."""
    total = sum(size * count for size, count in sizes)
    low = max(1, -(-total // shards) // 2)
    high = max(1, 2 * -(-total // shards) + max((size for size, _ in sizes), default=0))
    while high - low > max(0, low // 20_000):
        middle = (low + high) // 2
        if best_fit_decreasing(sizes, middle)[1] <= shards:
            high = middle
        else:
            low = middle + 1
    return high


def assign(rows: DataFrame, key: str, size: str, shards: int | None = None, capacity: int | None = None) -> DataFrame:
    """``rows`` with column ``shard``; rows with an equal ``key`` stay together.

    Give ``shards`` to fill that many shards as evenly as the groups allow (the smallest workable capacity is
    searched), or ``capacity`` to use as few shards of that capacity as best fit finds. A group over the capacity gets a
    shard of its own. A null key is a group as well; a null size counts nothing. An empty table gives no rows. A column
    ``shard`` that is there already is replaced; other columns stay, whatever their names.
    ``key`` should be a 64-bit hash or another short value; two groups that share one are one group. The driver holds a
    number per different size and per run of equal groups (with ``capacity`` also one per shard).
    """
    sums = written(rows.groupBy(F.col(key).alias("key")).agg(F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("size")), "groups")
    sizes = [(r["size"], r["count"]) for r in sums.groupBy("size").count().collect()]
    runs, _ = best_fit_decreasing(sizes, capacity if shards is None else smallest_capacity(sizes, shards))
    placed = rows.sparkSession.createDataFrame(runs, "first bigint, last bigint, bin bigint, each bigint")
    # a run is looked up by blocks of numbers, so a size with many runs or many groups is no hot key
    spot = F.sequence(F.floor(F.col("first") / RANKS_TOGETHER), F.floor((F.col("last") - 1) / RANKS_TOGETHER))
    placed = placed.withColumn("spot", F.explode(spot))
    ranked = surrogate_key(sums.withColumn("falling", -F.col("size")), ["falling", "key"], "rank", first=0)
    found = (
        ranked.withColumn("spot", F.floor(F.col("rank") / RANKS_TOGETHER)).join(placed, "spot")
        .filter((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    )
    of_key, bin_ = free_names(rows.drop("shard"), 2)
    found = found.select(F.col("key").alias(of_key), (F.col("bin") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))).cast("int").alias(bin_))
    joined = rows.join(written(found, "packed"), F.col(key).eqNullSafe(F.col(of_key)))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() != "shard"], F.col(bin_).alias("shard"))


def numbered(rows: DataFrame, order: list[str], out: str = "slot") -> DataFrame:
    """Gapless numbers from 0 within each ``shard``.

    A shard is numbered in blocks of about BLOCK_ROWS rows, each shifted by the sizes of the blocks before it, so no
    task holds a whole shard. Equal rows get different numbers in no particular order.
    """
    rows = written(rows, "sharded")
    largest = rows.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, -(-largest // BLOCK_ROWS))
    spread = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    placed = ordinal_in_group(spread, ["shard"], order, F.col("_block"), out)
    return placed.withColumn(out, F.col(out).cast("bigint") - 1).drop("_block")


def capacity_shards(docs: DataFrame, capacity: int) -> DataFrame:
    """All documents in as few shards of ``capacity`` bytes as best fit needs: doc_id, size, shard, shard_bytes.

    Sizes, groups and odd rows as in ``shard_documents``; a group over the capacity has a shard of its own.
    """
    placed = written(assign(_sized(docs), "text_hash", "size", capacity=capacity), "sharded")
    loads = placed.groupBy("shard").agg(F.sum("size").alias("shard_bytes"))
    return placed.join(loads, "shard").select("doc_id", "size", "shard", "shard_bytes")


def _sized(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return written(docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(16)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    ), "sizes")


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """All documents in ``shards`` shards of nearly equal bytes; equal texts stay in one shard.

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32 (unsigned), law ``bytes``, shard, slot
    (gapless from 0 in each shard) and grown_shard (null: this law moves groups when a shard is added).

    A null text has no bytes (checksum 0) and shares a group with the empty text. Rows with a null or repeated doc_id
    are rows like any other. Other columns are not read. Sizes are as near to equal as whole groups allow: a group of
    copies larger than an even share fills a shard by itself.
    """
    placed = numbered(assign(_sized(docs), "text_hash", "size", shards=shards), ["doc_id", "text_hash"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
