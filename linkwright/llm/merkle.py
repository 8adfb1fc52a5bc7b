"""Merkle fixity audit of archive files: find damaged records by comparing trees of two replicas.

A record is a byte range of a file with its digest. Level 0 of the tree hashes, for every LEAF_BYTES of a file, the
records that begin there in the order of their offsets; every further level hashes up to FAN ordered nodes. Replicas are
compared from the root down, and only the children of differing nodes are looked at, so equal files cost one
comparison and a damaged one a few per level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.session import written

#: Bytes of a file that a leaf covers, and children of a node.
LEAF_BYTES, FAN = 1 << 16, 16


def warc_record(url: Column, body: Column) -> Column:
    """The bytes of a WARC response record, as text; a null url or body is empty."""
    body, url = F.coalesce(body.cast("string"), F.lit("")), F.coalesce(url.cast("string"), F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def records(rows: DataFrame, file: Column, order: list[str], record: Column, *keep: str) -> DataFrame:
    """(keep, file, offset, length, digest): records laid one after the other in every file, by ``order``.

    A file must be small enough for one task to sort its record lengths; texts are not moved, only lengths and digests.
    Rows of equal place in the order are laid by digest, nulls before all others; a null record is an empty one, and rows with
    a null file are a file of that name. An empty table has no records. The names kept must not be file, offset, length or
    digest; other columns of the rows, such names among them, are not read.
    """
    record = F.coalesce(record, F.lit(""))
    sized = rows.select(*keep, *[c for c in order if c not in keep], file.alias("file"),
                        F.octet_length(record).cast("bigint").alias("length"), F.sha2(record, 256).alias("digest"))
    before = Window.partitionBy("file").orderBy(*order, "digest").rowsBetween(Window.unboundedPreceding, -1)
    return sized.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint")).select(
        *keep, "file", "offset", "length", "digest")


def _hashed(parts: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(parts), "\n"), 256)


def _place(number: Column) -> Column:
    """A number as text that sorts like it."""
    return F.lpad(number.cast("string"), 20, "0")


def _leaves(records_: DataFrame) -> DataFrame:
    """Level 0: (file, node, digest). Equal records are counted first, so repeated rows cost one entry."""
    once = records_.groupBy("file", "offset", "length", "digest").agg(F.count(F.lit(1)).alias("n"))
    entry = F.concat_ws(" ", _place(F.col("offset")), F.col("length"), F.col("digest"), F.col("n"))
    return (once.groupBy("file", F.floor(F.col("offset") / LEAF_BYTES).alias("node"))
            .agg(_hashed(F.collect_list(entry)).alias("digest")))


def _above(nodes: DataFrame) -> DataFrame:
    """The next level of a tree."""
    entry = F.concat_ws(" ", _place(F.col("node")), F.col("digest"))
    return nodes.groupBy("file", F.floor(F.col("node") / FAN).alias("node")).agg(_hashed(F.collect_list(entry)).alias("digest"))


def tree(records_: DataFrame, levels: int) -> list[DataFrame]:
    """Levels of the tree from the leaves up, stored."""
    found = [written(_leaves(records_), "leaves")]
    while len(found) < levels:
        found.append(written(_above(found[-1]), "nodes"))
    return found


def _differing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose digests differ, or that one side lacks; null keys are equal to each other."""
    other = b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("digest").alias("_digest"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    met = a.join(other, same, "full").filter(~F.col("digest").eqNullSafe(F.col("_digest")))
    return met.select(*[F.coalesce(k, f"_{k}").alias(k) for k in keys], "digest", "_digest")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records (file, offset, length, digest) in which two replicas differ.

    Returns file, offset, kind (``changed``, ``missing`` from the replica, ``extra`` in it), primary_digest and
    replica_digest (of all records at that offset; null where there is none). Rows with a null file or offset belong to a
    file of that name and to offset 0. Equal records of one offset are counted, so a replica that holds one twice
    differs. Two empty tables, or equal ones, give no rows. Other columns are not read.
    """
    sides = [r.select("file", F.coalesce("offset", F.lit(0)).cast("bigint").alias("offset"), "length", "digest")
             for r in (primary, replica)]
    far = max((s.agg(F.max("offset")).first()[0] or 0) // LEAF_BYTES for s in sides)
    levels = 1
    while far:
        far, levels = far // FAN, levels + 1
    a, b = (tree(s, levels) for s in sides)
    suspects = written(_differing(a[-1], b[-1], ["file", "node"]).select("file", "node"), "suspects")
    for level in range(levels - 2, -1, -1):
        up = suspects.select(F.col("file").alias("_file"), F.col("node").alias("_up"))
        below = [n.join(up, F.col("file").eqNullSafe(F.col("_file")) & (F.floor(F.col("node") / FAN) == F.col("_up")), "left_semi")
                 for n in (a[level], b[level])]
        suspects = written(_differing(*below, ["file", "node"]).select("file", "node"), "suspects")
    spots = suspects.select(F.col("file").alias("_file"), F.col("node").alias("_node"))

    def at_spots(side: DataFrame) -> DataFrame:
        near = side.join(spots, F.col("file").eqNullSafe(F.col("_file")) & (F.floor(F.col("offset") / LEAF_BYTES) == F.col("_node")), "left_semi")
        once = near.groupBy("file", "offset", "length", "digest").agg(F.count(F.lit(1)).alias("n"))
        alone = F.coalesce(F.col("all")[0]["digest"], F.lit(""))  # null would look like no record
        entry = F.transform("all", lambda r: F.concat_ws(" ", r["length"], r["digest"], r["n"]))
        return (once.groupBy("file", "offset").agg(F.array_sort(F.collect_list(F.struct("digest", "length", "n"))).alias("all"))
                .withColumn("digest", F.when((F.size("all") == 1) & (F.col("all")[0]["n"] == 1), alone).otherwise(_hashed(entry))))

    kind = F.when(F.col("digest").isNull(), "extra").when(F.col("_digest").isNull(), "missing").otherwise("changed")
    return _differing(*(at_spots(s) for s in sides), ["file", "offset"]).select(
        "file", "offset", kind.alias("kind"), F.col("digest").alias("primary_digest"), F.col("_digest").alias("replica_digest"))
