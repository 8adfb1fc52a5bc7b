"""Grouping, numbering and text building that hold when one key owns a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkwright.session import written

MAX_LISTED_KEYS = 50_000

#: Bytes of a text in one row, about; far below what a row may hold.
PART_BYTES = 4_000_000


def heavy_keys(rows: DataFrame, keys: Sequence[str], weight: Column, limit: int) -> DataFrame | None:
    """Keys whose rows weigh more than ``limit`` together; None if there are none.

    The sums are combined map-side, so one hot key costs one row per task. Up to MAX_LISTED_KEYS heavy keys are listed
    and marked for broadcast; a longer list stays distributed and is joined by shuffle.
    """
    sums = rows.groupBy(*keys).agg(F.sum(weight).alias("_weight")).filter(F.col("_weight") > limit).select(*keys)
    listed = sums.limit(MAX_LISTED_KEYS + 1).collect()
    if not listed:
        return None
    if len(listed) > MAX_LISTED_KEYS:
        return sums
    return F.broadcast(rows.sparkSession.createDataFrame(listed, sums.schema))


def text_parts(
    lines: DataFrame,
    keys: Sequence[str],
    line: str,
    order: Sequence[str],
    salt: Sequence[str],
    out: str = "text",
    sep: str = "\n",
    part_bytes: int = PART_BYTES,
    counted: DataFrame | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Ordered concatenation of ``line`` per key as rows (keys, carry, part_no, out).

    The text of a key is cut by position: a line belongs to part number (bytes before it in the key's text) divided by
    ``part_bytes``. So a text of up to ``part_bytes`` is part 0, and the parts of a longer one, joined by ``sep`` in the
    order of ``part_no``, are that text; a line longer than a part leaves out numbers. No task ever holds a hot group:
    the lines of large keys are dealt out by ranges of the order, with ``salt`` columns to part equal ones, and the
    places in the text are carried from range to range as one number each.

    ``counted`` may name a cheaper frame with the same keys and lines (or more) for finding the large keys. A null line
    adds no text, so one such row keeps a key without lines. ``carry`` columns are the same in all rows of a key.
    """
    width = F.coalesce(F.octet_length(line) + len(sep.encode()), F.lit(0)).cast("bigint")
    heavy = heavy_keys(lines if counted is None else counted, keys, width, part_bytes)
    if heavy is None:
        tagged = lines.withColumn("part_no", F.lit(0).cast("bigint"))
    else:
        known = heavy.withColumnsRenamed({k: f"_heavy_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_heavy_{k}")) for k in keys])
        small = lines.join(known, same, "left_anti").withColumn("part_no", F.lit(0).cast("bigint"))
        large = lines.join(known, same, "left_semi")
        tagged = small.unionByName(_placed(large, keys, order, salt, width, part_bytes))
    ordering = ", ".join(f"`{c}`" for c in order)
    joined = F.expr(f"listagg(`{line}`, '{_sql_text(sep)}') WITHIN GROUP (ORDER BY {ordering})")
    return tagged.groupBy(*keys, "part_no", *carry).agg(joined.alias(out))


def _placed(
    lines: DataFrame, keys: Sequence[str], order: Sequence[str], salt: Sequence[str], width: Column, part_bytes: int
) -> DataFrame:
    """Lines with the part that the bytes before them put them in."""
    placed = _with_places(lines, keys, order, salt, width)
    return placed.withColumn("part_no", F.floor(F.col("_at") / part_bytes).cast("bigint")).select(*lines.columns, "part_no")


def _with_places(
    lines: DataFrame, keys: Sequence[str], order: Sequence[str], salt: Sequence[str], width: Column, codec: str | None = None
) -> DataFrame:
    """Lines with the bytes before them in the text of their key (``_at``).

    Range bounds are sampled, so the ranges are stored before they are read twice.
    """
    spot = list(dict.fromkeys([*keys, *order, *salt]))
    ranged = written(lines.withColumn("_width", width).repartitionByRange(*spot).withColumn("_range", F.spark_partition_id()), codec=codec)
    until = (Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(*until)
    base = ranged.groupBy(*keys, "_range").agg(F.sum("_width").alias("_sum")).select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_range").alias("_of_range"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    inside = Window.partitionBy(*keys, "_range").orderBy(*spot).rowsBetween(*until)
    at = F.coalesce(F.sum("_width").over(inside), F.lit(0)) + F.col("_base")
    # the window keeps (keys, range) together, so the sums are joined first and travel with the lines
    return ranged.join(base, same & (F.col("_range") == F.col("_of_range"))).select(*lines.columns, at.alias("_at"))


def repeated_parts(
    lines: DataFrame, keys: Sequence[str], line: str, order: Sequence[str], copies: str, out: str, sep: str, part_bytes: int,
    codec: str | None = None,
) -> DataFrame:
    """The parts of ``text_parts`` for large keys, from lines that come once each with the number of their ``copies``.

    Lines are not null. The copies of a line stand next to each other in the text and are dealt to the parts in which they
    begin by arithmetic, so a line of very many copies is one row until its parts are written.
    """
    one = F.octet_length(line).cast("bigint") + len(sep.encode())
    placed = _with_places(lines, keys, order, [], one * F.col(copies), codec).withColumn("_one", one)

    def begun(upto: Column) -> Column:
        """How many copies begin before a place in the text."""
        far = F.greatest(upto - F.col("_at"), F.lit(0).cast("bigint")) + F.col("_one") - 1
        return F.least((far - F.pmod(far, F.col("_one"))) / F.col("_one"), F.col(copies)).cast("bigint")

    def part(place: Column) -> Column:
        return F.floor(place / part_bytes).cast("bigint")

    parts = F.sequence(part(F.col("_at")), part(F.col("_at") + (F.col(copies) - 1) * F.col("_one")))
    dealt = placed.withColumn("part_no", F.explode(parts)).withColumn(
        "_here", (begun((F.col("part_no") + 1) * part_bytes) - begun(F.col("part_no") * part_bytes)).cast("int")).filter("_here > 0")
    run = F.concat(F.repeat(F.concat(F.col(line), F.lit(sep)), F.col("_here") - 1), F.col(line))
    ordering = ", ".join(f"`{c}`" for c in order)
    joined = F.expr(f"listagg(`_run`, '{_sql_text(sep)}') WITHIN GROUP (ORDER BY {ordering})")
    return dealt.withColumn("_run", run).groupBy(*keys, "part_no").agg(joined.alias(out))


def _sql_text(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n")


def ordinal_in_group(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, out: str = "ordinal"
) -> DataFrame:
    """1, 2, 3… within each key, for groups too large for one window.

    ``bucket`` is a value that never falls as ``order`` rises (a date, a range of turn numbers).
    Rows are numbered within (key, bucket) and shifted by the size of the earlier buckets.
    """
    tagged = rows.withColumn("_bucket", bucket)
    spot = [*keys, "_bucket"]
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        tagged.groupBy(*spot).agg(F.count(F.lit(1)).alias("_n"))
        .select(*spot, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    )
    local = F.row_number().over(Window.partitionBy(*spot).orderBy(*order))
    return (
        tagged.withColumn("_local", local)
        .join(base, spot)
        .withColumn(out, F.col("_local") + F.col("_base"))
        .drop("_bucket", "_local", "_base")
    )


def surrogate_key(rows: DataFrame, order: Sequence[str], out: str = "row_id", first: int = 1) -> DataFrame:
    """Gap-free numbers over a total order without a single-task window.

    Rows are range-partitioned on the whole order tuple, written to the shared folder with their
    place in the partition (range bounds are sampled, so both later passes must read the same
    split), and shifted by the sizes of the earlier partitions: one number per partition.
    """
    placed = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    )
    return (
        placed.join(F.broadcast(base), "_part")
        .withColumn(out, F.col("_place") + F.col("_base") + F.lit(first))
        .drop("_part", "_place", "_base")
    )


def first_row(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits each map task to one row per key before the shuffle (window group limit), so a
    hot key reaches the reducer as one row per task.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", ranked).filter(F.col("_rank") == 1).drop("_rank")
