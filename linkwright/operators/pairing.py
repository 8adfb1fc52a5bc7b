"""Pairing of requests with responses: by key within a time limit, or first in, first out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ANSWERED, TIMED_OUT = 200, 504


def answer_within(
    requests: DataFrame, responses: DataFrame, keys: Sequence[str], seconds: int, time: str = "ts"
) -> DataFrame:
    """Each request with the first response on the same keys in [ts, ts + seconds], and a status.

    ``requests`` and ``responses`` have the keys, ``time``, and ``request_id`` / ``response_id``.
    Time is cut into slots of ``seconds``. A response goes to its own slot and the one before, so a
    request's answer is in its slot: one linear pass per (key, slot), no pair of rows is formed, and
    a hot key spreads over its slots.
    """
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    width = seconds * 1_000_000
    slot = ((F.col("_us") - F.pmod(F.col("_us"), F.lit(width))) / F.lit(width)).cast("bigint")
    asked = requests.select(*keys, micros.alias("_us"), "request_id").select(
        *keys, "_us", "request_id", F.lit(None).cast(responses.schema["response_id"].dataType).alias("response_id"),
        slot.alias("_slot"))
    given = responses.select(*keys, micros.alias("_us"), "response_id").select(
        *keys, "_us", F.lit(None).cast(requests.schema["request_id"].dataType).alias("request_id"), "response_id",
        F.explode(F.array(slot, slot - 1)).alias("_slot"))
    # Newest first, so that the rows that follow in time come before: a growing frame is linear.
    order = [F.col("_us").desc(), F.col("response_id").isNotNull().desc(), F.col("response_id").desc()]
    later = Window.partitionBy(*keys, "_slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    answer = F.when(F.col("response_id").isNotNull(), F.struct(F.col("_us").alias("us"), "response_id"))
    paired = asked.unionByName(given).withColumn("_next", F.last(answer, ignorenulls=True).over(later))
    in_time = F.col("_next.us") <= F.col("_us") + width
    return paired.filter(F.col("request_id").isNotNull()).select(
        *keys, "request_id",
        F.when(in_time, F.col("_next.response_id")).alias("response_id"),
        F.when(in_time, ((F.col("_next.us") - F.col("_us")) / F.lit(1_000_000.0))).alias("wait_seconds"),
        F.when(F.coalesce(in_time, F.lit(False)), ANSWERED).otherwise(TIMED_OUT).alias("status"),
    )


def fifo_pairs(messages: DataFrame, session: str, order: str, is_request: Column, bucket: Column, key: str) -> DataFrame:
    """Each response goes to the oldest request of its session that is still open.

    A response that comes when no request is open is dropped. With s the running count of responses
    minus requests, a response is unsolicited exactly when s passes its earlier maximum above zero.
    Running sums and maxima are taken within (session, bucket) and then carried over the buckets,
    so a hot session is not one task; ``bucket`` must never fall as ``order`` rises.
    Gives (session, n, request key, response key); open requests have a null response.
    """
    rows = messages.select(session, order, F.col(key).alias("_key"), is_request.alias("_asks"), bucket.alias("_bucket"))
    spot = [session, "_bucket"]
    inside = Window.partitionBy(*spot).orderBy(order, "_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = F.when(F.col("_asks"), -1).otherwise(1)
    local = rows.withColumn("_sum", F.sum(step).over(inside)).withColumn(
        "_asked", F.sum(F.when(F.col("_asks"), 1).otherwise(0)).over(inside)).withColumn(
        "_answered", F.sum(F.when(F.col("_asks"), 0).otherwise(1)).over(inside)).withColumn(
        "_peak", F.max(F.when(~F.col("_asks"), F.col("_sum"))).over(inside))
    earlier = Window.partitionBy(session).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    totals = local.groupBy(*spot).agg(
        F.sum(step).alias("_d"), F.sum(F.when(F.col("_asks"), 1).otherwise(0)).alias("_a"),
        F.sum(F.when(F.col("_asks"), 0).otherwise(1)).alias("_r"), F.max("_peak").alias("_p"),
    )
    base = totals.withColumn("_base", F.coalesce(F.sum("_d").over(earlier), zero)).withColumn(
        "_asked0", F.coalesce(F.sum("_a").over(earlier), zero)).withColumn(
        "_answered0", F.coalesce(F.sum("_r").over(earlier), zero)).withColumn(
        "_peak0", F.greatest(zero, F.coalesce(F.max(F.col("_base") + F.col("_p")).over(earlier), zero)))
    full = local.join(base.select(*spot, "_base", "_asked0", "_answered0", "_peak0"), spot)
    spare = F.greatest(F.col("_peak0"), F.coalesce(F.col("_base") + F.col("_peak"), zero))
    numbered = full.select(
        session, order, "_key", "_asks",
        F.when(F.col("_asks"), F.col("_asked0") + F.col("_asked"))
        .otherwise(F.col("_answered0") + F.col("_answered") - spare).cast("bigint").alias("n"),
    )
    # An unsolicited response repeats the number of the response before it (or 0): the first one counts.
    at = F.struct(order, "_key")
    pairs = numbered.filter(F.col("n") > 0).groupBy(session, "n").agg(
        F.min(F.when(F.col("_asks"), F.col("_key"))).alias("request"),
        F.min_by(F.when(~F.col("_asks"), F.col("_key")), F.when(~F.col("_asks"), at)).alias("response"),
    )
    return pairs.filter(F.col("request").isNotNull())
