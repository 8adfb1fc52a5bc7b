"""Request and response streams matched by id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkwright.operators.pairing import ANSWERED, TIMED_OUT

TIMEOUT_SECONDS = 30


def match_responses(requests: DataFrame, responses: DataFrame, seconds: int = TIMEOUT_SECONDS, late: str = "1 minute") -> DataFrame:
    """Left outer stream-stream join on ``request_id`` within the timeout, with a status.

    Both sides have request_id, text and a timestamp ts. The watermark bounds the state; a request
    is reported as timed out once the watermark has passed its deadline.
    """
    asked = requests.select("request_id", F.col("text").alias("request_text"), F.col("ts").alias("asked_at")).withWatermark("asked_at", late)
    given = responses.select(F.col("request_id").alias("_id"), F.col("text").alias("response_text"),
                             F.col("ts").alias("answered_at")).withWatermark("answered_at", late)
    within = (
        (F.col("request_id") == F.col("_id"))
        & (F.col("answered_at") >= F.col("asked_at"))
        & (F.col("answered_at") <= F.col("asked_at") + F.expr(f"INTERVAL {seconds} SECONDS"))
    )
    return asked.join(given, within, "left_outer").select(
        "request_id", "request_text", "asked_at", "response_text", "answered_at",
        F.when(F.col("answered_at").isNull(), TIMED_OUT).otherwise(ANSWERED).alias("status"),
    )
