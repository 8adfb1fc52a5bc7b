import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from linkwright.operators.pairing import answer_within, fifo_pairs

START = datetime(2024, 1, 1)


def test_first_answer_within_the_limit(spark):
    rng = random.Random(2)
    asked = [(rng.choice("ab"), START + timedelta(seconds=rng.randint(0, 600)), i) for i in range(80)]
    given = [(rng.choice("abc"), START + timedelta(seconds=rng.randint(0, 600)), i) for i in range(60)]
    got = answer_within(
        spark.createDataFrame(asked, "user string, ts timestamp, request_id bigint"),
        spark.createDataFrame(given, "user string, ts timestamp, response_id bigint"), ["user"], 30)
    found = {r["request_id"]: (r["response_id"], r["status"]) for r in got.collect()}
    for user, ts, i in asked:
        near = sorted((t, j) for u, t, j in given if u == user and ts <= t <= ts + timedelta(seconds=30))
        assert found[i] == ((near[0][1], 200) if near else (None, 504))


def test_match_by_request_id(spark):
    asked = spark.createDataFrame([("r1", START, "r1"), ("r2", START, "r2"), ("r3", START, "r3")], "key string, ts timestamp, request_id string")
    late = START + timedelta(seconds=31)
    given = spark.createDataFrame([("r1", START + timedelta(seconds=30), "x"), ("r2", late, "y")], "key string, ts timestamp, response_id string")
    got = {r["request_id"]: (r["response_id"], r["status"]) for r in answer_within(asked, given, ["key"], 30).collect()}
    assert got == {"r1": ("x", 200), "r2": (None, 504), "r3": (None, 504)}


def queue(messages):
    waiting, out = [], {}
    for turn, asks in messages:
        if asks:
            waiting.append(turn)
            out[turn] = None
        elif waiting:
            out[waiting.pop(0)] = turn
    return out


def test_fifo_pairs_follow_a_queue(spark):
    rng = random.Random(4)
    sessions = {s: [(t, rng.random() < 0.5) for t in range(rng.randint(1, 60))] for s in range(30)}
    data = [(s, t, a) for s, m in sessions.items() for t, a in m]
    df = spark.createDataFrame(data, "s bigint, turn bigint, asks boolean")
    for width in (5, 1000):
        got = {}
        for r in fifo_pairs(df, "s", "turn", F.col("asks"), F.floor(F.col("turn") / width), "turn").collect():
            got.setdefault(r["s"], {})[r["request"]] = r["response"]
        assert got == {s: queue(m) for s, m in sessions.items() if any(a for _, a in m)}
