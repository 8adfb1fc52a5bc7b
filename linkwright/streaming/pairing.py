"""Requests and responses paired while they stream: within a time limit, or first in, first out.

Open requests wait in the state of their key, with a timer in event time. A clock row (null key, null ``asks``) moves the
time on where nothing else comes, so that a request is reported when its limit has passed and not with the next message.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from linkwright.operators.pairing import ANSWERED, TIMED_OUT


def answer_stream(messages: DataFrame, key: str, seconds: int, late: str = "1 minute") -> DataFrame:
    """Each request with the first response of its key in [ts, ts + seconds]: key, request_id, response_id, wait_seconds, status.

    ``messages`` has the key, ts, id and ``asks`` (a request, a response, or null for a clock row), in any order that
    ``late`` allows. A request is given out once, as soon as no earlier response can come any more: when the watermark has
    passed its first response (200), or its limit (504). A response may answer several requests.
    Rows that are later than the watermark are dropped. State per key: open requests, and the responses since the oldest of them.
    """
    width, id_kind = seconds * 1_000_000, dict(messages.dtypes)["id"]
    key_kind = dict(messages.dtypes)[key]
    rows = messages.withWatermark("ts", late).withColumn("us", F.unix_micros("ts"))

    def pair(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        asked: list[tuple] = []
        given: list[tuple] = []
        if state.exists:
            of = state.get
            asked, given = list(zip(of[0], of[1])), list(zip(of[2], of[3]))
        if not state.hasTimedOut:
            for frame in frames:
                for us, name, asks in zip(frame["us"].tolist(), frame["id"].tolist(), frame["asks"].tolist()):
                    if not pd.isna(asks):
                        (asked if asks else given).append((us, name))
        now = state.getCurrentWatermarkMs() * 1000
        asked.sort()
        given.sort()
        at = [us for us, _ in given]
        out, open_, next_due = [], [], None
        for us, name in asked:
            k = bisect_left(at, us)
            met = k < len(at) and at[k] <= us + width
            due = at[k] if met else us + width
            if due < now:
                out.append((group[0], name, given[k][1] if met else None, (at[k] - us) / 1e6 if met else None, ANSWERED if met else TIMED_OUT))
            else:
                open_.append((us, name))
                next_due = due if next_due is None else min(next_due, due)
        first = min([now, *(us for us, _ in open_)])
        given = [(us, name) for us, name in given if us >= first]
        if open_ or given:
            state.update(([u for u, _ in open_], [n for _, n in open_], [u for u, _ in given], [n for _, n in given]))
            wake = next_due if next_due is not None else given[-1][0]
            state.setTimeoutTimestamp(max(wake // 1000 + 1, now // 1000 + 1))
        elif state.exists:
            state.remove()
        if not out:
            return
        yield pd.DataFrame({
            key: pd.Series([r[0] for r in out], dtype=object), "request_id": pd.Series([r[1] for r in out], dtype=object),
            "response_id": pd.Series([r[2] for r in out], dtype=object), "wait_seconds": pd.Series([r[3] for r in out], dtype="float64"),
            "status": pd.Series([r[4] for r in out], dtype="int64")})

    return rows.select(key, "us", "id", "asks", "ts").groupBy(key).applyInPandasWithState(
        pair, f"{key} {key_kind}, request_id {id_kind}, response_id {id_kind}, wait_seconds double, status bigint",
        f"asked_us array<bigint>, asked array<{id_kind}>, given_us array<bigint>, given array<{id_kind}>",
        "append", GroupStateTimeout.EventTimeTimeout)


def fifo_stream(messages: DataFrame, session: str, order: str, idle: str, late: str = "0 seconds") -> DataFrame:
    """Each response with the oldest open request of its session: (session, n, request, response), n counting the requests.

    ``messages`` has the session, ``order``, ts, id and ``asks`` (null for a clock row). Messages of a session come in order
    from batch to batch; within a batch they are put in order. A response that comes when nothing is open is dropped. A pair
    is given out when the response comes; requests that are still open when the session has been ``idle`` come with a null
    response, and end the session. State per session: its open requests.
    """
    id_kind, kind = dict(messages.dtypes)["id"], dict(messages.dtypes)[session]
    wait = int(pd.Timedelta(idle).total_seconds() * 1000)
    rows = messages.withWatermark("ts", late).withColumn("ms", F.unix_millis("ts"))

    def pair(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_, count, last = [], 0, 0
        if state.exists:
            of = state.get
            open_, count, last = list(zip(of[0], of[1])), of[2], of[3]
        out = []
        if state.hasTimedOut:
            out = [(n, name, None) for n, name in open_]
            state.remove()
        else:
            came = []
            for frame in frames:
                came += (m for m in zip(frame[order].tolist(), frame["id"].tolist(), frame["asks"].tolist(), frame["ms"].tolist())
                         if not pd.isna(m[2]))
            first = 0
            for _, name, asks, ms in sorted(came, key=lambda m: m[:2]):
                last = max(last, ms)
                if asks:
                    count += 1
                    open_.append((count, name))
                elif first < len(open_):
                    out.append((*open_[first], name))
                    first += 1
            open_ = open_[first:]
            if came or state.exists:
                state.update(([n for n, _ in open_], [name for _, name in open_], count, last))
                state.setTimeoutTimestamp(max(last + wait, state.getCurrentWatermarkMs() + 1))
        if not out:
            return
        yield pd.DataFrame({
            session: pd.Series([group[0]] * len(out), dtype=object), "n": pd.Series([r[0] for r in out], dtype="int64"),
            "request": pd.Series([r[1] for r in out], dtype=object), "response": pd.Series([r[2] for r in out], dtype=object)})

    return rows.select(session, order, "id", "asks", "ms", "ts").groupBy(session).applyInPandasWithState(
        pair, f"{session} {kind}, n bigint, request {id_kind}, response {id_kind}",
        f"open_n array<bigint>, open array<{id_kind}>, asked bigint, last_ms bigint", "append", GroupStateTimeout.EventTimeTimeout)
