"""Row-level change capture from a stream of row states."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


class LastRow(StatefulProcessor):
    """Keeps the last row of a key, with its ``seq``, and reports each step as INSERT, UPDATE or DELETE.

    A row with ``deleted`` ends the key; a delete of an unknown key is not a change. A row that comes in a later batch than
    one with its ``seq`` or a higher one has action LATE: what it changed is no longer known.
    """

    def __init__(self, key: str, columns: Sequence[str]) -> None:
        self._key, self._columns = key, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join(f"`{c}` string" for c in self._columns)
        self._last = handle.getValueState("last", f"seq bigint, deleted boolean, {fields}")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        names = ["seq", "deleted", *self._columns]
        batch = sorted((row for frame in rows for row in zip(*(frame[n].tolist() for n in names))), key=lambda row: row[0])
        last = tuple(self._last.get()) if self._last.exists() else None
        late = [row for row in batch if last is not None and row[0] <= last[0]]
        before, out = last, []
        for row in batch[len(late):]:  # sorted, so late rows come first
            had, has = before is not None and not before[1], not row[1]
            if had or has:
                action = "DELETE" if not has else "UPDATE" if had else "INSERT"
                out.append((row[0], before[2:] if had else None, row[2:] if has else None, action))
            before = row
        if len(batch) > len(late):
            self._last.update((int(before[0]), bool(before[1]), *[None if pd.isna(v) else v for v in before[2:]]))
        out += [(row[0], None, None if row[1] else row[2:], "LATE") for row in late]
        if not out:
            return
        columns = {self._key: key[0], "seq": [step[0] for step in out]}
        for k, c in enumerate(self._columns):
            for name, place in (("old", 1), ("new", 2)):
                columns[f"{name}_{c}"] = pd.Series([None if step[place] is None else step[place][k] for step in out], dtype=object)
        yield pd.DataFrame({**columns, "action": [step[3] for step in out]})

    def close(self) -> None:
        pass


def capture_changes(stream: DataFrame, key: str = "id", columns: Sequence[str] = ("question", "answer")) -> DataFrame:
    """Audit steps of a stream of (key, seq, deleted, columns), state kept per key: key, seq, old_*, new_*, action.

    Columns are compared and kept as texts. Needs the RocksDB state store. Within a batch the rows of a key are ordered here,
    so a key's rows of one batch are held together: bound the batch at the source (``files_per_trigger``).
    """
    kind = stream.schema[key].dataType.simpleString()
    pairs = ", ".join(f"`old_{c}` string, `new_{c}` string" for c in columns)
    rows = stream.select(key, F.col("seq").cast("bigint").alias("seq"), F.coalesce("deleted", F.lit(False)).alias("deleted"),
                         *[F.col(c).cast("string").alias(c) for c in columns])
    return rows.groupBy(key).transformWithStateInPandas(
        statefulProcessor=LastRow(key, columns), outputStructType=f"`{key}` {kind}, seq bigint, {pairs}, action string",
        outputMode="Append", timeMode="None")
