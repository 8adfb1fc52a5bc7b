"""Column names that a frame does not have yet, for columns that an operator adds and takes away again."""

from __future__ import annotations

from itertools import count, islice

from pyspark.sql import DataFrame


def free_names(df: DataFrame, n: int) -> list[str]:
    """``n`` names that differ from all columns of ``df``, in upper or lower case."""
    taken = {c.lower() for c in df.columns}
    return list(islice((name for name in (f"own_{k}" for k in count()) if name not in taken), n))
