"""How many parts a table is dealt into, where operators sort a part several times."""

from __future__ import annotations

from pyspark.sql import DataFrame


def in_parts(df: DataFrame, *keys: str, rows: int) -> DataFrame:
    """``df`` dealt by ``keys`` into parts of about ``rows`` rows, however large it is; one key stays in one part.

    Spark's own count of parts is fixed, and it joins small ones up to a size in the shuffle; windows in a row each hold
    a sort of the part, so that a task's memory would grow with the table. A stream is left as it is.
    """
    if df.isStreaming:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows)), *keys)
