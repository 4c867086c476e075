"""Gap clusters as a stream: sessions that close once the watermark has passed them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def gap_sessions(rows: DataFrame, keys: list[str], time: str, seconds: int, late: str = "0 seconds") -> DataFrame:
    """Per key and cluster: first, last and n; a new cluster after a gap of more than ``seconds``, as :func:`tidemark.operators.clusters.gap_clusters` has them.

    The same for a table and a stream. Of a stream, a row may be ``late`` behind the newest; a cluster comes out once no such
    row can join it. Rows without a time are a cluster each, with no first and last, and come out at once.
    """
    stamp = F.col(time).cast("timestamp")
    timed = rows.filter(F.col(time).isNotNull()).select(*keys, stamp.alias("_at")).withWatermark("_at", late)
    by = timed.groupBy(*keys, F.session_window("_at", f"{seconds} seconds").alias("_window"))
    out = by.agg(F.min("_at").alias("first"), F.max("_at").alias("last"), F.count(F.lit(1)).alias("n")).drop("_window")
    none = F.lit(None).cast("timestamp")
    alone = rows.filter(F.col(time).isNull()).select(*keys, none.alias("first"), none.alias("last"), F.lit(1).cast("bigint").alias("n"))
    return out.select(*keys, "first", "last", "n").unionByName(alone)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them, of the batches that the query still knows."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
