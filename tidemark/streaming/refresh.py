"""The refresh as a stream: candidates arrive, each batch is merged and only changed partitions are written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import layered_merge
from tidemark.sources.versions import read_version, version_at, write_version


def newest(batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The newest candidate per key of a batch; of equally new ones that of the greatest values, nulls last."""
    rest = [F.desc_nulls_last(c) for c in sorted(batch.columns) if c not in (*keys, order)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order), *rest))
    return batch.withColumn("_n", rank).filter("_n = 1").drop("_n")


def merge_batch(path: str, overrides: Callable[[], DataFrame], keys: list[str], fields: list[str], order: str, partition: str, name: str = "batch") -> Callable[[DataFrame, int], None]:
    """What to do with each batch: merge it with what is stored in its partitions, and write those that change.

    ``partition`` is one of the keys. Only the partitions of the batch and of the overrides are read and
    compared. A batch is a run of its own name, so one that is seen again finds its version and changes nothing:
    a query that restarts after a failure ends where it would have ended without one. A query that begins anew, with
    a new checkpoint, counts its batches from 0 again and needs another ``name``.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark, columns = batch.sparkSession, [*keys, *fields]
        found, over = newest(batch, keys, order).select(*columns), overrides()
        touched = found.select(partition).unionByName(over.select(partition)).distinct()
        if version_at(spark, path):
            wanted = touched.select(F.col(partition).alias("_wanted"))
            stored = read_version(spark, path).join(wanted, F.col(partition).eqNullSafe(F.col("_wanted")), "left_semi").select(*columns)
        else:  # the first batch
            stored = found.limit(0)
        merged = layered_merge(stored, found, over, keys, fields).select(*columns)
        write_version(merged, path, [partition], run=f"{name}-{number}", touched=touched if version_at(spark, path) else None)

    return run


def refresh(candidates: DataFrame, checkpoint: str, run: Callable[[DataFrame, int], None], available_now: bool = True) -> StreamingQuery:
    """Starts the refresh of a stream of candidates; by default it ends when all that is there has been merged."""
    writer = candidates.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
