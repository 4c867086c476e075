"""A record's level over its observations: quick to rise, slow to fall, and frozen when it wavers.

An observation of a higher level raises a record at once, as it carries proof. A lower one has to be confirmed by
the next that counts, and then the record falls to the higher of the two. Observations that saw nothing change nothing.

The rule is a machine of few states, so a stretch of observations is a function from states to states, held as an
array, and stretches combine by indexing. Rows are sorted over all partitions by record and time, whatever the
size of a record; each partition gives the function of each record's stretch in it, the few stretches of a record are
combined in order, and a second pass starts each stretch in its state. No record has to be read in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.sources.versions import scratch

#: Fixed values, in days: so many changes within the first freeze a record, until it was stable for the second.
CHANGES, WAVER_DAYS, STABLE_DAYS = 3, 56, 28
DAY = 86_400_000_000


class Machine:
    """States are a level and the lower level that was seen last, if that waits for its confirmation; state 0 knows nothing yet."""

    def __init__(self, levels: int) -> None:
        self.states = [(-1, -1), *((level, low) for level in range(levels) for low in range(-1, level))]
        number = {s: i for i, s in enumerate(self.states)}
        #: Per observed level the state that follows each state; the last row is for observations that saw nothing.
        self.moves = np.array([[number[self.after(*s, seen)] for s in self.states] for seen in range(levels)] + [list(range(len(self.states)))], np.int32)
        self.level = np.array([s[0] for s in self.states], np.int32)

    @staticmethod
    def after(level: int, low: int, seen: int) -> tuple[int, int]:
        if seen >= level:
            return seen, -1
        return (level, seen) if low < 0 else (max(low, seen), -1)


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, object, pa.RecordBatch]]:
    """Runs of rows of one record: whether it is a new one, the record, and the rows. The first column is the record."""
    last, fresh = None, True
    for batch in batches:
        keys = batch.column(0).to_pylist()
        edges = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        for low, high in zip([0, *edges], [*edges, len(keys)], strict=True):
            if low < high:
                yield fresh or keys[low] != last, keys[low], batch.slice(low, high - low)
                last, fresh = keys[low], False


def levels_after(observations: DataFrame, record: str, at: str, tie: str, seen: str, levels: int, parts: int | None = None) -> DataFrame:
    """``observations`` as record, tie, at, seen and ``level``, the record's level after each; null before the first that saw something.

    ``seen`` is a whole number from 0 to ``levels`` - 1, null or any other for an observation that saw nothing. Rows are taken by
    time and ``tie``; those without a time take no part, null records are one record. A repeated row counts again.
    ``parts`` is the number of partitions that all rows are sorted into, by default the session's for shuffles.
    """
    spark, machine = observations.sparkSession, Machine(levels)
    rows = observations.filter(F.col(at).isNotNull()).select(F.col(record).alias("_record"), F.col(at).alias("_at"), F.col(tie).alias("_tie"), F.coalesce(F.when(F.col(seen).between(0, levels - 1), F.col(seen)), F.lit(levels)).cast("int").alias("_seen"))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    rows = rows.repartitionByRange(parts, "_record", "_at", "_tie").sortWithinPartitions("_record", "_at", "_tie")
    # Both passes have to find the same rows in the same partitions.
    scratch(spark)  # sets the folder of checkpoints
    rows = rows.checkpoint()
    number = F.spark_partition_id().alias("_part")
    kind, rows_type = rows.schema["_record"].dataType.simpleString(), to_arrow_type(rows.schema["_record"].dataType)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, maps = 0, [], []
        for new, key, run in _stretches(batches):
            part = run.column(2)[0].as_py()
            if new:
                keys.append(key)
                maps.append(np.arange(len(machine.states), dtype=np.int32))
            for move in machine.moves[run.column(1).to_numpy()]:
                maps[-1] = move[maps[-1]]
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(keys, rows_type), pa.array([part] * len(keys), pa.int32()), pa.array([m.tolist() for m in maps], pa.list_(pa.int32()))], ["_record", "_part", "_map"])

    found = rows.select("_record", "_seen", number).mapInArrow(combine, f"_record {kind}, _part int, _map array<int>")
    # At most one row per partition and record; a record that fills partitions has as many rows as these.
    order = Window.partitionBy("_record").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    through = F.aggregate(F.coalesce(F.collect_list("_map").over(order), F.array().cast("array<array<int>>")), F.lit(0), lambda s, m: F.get(m, s))
    starts = found.select(F.col("_record").alias("_of"), F.col("_part").alias("_in"), through.alias("_start"))
    # Only a partition's first record can have begun before it, so the few other starts are all 0.
    starts = {r["_in"]: r["_start"] for r in starts.filter("_start <> 0").select("_in", "_start").collect()}

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, first = 0, True
        for new, _, run in _stretches(batches):
            if new:
                state, first = (starts.get(run.column(4)[0].as_py(), 0) if first else 0), False
            out = np.zeros(run.num_rows, np.int32)
            for i, move in enumerate(machine.moves[run.column(3).to_numpy()]):
                state = move[state]
                out[i] = machine.level[state]
            yield pa.RecordBatch.from_arrays([*run.columns[:4], pa.array(out, mask=out < 0)], ["_record", "_at", "_tie", "_seen", "level"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    out = rows.select("*", number).mapInArrow(follow, f"{fields}, level int")
    return out.select(F.col("_record").alias(record), F.col("_tie").alias(tie), F.col("_at").alias(at), F.when(F.col("_seen") < levels, F.col("_seen")).alias(seen), "level")


def shown_levels(levelled: DataFrame, record: str, at: str, tie: str, most: int = CHANGES, waver: int = WAVER_DAYS * DAY, stable: int = STABLE_DAYS * DAY) -> DataFrame:
    """``levelled`` (see :func:`levels_after`) with ``frozen`` and ``shown``, the level that is shown.

    ``most`` changes within ``waver`` microseconds freeze a record, from the last of them until ``stable`` have passed
    without one; meanwhile the lowest level since the freeze began is shown. Only a record's changes are looked at
    over time, one window; observations take theirs from the change before.
    """
    order = Window.partitionBy(record).orderBy("_us", tie)
    rows = levelled.withColumn("_us", F.unix_micros(F.col(at).cast("timestamp")))
    before = F.col("_before")
    rows = rows.withColumn("_before", F.lag("level").over(order)).withColumn("_change", F.col("level").isNotNull() & before.isNotNull() & (before != F.col("level")))
    changed = F.when(F.col("_change"), F.col("_us"))
    rows = rows.withColumn("_near", F.sum(F.col("_change").cast("int")).over(Window.partitionBy(record).orderBy("_us").rangeBetween(-waver, 0)))
    last = F.last(changed, True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    # A run of changes ends when the record was stable for long enough.
    rows = rows.withColumn("_run", F.sum(F.when(F.col("_change") & (last.isNull() | (F.col("_us") - last >= stable)), 1).otherwise(0)).over(order))
    rows = rows.withColumn("_since", F.last(changed, True).over(order))
    inside = Window.partitionBy(record, "_run").orderBy("_us", tie)
    begun = F.max((F.col("_change") & (F.col("_near") >= most)).cast("int")).over(inside) == 1
    rows = rows.withColumn("frozen", F.coalesce(begun & (F.col("_us") - F.col("_since") < stable), F.lit(False)))
    # A change that freezes leaves the lower of its two levels.
    lowest = F.min(F.when(F.col("frozen"), F.when(F.col("_change"), F.least("level", "_before")).otherwise(F.col("level")))).over(inside)
    return rows.withColumn("shown", F.when(F.col("frozen"), lowest).otherwise(F.col("level"))).drop("_us", "_before", "_change", "_near", "_run", "_since")
