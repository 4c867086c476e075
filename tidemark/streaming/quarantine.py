"""The brakes on changes as a stream: changes wait in state until the watermark has passed them, and are then decided in order."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.operators.quarantine import Brakes, Record

#: The state store that keyed state with timers needs.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
WAITING = "at bigint, tie bigint, field string, kind string, value string"


class Decider(StatefulProcessor):
    """Keeps a record's undecided changes and its bounded history; a timer stands at the first undecided one."""

    def __init__(self, brakes: Brakes) -> None:
        self.brakes = brakes

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.record = handle.getValueState("record", "said string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        # By position, as the frames have no names: record, tie, at, field, kind, value, time.
        new = [(int(a), int(t), f, k, None if pd.isna(v) else v) for part in rows if len(part) for _, t, a, f, k, v, _ in part.itertuples(index=False, name=None)]
        if not new:
            return
        self.waiting.appendList(new)
        # One timer per millisecond at most; one that finds nothing left does nothing.
        known = set(self.handle.listTimers())
        first = min(r[0] for r in new) // 1000
        if not known or first < min(known):
            self.handle.registerTimer(first)
        yield from ()  # nothing is decided before the watermark has passed

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        until = timerValues.getCurrentWatermarkInMs() * 1000
        rows = sorted(tuple(r) for r in self.waiting.get()) if self.waiting.exists() else []
        ready, left = [r for r in rows if r[0] <= until], [r for r in rows if r[0] > until]
        if left:
            self.waiting.put(left)
            self.handle.registerTimer(left[0][0] // 1000)
        else:
            self.waiting.clear()
        if ready:
            before = self.record.get() if self.record.exists() else None
            now = Record(before[0] if before else None)
            said = [now.step(self.brakes, *(r[0], *r[2:])) for r in ready]
            self.record.update((now.said(),))
            yield pd.DataFrame({"_record": [key[0]] * len(ready), "_tie": [r[1] for r in ready], "_field": [r[2] for r in ready], "decision": said})

    def close(self) -> None:
        pass


def decided_stream(changes: DataFrame, record: str, field: str, at: str, kind: str, value: str, tie: str, late: str, brakes: Brakes | None = None) -> DataFrame:
    """The stream's twin of :func:`tidemark.operators.quarantine.decided`, for changes that are at most ``late`` late.

    The rows are those of the batch, whatever the cut into micro-batches and whatever restarts there are; a change is
    decided once the watermark has passed its time. The session needs the settings of ``STORE``.
    """
    plain = [F.col(record).alias("_record"), F.col(tie).cast("bigint").alias("_tie"), F.unix_micros(F.col(at).cast("timestamp")).alias("_at"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((field, "_field"), (kind, "_kind"))], F.col(value).cast("string").alias("_value")]
    rows = changes.filter(F.col(at).isNotNull()).select(*plain, F.col(at).cast("timestamp").alias("_time")).withWatermark("_time", late)
    kind_of = rows.schema["_record"].dataType.simpleString()
    out = rows.groupBy("_record").transformWithStateInPandas(Decider(brakes or Brakes()), f"_record {kind_of}, _tie bigint, _field string, decision string", "Append", "EventTime")
    return out.select(F.col("_record").alias(record), F.col("_tie").alias(tie), F.col("_field").alias(field), "decision")
