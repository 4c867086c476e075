"""Brakes on changes that apply themselves: a pause after each, and a stop for a field that goes back and forth.

Changes of a record are decided in the order of their times. A record that has changed is left alone for a while; a
field whose changes go back, often enough within a window, to values that it has held in that window is closed until
somebody clears it. What is kept of a record is bounded by the window. The batch and the stream (see
``tidemark.streaming.quarantine``) take the same step.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values, in days: reverts count within the first, a record rests for the second; so many reverts close a field.
WINDOW_DAYS, REST_DAYS, REVERTS = 28, 14, 2
DAY = 86_400_000_000


@dataclass(frozen=True)
class Brakes:
    """Microseconds of the window and of the pause, and the reverts that close a field."""

    window: int = WINDOW_DAYS * DAY
    rest: int = REST_DAYS * DAY
    reverts: int = REVERTS


class Record:
    """What has to be known of a record to decide its next change."""

    def __init__(self, said: str | None = None) -> None:
        x = json.loads(said) if said else {}
        self.last: int | None = x.get("last")
        #: Per field: the value it has, earlier ones with the time when each ended, the times of reverts, and whether it is closed.
        self.fields: dict[str, dict] = x.get("fields", {})

    def said(self) -> str:
        return json.dumps({"last": self.last, "fields": self.fields}, sort_keys=True)

    def step(self, brakes: Brakes, at: int, field: str, kind: str, value: str | None) -> str:
        """Decides a change and takes it in: applied, reverted, closing, or not, for being unchanged, resting or closed; or cleared."""
        f = self.fields.setdefault(field, {"has": None, "any": False, "before": [], "reverts": [], "closed": False})
        if kind == "clear":
            f.update(reverts=[], closed=False)
            return "cleared"
        f["before"] = [[v, t] for v, t in f["before"] if at - t <= brakes.window]
        f["reverts"] = [t for t in f["reverts"] if at - t <= brakes.window]
        if f["closed"]:
            return "closed"
        if f["any"] and value == f["has"]:
            return "unchanged"
        if self.last is not None and at - self.last < brakes.rest:
            return "resting"
        back = any(v == value for v, _ in f["before"])
        if f["any"]:
            f["before"] = [[v, t] for v, t in f["before"] if v != f["has"]] + [[f["has"], at]]
        f.update(has=value, any=True)
        self.last = at
        if not back:
            return "applied"
        f["reverts"].append(at)
        f["closed"] = len(f["reverts"]) >= brakes.reverts
        return "closing" if f["closed"] else "reverted"


def decided(changes: DataFrame, record: str, field: str, at: str, kind: str, value: str, tie: str, brakes: Brakes | None = None) -> DataFrame:
    """``changes`` as record, tie, field and ``decision``; ``kind`` is ``apply`` or ``clear``, any other is an apply.

    Changes of a record are taken by time and then by ``tie``, which is whole numbers; rows without a time take no
    part. Null records are one record, null fields one field, and a null value is a value. A record's changes pass one
    task in order, as each depends on those before, but are never held there: only its bounded state is.
    """
    brakes = brakes or Brakes()
    plain = [F.col(record).alias("_record"), F.col(tie).cast("bigint").alias("_tie"), F.unix_micros(F.col(at).cast("timestamp")).alias("_at"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((field, "_field"), (kind, "_kind"))], F.col(value).cast("string").alias("_value")]
    rows = changes.select(*plain).filter("_at IS NOT NULL")
    rows = rows.repartition("_record").sortWithinPartitions("_record", "_at", "_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = object(), Record()
        for batch in batches:
            out = []
            for r, at_, f, k, v in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5)), strict=True):
                if r != key:
                    key, now = r, Record()
                out.append(now.step(brakes, at_, f, k, v))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(out, pa.string())], ["_record", "_tie", "_field", "decision"])

    kind_of = rows.schema["_record"].dataType.simpleString()
    out = rows.mapInArrow(run, f"_record {kind_of}, _tie bigint, _field string, decision string")
    return out.select(F.col("_record").alias(record), F.col("_tie").alias(tie), F.col("_field").alias(field), "decision")
