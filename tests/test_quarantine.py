"""Brakes on changes: the batch against plain rules, and the stream against the batch."""

from __future__ import annotations

import datetime
import random

import pytest
from tidemark.operators import quarantine
from tidemark.operators.quarantine import Brakes
from tidemark.streaming.quarantine import STORE, decided_stream

NAMES = ("record", "field", "at", "kind", "value", "id")
SCHEMA = "record long, field string, at timestamp, kind string, value string, id long"
START = datetime.datetime(2026, 1, 1)


def day(n):
    return START + datetime.timedelta(days=n)


def decisions(spark, rows, **more):
    return {r["id"]: r["decision"] for r in quarantine.decided(spark.createDataFrame(rows, SCHEMA), *NAMES, **more).collect()}


def test_a_field_that_goes_back_and_forth(spark):
    rows = [(1, "deadline", day(n), "apply", v, i) for i, (n, v) in enumerate([(0, "a"), (14, "b"), (20, "c"), (28, "a"), (42, "b"), (60, "c"), (61, "a")])]
    rows += [(1, "deadline", day(62), "clear", None, 7), (1, "deadline", day(70), "apply", "d", 8), (1, "place", day(84), "apply", "x", 9), (2, "deadline", day(1), "apply", "a", 10), (2, "deadline", day(2), "apply", "a", 11), (2, "deadline", None, "apply", "z", 12)]
    out = decisions(spark, rows)
    assert [out[i] for i in range(12)] == ["applied", "applied", "resting", "reverted", "closing", "closed", "closed", "cleared", "applied", "applied", "applied", "unchanged"]
    assert 12 not in out


def test_reverts_out_of_the_window_do_not_count(spark):
    rows = [(1, "f", day(n), "apply", v, i) for i, (n, v) in enumerate([(0, "a"), (20, "b"), (40, "a"), (75, "b"), (110, "a"), (111, "b")])]
    # A value that ended more than the window ago is a new one.
    assert list(dict(sorted(decisions(spark, rows).items())).values()) == ["applied", "applied", "reverted", "applied", "applied", "resting"]


def plainly(rows, window, rest, reverts):
    """Each change decided from the list of all decisions before it."""
    done = []  # record, field, at, value, decision, id
    for record, field, at, kind, value, i in sorted((r for r in rows if r[2]), key=lambda r: (r[2], r[5])):
        own = [d for d in done if d[:2] == (record, field)]
        took = [d for d in own if d[4] in ("applied", "reverted", "closing")]
        cleared = max((n for n, d in enumerate(own) if d[4] == "cleared"), default=-1)
        since = own[cleared + 1 :]
        ended = [(a[3], b[2]) for a, b in zip(took, took[1:], strict=False)]
        if kind == "clear":
            said = "cleared"
        elif any(d[4] == "closing" for d in since):
            said = "closed"
        elif took and took[-1][3] == value:
            said = "unchanged"
        elif any(d[0] == record and d[4] in ("applied", "reverted", "closing") and at - d[2] < rest for d in done):
            said = "resting"
        elif any(v == value and at - t <= window for v, t in ended):
            n = sum(d[4] == "reverted" and at - d[2] <= window for d in since)
            said = "closing" if n + 1 >= reverts else "reverted"
        else:
            said = "applied"
        done.append((record, field, at, value, said, i))
    return {d[5]: d[4] for d in done}


@pytest.fixture(scope="module")
def changes():
    rng = random.Random(2)
    rows = [(rng.choice([1, 2, 3, 4, None]), rng.choice(["f", "g", None]), START + datetime.timedelta(minutes=rng.randint(0, 60_000)), rng.choice(["apply"] * 12 + ["clear"]), rng.choice(["a", "b", None]), i) for i in range(600)]
    return [*rows, *[(9, "f", START + datetime.timedelta(minutes=40 * i), "apply", "ab"[i % 2], 1000 + i) for i in range(400)]]


BRAKES = Brakes(window=5 * 86_400_000_000, rest=3_600_000_000, reverts=3)


def test_the_batch_against_plain_rules(spark, changes):
    out = decisions(spark, changes, brakes=BRAKES)
    want = plainly(changes, datetime.timedelta(days=5), datetime.timedelta(hours=1), 3)
    assert out == want and set(want.values()) == {"applied", "reverted", "closing", "closed", "unchanged", "resting", "cleared"}
    assert decisions(spark, changes[::-1], brakes=BRAKES) == out
    assert quarantine.decided(spark.createDataFrame([], SCHEMA), *NAMES).count() == 0


@pytest.mark.parametrize("cuts", [1, 4])
def test_the_stream_is_the_batch(spark, changes, tmp_path, cuts):
    """Under any cut into batches, after a restart, with rows out of order within what may be late."""
    for k, v in STORE.items():
        spark.conf.set(k, v)
    rng = random.Random(cuts)
    late = sorted(changes, key=lambda r: (r[2] + datetime.timedelta(hours=rng.randint(0, 40)), r[5]))
    parts = [late[i * len(late) // cuts : (i + 1) * len(late) // cuts] for i in range(cuts)]
    parts.append([(-1, "end", START + datetime.timedelta(days=900 + n), "clear", None, -n) for n in (1,)])
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for n, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        if n in (0, len(parts) - 1) or n % 2:
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
            decided_stream(stream, *NAMES, "2 days", BRAKES).writeStream.format("parquet").option("checkpointLocation", state).option("path", out).trigger(availableNow=True).start().awaitTermination()
    rows = [(r["record"], r["field"], r["id"], r["decision"]) for r in spark.read.parquet(out).collect() if r["record"] != -1]
    batch = [tuple(r[c] for c in ("record", "field", "id", "decision")) for r in quarantine.decided(spark.createDataFrame(changes, SCHEMA), *NAMES, BRAKES).collect()]
    assert sorted(rows, key=repr) == sorted(batch, key=repr)
