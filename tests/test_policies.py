"""Levels with hysteresis and tiers of sources against plain loops."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F
from tidemark.operators import hysteresis, policy, quarantine, tiers
from tidemark.plans import policies
from tidemark.streaming.quarantine import STORE, decided_stream

START = datetime.datetime(2026, 1, 1)


def minutes(n):
    return START + datetime.timedelta(minutes=n)


def followed(rows, levels):
    out, state = {}, {}
    for record, at, i, seen in sorted((r for r in rows if r[1]), key=lambda r: (r[1], r[2])):
        level, low = state.get(record, (None, None))
        if seen is not None and 0 <= seen < levels:
            if level is None or seen >= level:
                level, low = seen, None
            elif low is None:
                low = seen
            else:
                level, low = max(low, seen), None
        state[record] = level, low
        out[i] = level
    return out


@pytest.mark.parametrize("parts", [1, 6])
def test_levels_of_a_record_over_many_partitions(spark, parts):
    """One record holds most rows, so it fills partitions, and its level goes on from one to the next."""
    rng = random.Random(parts)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), minutes(rng.randint(0, 900)), i, rng.choice([None, 0, 0, 1, 1, 2, 3, 7, -1])) for i in range(3000)] + [("a", None, 9999, 1)]
    df = spark.createDataFrame(rows, "record string, at timestamp, id long, seen int")
    out = hysteresis.levels_after(df, "record", "at", "id", "seen", 4, parts)
    assert {r["id"]: r["level"] for r in out.collect()} == followed(rows, 4)
    held = out.groupBy(F.spark_partition_id()).agg(F.count_if(F.col("record") == "hot").alias("n")).collect()
    assert parts == 1 or max(r["n"] for r in held) < 1200
    assert hysteresis.levels_after(df.limit(0), "record", "at", "id", "seen", 4).count() == 0


def test_a_record_that_wavers_is_frozen(spark):
    day = hysteresis.DAY
    seen = [(0, 3), (1, 1), (2, 1), (3, 3), (4, 2), (5, 2), (6, 3), (20, 3), (33, 3), (99, 0), (100, 0)]
    df = spark.createDataFrame([("r", START + datetime.timedelta(days=d), i, s) for i, (d, s) in enumerate(seen)], "record string, at timestamp, id long, seen int")
    rows = hysteresis.shown_levels(hysteresis.levels_after(df, "record", "at", "id", "seen", 4), "record", "at", "id", 3, 56 * day, 28 * day).orderBy("id").collect()
    assert [r["level"] for r in rows] == [3, 3, 1, 3, 3, 2, 3, 3, 3, 3, 0]
    # Changes on days 2, 3 and 5 freeze it until 28 days after that of day 6.
    assert [r["frozen"] for r in rows] == [False] * 5 + [True, True, True, True, False, False]
    assert [r["shown"] for r in rows] == [3, 3, 1, 3, 3, 2, 2, 2, 2, 3, 0]


def test_last_within(spark):
    rng = random.Random(3)
    left = [(i, rng.choice(["a", "b", None]), minutes(rng.randint(0, 500)) if i % 17 else None) for i in range(300)]
    right = [(i, rng.choice(["a", "a", "b", None]), minutes(rng.randint(0, 500)) if i % 13 else None, rng.choice("xyz")) for i in range(200)]
    a, b = spark.createDataFrame(left, "n long, k string, at timestamp"), spark.createDataFrame(right, "m long, k string, at timestamp, v string")
    for seconds in (60, 1800, 10**9):
        out = tiers.last_within(a, b, ["k"], "at", seconds, ["m"], "found")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Join" not in plan
        got = {r["n"]: r["found"] and r["found"]["m"] for r in out.collect()}
        for n, k, at in left:
            fits = [(t, m) for m, key, t, _ in right if k and at and key == k and t and t <= at and (at - t).total_seconds() <= seconds]
            assert got[n] == (max(fits)[1] if fits else None)


def test_tiers_that_differ(spark):
    days = lambda n: START + datetime.timedelta(days=n)
    date = lambda n: datetime.date(2026, 5, n)
    seen = [("a", "T0", days(9.5), date(1), 0), ("a", "T2", days(9.9), date(3), 1), ("b", "T0", days(9.9), date(1), 2), ("b", "T2", days(9), date(3), 3), ("c", "T2", days(-50), date(1), 4), ("d", "T0", days(9.5), date(4), 5), ("d", "T2", days(9.9), date(3), 6), ("e", "T4", days(9), date(1), 7)]
    claims = [(f"{r}{k}", r, days(10), f"R{k}") for r in "abcdef" for k in (0, 2, 3)] + [("x", None, days(10), "R0"), ("y", "a", days(10), "R9")]
    out = tiers.tiered(spark.createDataFrame(claims, "id string, record string, at timestamp, risk string"), spark.createDataFrame(seen, "record string, tier string, at timestamp, day date, n long"), tiers.staleness(spark), "record", "at", "risk", "tier", "day", "n")
    got = {r["id"]: (r["tier"], r["n_sources"], r["n_differ"], r["decision"]) for r in out.collect()}
    assert got["a0"] == ("T0", 2, 1, "hold")  # a newer, weaker source tells of a later day
    assert got["a3"] == ("T0", 1, 0, "use")  # which is no source for the highest risk
    assert got["b0"] == ("T0", 2, 1, "use") and got["d0"] == ("T0", 2, 1, "use")
    assert got["c0"] == ("T2", 1, 0, "use") and got["c2"] == (None, 0, 0, "none")
    assert {got[k][3] for k in ("e0", "f2", "x", "y")} == {"none"} and len(got) == len(claims)


def test_brakes_on_the_events_as_a_stream(spark, tmp_path):
    """The registered query and its stream over the same table."""
    for k, v in STORE.items():
        spark.conf.set(k, v)
    sf = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    changes = policies.changes_of(events)
    changes.repartition(3, "event_id").write.parquet(source)
    end = spark.createDataFrame([(-1, "end", START + datetime.timedelta(days=999), "clear", None, -1)], changes.schema)
    for n in range(2):
        stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 2).parquet(source)
        decided_stream(stream, *policies.BRAKED, "60 days", policies.BRAKES).writeStream.option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination()
        if not n:
            end.write.mode("append").parquet(source)
    got = sorted((r["event_id"], r["decision"]) for r in spark.read.parquet(out).filter("user_id <> -1").collect())
    assert got == sorted((r["event_id"], r["decision"]) for r in policies.change_brakes(spark, sf).collect())
    assert isinstance(policies.BRAKES, quarantine.Brakes)


def test_the_most_specific_rule_decides(spark):
    """Every cell of the matrix, and a rule more without code."""
    import itertools

    values = [("VERIFIED", "UNCONFIRMED", "UNREACHABLE", "REJECTED_SOURCE", "ODD", None), ("CONFIRMED", "UNSURE", "REFUTED", None), ("R0", "R1", "R2", "R3", "R4"), ("safe", "risk", "extension"), ("agrees", "differs"), ("grounded", None)]
    cells = list(itertools.product(*values))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cells)], "i int, " + ", ".join(f"{c} string" for c in policy.LOOKS))

    def plainly(rules):
        out = {}
        for i, cell in enumerate(cells):
            fits = [(r.count("*"), n, r[-1]) for n, r in enumerate(rules) if all(x in ("*", v) for x, v in zip(r, cell, strict=False))]
            out[i] = min(fits)[1:] if fits else (None, None)
        return out

    more = (*policy.MATRIX, ("*", "*", "R4", "*", "*", "*", "DISCARD"), ("ODD", "*", "*", "*", "*", "*", "APPLY"), ("ODD", "*", "*", "*", "*", "*", "HOLD"))
    for rules in (policy.MATRIX, more, policy.MATRIX[:3], ()):
        out = policy.decide(df, policy.rules_table(spark, rules))
        assert {r["i"]: (r["rule"], r["decision"]) for r in out.collect()} == plainly(rules)


def test_directions_and_risks(spark):
    at = lambda n: START + datetime.timedelta(days=n)
    rows = [(at(0), at(0), None, 50), (at(0), at(-3), None, 50), (None, at(3), None, 50), (None, None, None, None), (at(0), at(30), True, 50), (at(0), at(31), True, 50), (at(0), at(5), False, 45), (at(0), None, True, 60), (at(0), at(30) + datetime.timedelta(minutes=1), True, 10)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a timestamp, b timestamp, token boolean, days int")
    a, b = F.col("a"), F.col("b")
    out = df.select("i", policy.direction(a, b, F.col("token")).alias("d"), policy.risk_tier(a, b, ~a.eqNullSafe(b), a.isNotNull() & b.isNull(), F.col("days")).alias("t")).orderBy("i").collect()
    assert [r["d"] for r in out] == ["safe", "safe", "safe", "safe", "extension", "risk", "risk", "risk", "risk"]
    assert [r["t"] for r in out] == ["R1", "R2", "R0", "R1", "R2", "R2", "R3", "R4", "R3"]


def test_rates_of_no_and_of_much_history(spark):
    """A venue without editions has its group's rate, one with very many its own."""
    rng = random.Random(4)
    rows = [(f"v{i}", "g", rng.random() < 0.3 + 0.4 * (i % 2)) for i in range(60) for _ in range(6)] + [("long", "g", i % 10 == 0) for i in range(20_000)] + [("none", "g", None), (None, "g", True)]
    rows += [("never", "n", False)] * 5 + [("other", "n", False)] * 2 + [("one", "s", True), ("alone", None, True), ("alone", None, False)]
    out = {r["venue"]: r for r in policy.shrunk_rates(spark.createDataFrame(rows, "venue string, grp string, has boolean"), "venue", "grp", "has").collect()}
    means = [r["a"] / r["n"] for r in out.values() if r["grp"] == "g" and r["n"]]
    assert abs(out["none"]["rate"] - sum(means) / len(means)) < 1e-9 and out["none"]["n"] == 0 and out["none"]["prior"] == "NEUTRAL"
    assert abs(out["long"]["rate"] - 0.1) < 1e-3 and out["long"]["prior"] == "NEUTRAL"
    for r in out.values():
        if r["n"]:
            low, high = sorted((r["a"] / r["n"], sum(means) / len(means) if r["grp"] == "g" else r["a"] / r["n"]))
            assert low - 1e-9 <= r["rate"] <= high + 1e-9 or r["grp"] != "g"
    assert out["never"]["rate"] == 0 and out["never"]["prior"] == "SUPPORTS" and out["other"]["prior"] == "NEUTRAL" and out["one"]["prior"] == "OPPOSES" and None not in out
    assert out["alone"]["prior"] == "OPPOSES"
