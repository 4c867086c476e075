"""Sources that mirror each other count once."""

from __future__ import annotations

import datetime
import random

from tidemark.operators import corroboration


def at(n):
    return datetime.date(2026, 1, 1) + datetime.timedelta(days=n)


SAID = "source string, record int, text string, at date"


def test_mirrors_are_found_from_the_first_source_of_a_text(spark):
    rows = [("a", i, f"text {i}", at(i)) for i in range(10)]
    rows += [("mirror", i, f"text {i}", at(i + 1)) for i in range(9)] + [("mirror", 20, "of its own", at(0))]
    rows += [("half", i, f"text {i}", at(50)) for i in range(5)] + [("half", i, "own words", at(1)) for i in range(5)]
    rows += [("few", i, f"text {i}", at(60)) for i in range(2)] + [("a", 0, "text 0", at(99)), (None, 1, "text 1", at(0)), ("late", 1, None, at(0)), ("late", 3, "text 3", None)]
    rows += [("second", i, f"text {i}", at(i + 2)) for i in range(10)]
    out = {tuple(r) for r in corroboration.copied_from(spark.createDataFrame(rows, SAID), "source", "record", "text", "at").collect()}
    assert out == {("mirror", "a"), ("second", "a")}


def test_groups_of_long_chains(spark):
    rng = random.Random(1)
    names = [f"n{i:03d}" for i in range(150)]
    rng.shuffle(names)
    links = [*zip(names[:100], names[1:100], strict=False), (names[120], names[121]), (names[121], names[120]), (names[130], names[130]), (None, names[0])]
    got = {r["node"]: r["group"] for r in corroboration.connected(spark.createDataFrame(links, "u string, v string")).collect()}
    assert {got[n] for n in names[:100]} == {min(names[:100])} and got[names[120]] == got[names[121]] == min(names[120:122]) and len(got) == 102
    assert corroboration.connected(spark.createDataFrame([], "u string, v string")).count() == 0


def test_states(spark):
    tiers = {"own": "T0", "list": "T2", "copy": "T2", "press": "T3", "track": "T4"}
    who = spark.createDataFrame([(s, t, "list.example" if s in ("list", "copy") else None) for s, t in tiers.items()], "source string, tier string, domain string")
    groups = corroboration.independent(who, spark.createDataFrame([], "source string, original string"), "source", "domain")
    assert {tuple(r) for r in groups.collect()} == {("own", "own"), ("list", "copy"), ("copy", "copy"), ("press", "press"), ("track", "track")}
    said = [("own", 1, 5), ("list", 1, 5), ("list", 2, 5), ("copy", 2, 5), ("press", 3, 5), ("list", 3, 5), ("copy", 3, 5), ("track", 4, 5), ("list", 5, 6), ("track", 5, 5), ("track", 6, 7), ("own", 7, 6), ("own", 8, 5), ("list", 9, 5), ("press", 9, 6), ("own", 9, None)]
    records = [(i, None if i == 8 else 5) for i in range(1, 11)]
    out = corroboration.corroborated(spark.createDataFrame(records, "record int, value int"), spark.createDataFrame(said, "source string, record int, value int"), who, groups, "record", "value", "source", "tier")
    assert {r["record"]: (r["state"], r["n_groups"], r["n_against"]) for r in out.collect()} == {
        1: ("VERIFIED_OFFICIAL", 2, 0), 2: ("CORROBORATED_SECONDARY", 1, 0), 3: ("CORROBORATED_SECONDARY", 2, 0), 4: ("TRACKER_ONLY", 0, 0), 5: ("CONTRADICTED", 0, 1), 6: ("NO_SOURCE", 0, 0), 7: ("CONTRADICTED", 0, 1),
        8: ("NOT_APPLICABLE", 0, 0), 9: ("CONTRADICTED", 1, 1), 10: ("NO_SOURCE", 0, 0),
    }


def test_parts_grow_with_the_statements(spark, monkeypatch):
    from tidemark.operators import corroboration

    monkeypatch.setattr(corroboration, "STATEMENTS", 10)
    rows = spark.createDataFrame([(f"s{i % 3}", i // 3, "same", i % 3) for i in range(300)], "source string, k long, text string, at int")
    mirrors = corroboration.copied_from(rows, "source", "k", "text", "at")
    assert "REPARTITION_BY_NUM, [plan_id" in mirrors._jdf.queryExecution().executedPlan().toString()
    assert ", 30), REPARTITION_BY_NUM" in mirrors._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, mirrors.collect())) == [("s1", "s0"), ("s2", "s0")]
