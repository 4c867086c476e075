"""Places with ordinals, numbering over ranges, audits that start from a watchlist."""

from __future__ import annotations

import json
import random

from pyspark.sql import functions as F
from tidemark.operators import evidence, proposals, quality, report
from tidemark.sources import records


def test_places_are_flattened_as_pages_are(spark):
    places = ["5th Avenue Hall, New York", "Zürich, Switzerland", "STRAẞE 7", ", x", None]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(places)], "i long, p string").select("i", evidence.value_forms(F.lit("place"), F.col("p")).alias("f")).collect()
    assert {r["i"]: r["f"] for r in rows} == {0: ["5 avenue hall"], 1: ["z rich"], 2: ["strasse 7"], 3: [], 4: []}
    claim = {"place": (["5th Avenue Hall, New York"], ["The event takes place at 5th Avenue Hall, New York"], None)}
    given = spark.createDataFrame([("a", "upsert_manual", "https://x.example/1", claim)], f"id string, action string, source_url string, claims {evidence.CLAIMS}")
    pages = spark.createDataFrame([("https://x.example/1", "<p>The event takes place at 5th Avenue Hall, New York.</p>")], "url string, html string")
    assert [r["status"] for r in evidence.gate(given, pages, []).collect()] == ["VERIFIED"]


def test_numbers_over_ranges(spark):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 2, None]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, i int").repartition(5)
    out = report.numbered_over_ranges(df, [F.col("a"), F.col("i")])
    want = {i: n for n, (_, _, i) in enumerate(sorted((a is not None, a or 0, i) for a, i in rows), 1)}
    assert {r["i"]: r["nth"] for r in out.collect()} == want
    assert report.numbered_over_ranges(df.limit(0), [F.col("a")]).count() == 0


def test_an_audit_starts_from_the_watchlist(spark):
    seeds = records.json_lines(quality.audit_seed(spark.createDataFrame([("t", 2026, 1)], "title string, year int, rank int"), "title", "year")).collect()
    assert json.loads(seeds[0]["value"]) == {"title": "t", "year": 2026, "cause": "not_checked", "attempted": [], "note": quality.SEEDED}


def test_one_pass_over_verdicts(spark):
    verdicts = spark.createDataFrame([("a", "VERIFIED"), ("b", "UNCHECKED"), ("c", None), ("d", "VERIFIED"), ("d", "VERIFIED")], "id string, status string")
    out = {r["status"]: (r["n"], r["total"], r["examined"]) for r in quality.effort(verdicts, "status", "UNCHECKED").collect()}
    assert out == {"VERIFIED": (3, 5, 3), "UNCHECKED": (1, 5, 3), None: (1, 5, 3)}
    given = spark.createDataFrame([("a",), ("b",), ("d",), ("e",)], "id string")
    assert sorted((r["id"], r["accepted"]) for r in proposals.judged(given, verdicts, "id").collect()) == [("a", True), ("b", False), ("d", True), ("e", False)]
