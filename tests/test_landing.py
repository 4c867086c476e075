"""Landed files of which some are broken, and sessions of a stream."""

from __future__ import annotations

import datetime
import random

from pyspark.sql import functions as F
from tidemark.operators.clusters import gap_clusters
from tidemark.sources import landing, versions
from tidemark.streaming.sessions import gap_sessions, late_rows

SCHEMA = "title string, n int"


def land(folder, files):
    for name, text in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def stored(spark, store):
    return sorted((r["title"], r["n"], r["year"]) for r in versions.read_version(spark, store).collect())


def test_a_broken_file_is_set_aside(spark, tmp_path):
    folder, store = tmp_path / "in", str(tmp_path / "store")
    land(folder, {"year=2025/a.json": '{"title": "x", "n": 1}\n\n{"title": "y", "n": 2}\n', "year=2026/a.json": '{"title": "z", "n": 3}', "year=2027/a.json": '{"title": "w"}', "year=2028/empty.json": ""})
    rows = landing.scanned_files(spark, str(folder), SCHEMA, ["title"])
    assert landing.broken_files(rows).count() == 0
    landing.refreshed(rows, store, ["year"])
    assert stored(spark, store) == [("w", None, 2027), ("x", 1, 2025), ("y", 2, 2025), ("z", 3, 2026)]
    # A half-written file, one of a wrong type, one without a title; a sound one beside the first; a partition that is gone.
    land(folder, {"year=2025/a.json": '{"title": "x", "n": 5}\n{"title": "y", "n', "year=2025/b.json": '{"title": "new", "n": 9}', "year=2026/a.json": '{"title": "z", "n": 4}', "year=2029/a.json": '{"title": "q", "n": "many"}', "year=2030/a.json": '{"n": 1}\nnull'})
    (folder / "year=2027/a.json").unlink()
    rows = landing.scanned_files(spark, str(folder), SCHEMA, ["title"])
    broken = {r["year"]: (r["file"].rsplit("/", 1)[1], r["n_bad"], r["reason"]) for r in landing.broken_files(rows).collect()}
    assert broken == {2025: ("a.json", 1, "unreadable record"), 2029: ("a.json", 1, "unreadable record"), 2030: ("a.json", 2, "no title")}
    landing.refreshed(rows, store, ["year"])
    assert stored(spark, store) == [("x", 1, 2025), ("y", 2, 2025), ("z", 4, 2026)]
    # Once it is mended, it counts.
    land(folder, {"year=2025/a.json": '{"title": "x", "n": 5}'})
    landing.refreshed(landing.scanned_files(spark, str(folder), SCHEMA, ["title"]), store, ["year"])
    assert stored(spark, store) == [("new", 9, 2025), ("x", 5, 2025), ("z", 4, 2026)]


def test_whole_files(spark, tmp_path):
    land(tmp_path, {"k=1/a": '[{"title": "x", "n": 1},\n {"title": "y"}]', "k=2/a": '[{"title": "x"}', "k=3/a": '{"title": "x"}', "k=4/a": "[]", "k=5/a": '[{"n": 1}]'})
    rows = landing.scanned_files(spark, str(tmp_path), SCHEMA, ["title"], whole=True).collect()
    assert sorted((r["k"], r["document"] and r["document"]["title"], r["reason"]) for r in rows) == [(1, "x", None), (1, "y", None), (2, None, "no list of records"), (3, None, "no list of records"), (5, None, "no title")]


START = datetime.datetime(2026, 1, 1)
EVENTS = "k string, at timestamp, i long"


def clustered(spark, rows, seconds):
    df = gap_clusters(spark.createDataFrame(rows, EVENTS), ["k"], "at", seconds, "i")
    by = df.groupBy("k", "cluster").agg(F.min("at").alias("first"), F.max("at").alias("last"), F.count(F.lit(1)).alias("n"))
    return sorted(map(tuple, by.drop("cluster").collect()), key=repr)


def test_sessions_are_gap_clusters(spark, tmp_path):
    rng = random.Random(1)
    at = lambda s: START + datetime.timedelta(seconds=s)
    rows = [(rng.choice(["a", "b", None]), at(rng.choice([rng.randint(0, 4000), 60 * rng.randint(0, 60)])), i) for i in range(300)] + [("a", None, 301), ("a", None, 302)]
    rows += [("edge", at(0), 400), ("edge", at(60), 401), ("edge", at(120) + datetime.timedelta(microseconds=1), 402)]
    want = clustered(spark, rows, 60)
    assert sorted(map(tuple, gap_sessions(spark.createDataFrame(rows, EVENTS), ["k"], "at", 60).collect()), key=repr) == want
    # As a stream, in files out of order within what may be late, with a row that is too late.
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    shuffled = sorted(rows, key=lambda r: ((r[1] or START) + datetime.timedelta(seconds=rng.randint(0, 600)), r[2]))
    parts = [shuffled[:100], shuffled[100:220], shuffled[220:], [("end", at(90_000), 900)], [("end", at(90_001), 901), ("late", at(5), 902)], [("end", at(99_000), 903)]]
    dropped = 0
    for part in parts:
        spark.createDataFrame(part, EVENTS).coalesce(1).write.mode("append").parquet(source)
        query = gap_sessions(spark.readStream.schema(EVENTS).parquet(source), ["k"], "at", 60, "20 minutes").writeStream.option("checkpointLocation", state).trigger(availableNow=True).start(out)
        query.awaitTermination()
        dropped += late_rows(query)
    got = [tuple(r) for r in spark.read.parquet(out).filter("k IS NULL OR k <> 'end'").collect()]
    assert sorted(got, key=repr) == want and dropped == 1
