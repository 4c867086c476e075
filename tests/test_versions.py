"""Writes in versions: what changes is written, one rename commits, and a run that dies leaves the table."""

from __future__ import annotations

import glob

import pytest
from tidemark.sources import versions

SCHEMA = "k int, v string, year int, place string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(spark, path, number=None, **more):
    return sorted(map(tuple, versions.read_version(spark, path, number, **more).collect()), key=repr)


def states(spark, path, number=None):
    return {(r["year"], r["place"]): (r["state"], r["n"]) for r in versions.changes(spark, path, number).collect()}


A = [(1, "x", 2025, "p"), (2, "y", 2026, "p"), (3, "z", None, "p"), (4, "w", 2027, ""), (5, "u", 2027, None), (6, "t", 2028, "q/=%"), (6, "t", 2028, "q/=%")]
B = [(1, "x", 2026, "p"), (2, "y", 2026, "p"), (3, "Z", None, "p"), (4, "w", 2027, ""), (5, "u", 2027, None), (6, "t", 2028, "q/=%"), (7, None, 2024, None)]


def test_moved_removed_and_null_partitions(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["year", "place"]
    first, new = versions.write_version(table(spark, A), path, by)
    assert new and first.number == 1 and held(spark, path) == sorted(A, key=repr)
    assert {s for s, _ in states(spark, path).values()} == {"created"}
    before = set(glob.glob(f"{path}/data/**/*.parquet", recursive=True))
    again, new = versions.write_version(table(spark, A[::-1]).repartition(3), path, by)
    assert not new and again.number == 1 and set(glob.glob(f"{path}/data/**/*.parquet", recursive=True)) == before
    second, new = versions.write_version(table(spark, B), path, by)
    assert new and second.number == 2 and held(spark, path) == sorted(B, key=repr)
    assert states(spark, path) == {
        (2025, "p"): ("removed", 0), (2026, "p"): ("updated", 2), (None, "p"): ("updated", 1), (2027, ""): ("kept", 1), (2027, None): ("kept", 1), (2028, "q/=%"): ("updated", 1), (2024, None): ("created", 1),
    }
    assert before < set(glob.glob(f"{path}/data/**/*.parquet", recursive=True))  # files of what is kept are as they were
    assert held(spark, path, 1) == sorted(A, key=repr)
    from pyspark.sql import functions as F

    assert held(spark, path, where=F.col("value.year") == 2027) == [(4, "w", 2027, ""), (5, "u", 2027, None)]
    third, new = versions.write_version(table(spark, []), path, by)
    assert new and third.number == 3 and held(spark, path) == []
    fourth, new = versions.write_version(table(spark, A[:1]), path, by)
    assert new and states(spark, path) == {(2025, "p"): ("created", 1)} and held(spark, path, 3) == []


def test_a_run_that_dies_before_its_commit(spark, tmp_path, monkeypatch):
    path, by = str(tmp_path / "t"), ["year"]
    versions.write_version(table(spark, A), path, by, run="one")

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(versions, "commit", dies)
        with pytest.raises(KeyboardInterrupt):
            versions.write_version(table(spark, B), path, by, run="two")
    assert glob.glob(f"{path}/data/run=two/**/*.parquet", recursive=True)
    assert versions.history(spark, path) == [1] and held(spark, path) == sorted(A, key=repr)
    version, new = versions.write_version(table(spark, B), path, by, run="two")
    assert new and version.number == 2 and held(spark, path) == sorted(B, key=repr)
    # After its commit a run that is repeated finds it, whatever others have done since.
    versions.write_version(table(spark, A), path, by, run="three")
    version, new = versions.write_version(table(spark, B), path, by, run="two")
    assert not new and version.number == 2 and held(spark, path) == sorted(A, key=repr)


def test_two_runs_at_once(spark, tmp_path, monkeypatch):
    path, by = str(tmp_path / "t"), ["year"]
    versions.write_version(table(spark, A), path, by)
    plain, raced = versions.commit, []

    def overtaken(files, where, version):
        if not raced:
            raced.append(versions.write_version(table(spark, [*A, (9, "n", 2030, None)]), path, by, run="other", touched=None))
        plain(files, where, version)

    monkeypatch.setattr(versions, "commit", lambda *a: plain(*a) if raced or a[2].run == "other" else overtaken(*a))
    version, new = versions.write_version(table(spark, B), path, by, run="mine")
    assert new and version.number == 3 and held(spark, path) == sorted(B, key=repr)
    assert states_of(spark, path)[2030] == "removed"
    with pytest.raises(versions.Conflict):
        plain(versions.Files(spark, path), path, version)


def states_of(spark, path):
    return {r["year"]: r["state"] for r in versions.changes(spark, path).collect()}


def test_a_part_of_the_table(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["year"]
    versions.write_version(table(spark, A), path, by)
    scope = spark.createDataFrame([(2025,), (2026,), (None,)], "year int")
    versions.write_version(table(spark, [(2, "new", 2026, "p"), (3, "z", None, "p")]), path, by, touched=scope)
    assert states_of(spark, path) == {2025: "removed", 2026: "updated", None: "kept", 2027: "kept", 2028: "kept"}
    assert held(spark, path) == sorted([(2, "new", 2026, "p"), *A[2:]], key=repr)


def test_other_columns_and_cleaning(spark, tmp_path):
    path, by = str(tmp_path / "t"), ["year"]
    versions.write_version(table(spark, A), path, by, run="one")
    versions.write_version(table(spark, B), path, by, run="two")
    wider = table(spark, B).selectExpr("*", "map('a', k) AS m")
    versions.write_version(wider, path, by, run="three")
    assert {r["k"]: r["m"] for r in versions.read_version(spark, path).collect()}[7] == {"a": 7}
    assert versions.read_version(spark, path, 2).columns == ["k", "v", "year", "place"]
    assert versions.clean(spark, path, versions=2, older_than=3600) == []
    assert versions.clean(spark, path, versions=1, older_than=0) == ["one", "two"]
    assert versions.history(spark, path) == [3] and len(held(spark, path)) == len(B)
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path, 1)
    with pytest.raises(ValueError):
        versions.write_version(wider, path, ["nowhere"])


def test_folders_are_pruned_by_the_manifest(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(table(spark, A), path, ["year"])
    plan = versions.read_version(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower() and "BroadcastHashJoin" in plan
