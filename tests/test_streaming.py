"""The refresh as a stream."""

from __future__ import annotations

from tidemark.sources.versions import changes, history, read_version
from tidemark.streaming.refresh import merge_batch, refresh

SCHEMA = "year int, title string, place string, seen int"


def test_refresh(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cut"))
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    overrides = lambda: spark.createDataFrame([(2026, "b", "fixed", ["place"])], "year int, title string, place string, set_fields array<string>")
    run = merge_batch(out, overrides, ["year", "title"], ["place"], "seen", "year")

    def arrive(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        refresh(spark.readStream.schema(SCHEMA).parquet(source), state, run).awaitTermination()
        return {(r["year"], r["title"], r["place"]) for r in read_version(spark, out).collect()}

    assert arrive([(2025, "a", "old", 1), (2025, "a", "new", 2), (2026, "b", "there", 1)]) == {(2025, "a", "new"), (2026, "b", "fixed")}
    assert arrive([(2026, "c", "here", 3), (2025, "a", None, 4)]) == {(2025, "a", "new"), (2026, "b", "fixed"), (2026, "c", "here")}
    assert {r["year"]: r["state"] for r in changes(spark, out).collect()} == {2025: "kept", 2026: "updated"}
    run(spark.createDataFrame([(2026, "c", "here", 3)], SCHEMA), 7)
    run(spark.createDataFrame([(2026, "c", "lost", 3)], SCHEMA), 1)  # a batch that is seen again
    assert read_version(spark, out).count() == 3 and history(spark, out) == [1, 2]
    assert arrive([(None, "d", "x", 5), (2027, "e", "y", 5), (2027, "e", "z", 5)]) == {(2025, "a", "new"), (2026, "b", "fixed"), (2026, "c", "here"), (2027, "e", "z")}
