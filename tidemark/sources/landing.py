"""A scan of landed files that sets broken ones aside, and keeps what was good before in their partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.versions import Version, read_version, version_at, write_version

CORRUPT = "_corrupt"


def scanned_files(spark: SparkSession, path: str, schema: str, required: list[str] | None = None, whole: bool = False) -> DataFrame:
    """A row per record of a folder's JSON files: ``file``, the folder's partition columns, ``document`` and ``reason``, null for a good one.

    A file holds a record per line, or with ``whole`` one list of records. A record that doesn't parse by ``schema``, or lacks a
    ``required`` field, has a reason; blank lines are no records. A file without records has no row.
    """
    fields = T.StructType.fromDDL(schema)
    raw = spark.read.text(path, wholetext=whole)
    kept = [c for c in raw.columns if c != "value"]
    rows = raw.filter(F.trim("value") != "").select(F.col("_metadata.file_path").alias("file"), *[f"`{c}`" for c in kept], "value")
    if whole:
        listed = F.from_json("value", T.ArrayType(fields), {"mode": "PERMISSIVE"})
        # A text that is no list gives one empty record, which says so.
        sound = F.try_parse_json("value").isNotNull() & F.startswith(F.ltrim("value"), F.lit("["))
        rows = rows.select("file", *[f"`{c}`" for c in kept], F.explode_outer(F.when(sound, listed)).alias("document"), sound.alias("_sound"))
        broken = F.when(~F.col("_sound"), F.lit("no list of records"))
    else:
        with_corrupt = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
        rows = rows.withColumn("_read", F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
        broken = F.when(F.col("_read").isNull() | F.col(f"_read.{CORRUPT}").isNotNull(), F.lit("unreadable record"))
        rows = rows.withColumn("document", F.struct(*[F.col(f"_read.`{f.name}`") for f in fields]))
    for name in required or []:
        broken = F.coalesce(broken, F.when(F.col("document").isNotNull() & F.col(f"document.`{name}`").isNull(), F.lit(f"no {name}")))
    rows = rows.withColumn("reason", broken)
    return rows.filter("reason IS NOT NULL OR document IS NOT NULL").select("file", *[f"`{c}`" for c in kept], "document", "reason")


def broken_files(records: DataFrame) -> DataFrame:
    """Per broken file of :func:`scanned_files`: file, its partition columns, n_bad and reason (the least of its records')."""
    kept = [c for c in records.columns if c not in ("file", "document", "reason")]
    return records.filter("reason IS NOT NULL").groupBy("file", *kept).agg(F.count(F.lit(1)).alias("n_bad"), F.min("reason").alias("reason"))


def refreshed(records: DataFrame, store: str, partitions: list[str], run: str | None = None) -> tuple[Version, bool]:
    """Writes landed records to a table in versions (see ``versions``), whose ``partitions`` are those of the landing folder.

    A partition with a broken file keeps what the table has of it, its sound files included, as half a partition would pass for all of
    it. A partition that isn't landed any more is left out of the table.
    """
    spark = records.sparkSession
    key = F.to_json(F.struct(*[F.col(f"`{p}`").cast("string").alias(p) for p in partitions], F.lit(1).alias("_end"))).alias("_key")
    bad = records.filter("reason IS NOT NULL").select(key).distinct()
    good = records.select("*", key).join(bad, "_key", "left_anti")
    columns = [f for f in records.schema["document"].dataType.names if f not in partitions]  # type: ignore[attr-defined]
    rows = good.select(*[F.col(f"document.`{c}`") for c in columns], *[F.col(f"`{p}`") for p in partitions])
    if version_at(spark, store) is None:
        return write_version(rows, store, partitions, run)
    # All partitions are compared but those that are kept.
    stored = read_version(spark, store).select(*[F.col(f"`{p}`") for p in partitions]).distinct()
    landed = rows.select(*[F.col(f"`{p}`") for p in partitions]).distinct()
    touched = stored.unionByName(landed).distinct().select("*", key).join(bad, "_key", "left_anti").drop("_key")
    return write_version(rows, store, partitions, run, touched=touched)
