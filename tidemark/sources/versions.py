"""A table of files in versions: partitions that differ are written, and one rename makes them the table.

A folder holds three things. ``data/run=R/part=P`` has the rows of partition P as run R wrote them, ``manifest/commit=R``
has a row per partition of the table after run R with the run that wrote it, and ``commits/N`` is a small file that
names the run of version N. A run stages its data and its manifest, which no reader looks at, and commits by renaming
its file to the next number; a number that is there already refuses the rename, so of two runs one tries again on the
other's version. A run that dies leaves the table as it was. A run that is repeated under its own name finds its commit.

P is a hash of the partition's values, so that null, empty and odd values are partitions like any other.
Manifests are read, joined and written by Spark; no list of partitions reaches the driver.
"""

from __future__ import annotations

import json
import re
import tempfile
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

#: Times that a run tries to commit on another's version.
ATTEMPTS = 8
#: Digits of a version's file name.
DIGITS = 12
STATES = ("created", "updated", "kept", "removed")


class Conflict(RuntimeError):
    """Another run has committed the version."""


@dataclass(frozen=True)
class Version:
    """A committed version: its number, the run that made it, and the table's columns and partitioning then."""

    number: int
    run: str
    schema: StructType
    partitions: list[str]


def scratch(spark: SparkSession) -> str:
    """A new folder name in ``spark.checkpoint.dir``; a session on one machine may go without that setting."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and context.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(given or tempfile.mkdtemp(prefix="checkpoints-"))
    return f"{context.getCheckpointDir()}/{uuid.uuid4().hex}"


class Files:
    """The few file operations of a driver, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        jvm, self.spark = spark._jvm, spark  # type: ignore[attr-defined]
        self.hadoop, self.conf = jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()  # type: ignore[attr-defined]
        self.system = self.at(path).getFileSystem(self.conf)

    def at(self, path: str):
        return self.hadoop.Path(path)

    def names(self, folder: str) -> dict[str, float]:
        """What a folder holds, with its time of change in seconds; nothing where there is none."""
        if not self.system.exists(self.at(folder)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self.system.listStatus(self.at(folder))}

    def read(self, path: str) -> str:
        return "\n".join(r[0] for r in self.spark.read.text(path, wholetext=True).collect())

    def remove(self, path: str) -> None:
        self.system.delete(self.at(path), True)

    def put(self, path: str, text: str) -> None:
        """Writes ``path`` at once: under another name, and then renamed, unless it is there."""
        folder, name = path.rsplit("/", 1)
        staged = f"{folder}/_{name}-{uuid.uuid4().hex}"
        out = self.system.create(self.at(staged), False)
        out.write(bytearray(text.encode()))
        out.close()
        context = self.hadoop.FileContext.getFileContext(self.at(path).toUri(), self.conf)
        rename = getattr(self.hadoop, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(rename, 1)  # type: ignore[union-attr]
        how[0] = rename.NONE
        try:
            context.rename(context.makeQualified(self.at(staged)), context.makeQualified(self.at(path)), how)
        except Exception as e:
            self.remove(staged)
            if "AlreadyExists" in str(e):
                raise Conflict(path) from None
            raise


def part_of(partitions: list[str]) -> Column:
    """A partition's name: a hash of its values, nulls told from any text."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{p}`").cast("string").alias(f"v{i}") for i, p in enumerate(partitions)], F.lit(1).alias("end"))))


def row_digest(df: DataFrame) -> Column:
    """A hash of a row, whatever the order of the columns; maps, which have no hash, by their JSON."""
    kinds = dict(df.dtypes)
    return F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`").alias("x"))) if "map<" in kinds[c] else F.col(f"`{c}`") for c in sorted(df.columns)])


def history(spark: SparkSession, path: str) -> list[int]:
    """The numbers of all committed versions, in order."""
    return sorted(int(n) for n in Files(spark, path).names(f"{path}/commits") if n.isdigit())


def version_at(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A committed version, by default the newest; none where there is none."""
    known = history(spark, path)
    if not known or (number is not None and number not in known):
        return None
    number = known[-1] if number is None else number
    said = json.loads(Files(spark, path).read(f"{path}/commits/{number:0{DIGITS}d}"))
    return Version(number, said["run"], StructType.fromJson(said["schema"]), said["partitions"])


def committed_by(spark: SparkSession, path: str, run: str) -> Version | None:
    """The version that ``run`` has committed, if it has."""
    if not history(spark, path):
        return None
    found = spark.read.schema("version bigint, run string").json(f"{path}/commits").filter(F.col("run") == run).select("version").first()
    return version_at(spark, path, found[0]) if found else None


def manifest(spark: SparkSession, path: str, version: Version) -> DataFrame:
    """Per partition of a version: part, run, n, digest, state and the partition's values; those removed last are there too."""
    values = StructType([f for f in version.schema.fields if f.name in version.partitions])
    schema = StructType.fromDDL("part string, run string, n bigint, digest decimal(38,0), state string, commit string").add("value", values)
    return spark.read.schema(schema).parquet(f"{path}/manifest").filter(F.col("commit") == version.run).drop("commit")


def read_version(spark: SparkSession, path: str, number: int | None = None, where: Column | None = None) -> DataFrame:
    """The table as of a version, by default the newest. ``where`` is a condition on ``value``, the partition's values.

    The files' folders are partitions of the scan, so the join with the version's manifest decides at run time
    which of them are read.
    """
    version = version_at(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"no version {'' if number is None else number} in {path}")
    live = manifest(spark, path, version).filter("state <> 'removed'")
    live = (live if where is None else live.filter(where)).select(F.col("run").alias("_run"), F.col("part").alias("_part"))
    try:
        stored = spark.read.schema(StructType([*version.schema.fields, StructField("run", StringType()), StructField("part", StringType())])).parquet(f"{path}/data")
    except Exception as e:  # a table that never had a row has no data
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], version.schema)
    # The names of the two folders may clash with columns of the table.
    if {"run", "part"} & set(version.schema.names):
        raise ValueError("run and part name the folders")
    return stored.join(live, (F.col("run") == F.col("_run")) & (F.col("part") == F.col("_part")), "left_semi").select(*[f"`{c}`" for c in version.schema.names])


def changes(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Per partition of a version its values, n and state: created, updated, kept, removed."""
    version = version_at(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"no version in {path}")
    return manifest(spark, path, version).select(*[F.col(f"value.`{p}`") for p in version.partitions], "n", "state")


def _compared(df: DataFrame, path: str, partitions: list[str], base: Version | None, touched: DataFrame | None, run: str) -> DataFrame:
    """The manifest of the next version: the new partitions beside the old ones."""
    value = F.struct(*[F.col(f"`{p}`") for p in df.columns if p in partitions])
    new = df.select(part_of(partitions).alias("part"), value.alias("value"), row_digest(df).cast("decimal(38,0)").alias("_h"))
    new = new.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("_h").alias("digest"), F.first("value").alias("value"))
    if base is None:
        return new.select("part", F.lit(run).alias("run"), "n", "digest", F.lit("created").alias("state"), "value")
    old = manifest(df.sparkSession, path, base).filter("state <> 'removed'").select("part", *[F.col(c).alias(f"_{c}") for c in ("run", "n", "digest", "value")])
    both = new.join(old, "part", "full_outer")
    if touched is None:
        gone = F.lit(True)
    else:
        both = both.join(touched.select(part_of(partitions).alias("part")).distinct().withColumn("_touched", F.lit(True)), "part", "left")
        gone = F.coalesce("_touched", F.lit(False))
    same = (F.col("n") == F.col("_n")) & (F.col("digest") == F.col("_digest"))
    state = F.when(F.col("_n").isNull(), "created").when(F.col("n").isNull(), F.when(gone, "removed").otherwise("kept")).when(same, "kept").otherwise("updated")
    kept = F.col("state") == "kept"
    pick = lambda c: F.when(kept, F.col(f"_{c}")).otherwise(F.coalesce(c, f"_{c}"))
    run_of = F.when(kept, F.col("_run")).otherwise(F.lit(run))
    return both.withColumn("state", state).select("part", run_of.alias("run"), F.when(F.col("state") == "removed", 0).otherwise(pick("n")).alias("n"), pick("digest").alias("digest"), "state", pick("value").alias("value"))


def write_version(df: DataFrame, path: str, partitions: list[str], run: str | None = None, touched: DataFrame | None = None) -> tuple[Version, bool]:
    """Makes ``df`` the table; the version that holds now, and whether it is new.

    Partitions are compared by number of rows and an order-free checksum; those that are equal keep their files as
    they are, those that differ are written, and those without rows any more are left out. With ``touched`` (rows
    with the partition columns) ``df`` has only those partitions and all others are kept. ``run`` names the run; a
    run that is repeated under its name returns its version. Without a difference no version is made. ``df`` is
    read twice and has to give the same rows. Another schema than the last version's rewrites all partitions.
    """
    spark, run = df.sparkSession, run or uuid.uuid4().hex
    if missing := [p for p in partitions if p not in df.columns]:
        raise ValueError(f"no column {missing}")
    files = Files(spark, path)
    if not re.fullmatch(r"[\w.-]+", run):
        raise ValueError(f"{run} is no name of a folder")
    if known := committed_by(spark, path, run):
        return known, False
    for _ in range(ATTEMPTS):
        base = version_at(spark, path)
        if base and (base.schema.simpleString(), base.partitions) != (df.schema.simpleString(), partitions):
            if touched is not None:
                raise ValueError("a part of a table can't have another schema than the table")
            base_rows = None
        else:
            base_rows = base
        # What an earlier try of this run has staged is of no use on another base.
        files.remove(f"{path}/data/run={run}")
        _compared(df, path, partitions, base_rows, touched, run).write.mode("overwrite").parquet(f"{path}/manifest/commit={run}")
        next_ = Version((base.number if base else 0) + 1, run, df.schema, partitions)
        staged = manifest(spark, path, next_)
        if base and base_rows and staged.filter("state <> 'kept'").isEmpty():
            files.remove(f"{path}/manifest/commit={run}")
            return base, False
        fresh = staged.filter("state IN ('created', 'updated')").select(F.col("part").alias("_part"))
        rows = df.withColumn("part", part_of(partitions))
        rows = rows.join(fresh, F.col("part") == F.col("_part"), "left_semi").hint("rebalance", "part")
        rows.write.mode("overwrite").partitionBy("part").parquet(f"{path}/data/run={run}")
        try:
            commit(files, path, next_)
            return next_, True
        except Conflict:
            continue
    raise Conflict(f"{ATTEMPTS} others have committed to {path} meanwhile")


def commit(files: Files, path: str, version: Version) -> None:
    """The one step that changes the table."""
    said = {"version": version.number, "run": version.run, "schema": version.schema.jsonValue(), "partitions": version.partitions}
    files.put(f"{path}/commits/{version.number:0{DIGITS}d}", json.dumps(said))


def clean(spark: SparkSession, path: str, versions: int = 1, older_than: float = 7 * 86_400) -> list[str]:
    """Removes data and manifests that none of the newest ``versions`` uses and that are older than so many seconds; their runs.

    The age keeps what another run is staging.
    """
    files, now = Files(spark, path), time.time()
    kept = [v for n in history(spark, path)[-versions:] if (v := version_at(spark, path, n))]
    # One row per run that still has a partition in one of these few versions.
    live = {r[0] for v in kept for r in manifest(spark, path, v).filter("state <> 'removed'").select("run").distinct().collect()}
    gone = []
    for folder, of, used in (("data", "run", live), ("manifest", "commit", {v.run for v in kept})):
        for name, at in files.names(f"{path}/{folder}").items():
            run = name.removeprefix(f"{of}=")
            if run != name and run not in used and now - at > older_than:
                files.remove(f"{path}/{folder}/{name}")
                gone.append(run)
    for number in history(spark, path)[:-versions]:
        files.remove(f"{path}/commits/{number:0{DIGITS}d}")
    return sorted(set(gone))
