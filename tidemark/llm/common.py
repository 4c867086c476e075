"""What the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the contracts: space and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]"
#: Rows of a few numbers each that a broadcast may hold; beyond that the join is a shuffle.
MOST_BROADCAST = 500_000
#: Copies of a row that are made at a time.
AT_ONCE = 4096
#: Bytes of an Arrow batch of texts, which is there in the JVM and in the Python worker at once; Spark's own bound is by rows.
BATCH_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, ``spark.checkpoint.dir``; a temporary one where that is unset, which only a session on one machine may do."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        given = spark.conf.get("spark.checkpoint.dir", None)
        if not given and not context.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(given or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()  # type: ignore[return-value]


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def kept_as_table(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again; see :func:`drop_table`."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_table(df: DataFrame) -> None:
    """Removes the files of a table of :func:`kept_as_table`, once nothing reads it any more."""
    jvm, context = df.sparkSession._jvm, df.sparkSession.sparkContext  # type: ignore[attr-defined]
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.startswith(context.getCheckpointDir() or "\n") and "/table-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Returns what a Python worker has freed to the system; workers live on, next to the JVM and those of later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, a function for ``mapInArrow``, that gives back memory at the end of each task."""

    @functools.wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


@contextlib.contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside send Python Arrow batches of ``BATCH_BYTES`` and one row at most, unless the session has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is not None:
        yield
        return
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key)


def crc_remainder(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(modulus)


def text_or_empty(text_col: str):
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, so that no name of an operator can clash with one of theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(df: DataFrame, columns: list[str], name: str = "_all") -> DataFrame:
    """The columns of :func:`whole_row` again."""
    return df.select(*[F.col(f"{name}.`{c}`") for c in columns])


def row_hash(df: DataFrame) -> Column:
    """A hash of the whole row; columns with maps, which have no hash, by their JSON."""
    no_hash = lambda kind: "map<" in kind or "variant" in kind
    parts = [F.to_json(F.struct(F.col(f"`{c}`").alias("x"))) if no_hash(kind) else F.col(f"`{c}`") for c, kind in df.dtypes]
    return F.xxhash64(*parts)


def keyed(df: DataFrame, id_col: str) -> DataFrame:
    """``_id``, ``_row`` (a hash of the whole row) and ``_all`` (the row itself)."""
    return df.select(F.col(f"`{id_col}`").alias("_id"), row_hash(df).alias("_row"), whole_row(df).alias("_all"))


def copied(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` says, with ``_copy`` from 1; made in blocks, so that no array is long."""
    one, most = F.lit(1).cast("bigint"), F.lit(AT_ONCE).cast("bigint")
    blocks = df.filter(F.col(times) > 0).withColumn("_block", F.explode(F.sequence(one - 1, F.floor((F.col(times) - 1) / AT_ONCE))))
    first = F.col("_block") * AT_ONCE
    return blocks.withColumn("_copy", F.explode(F.sequence(first + 1, F.least(first + most, F.col(times))))).drop("_block")


def as_often(df: DataFrame, id_col: str, others: DataFrame) -> DataFrame:
    """The rows of ``df``, but those that ``others`` names (_id, _row, times; unique) as often as it says.

    ``others`` is broadcast where it has few rows, and else joined by a shuffle. A row that is named
    comes from one of its copies, which tasks pick among their own first, so that no task gets them all.
    """
    others = cut(others.select(F.col("_id").alias("_of"), F.col("_row").alias("_of_row"), F.col("times").cast("bigint")))
    n, top = others.agg(F.count(F.lit(1)), F.coalesce(F.max("times"), F.lit(0))).first()  # type: ignore[misc]
    rows = keyed(df, id_col)
    if not n:
        return df
    hint = F.broadcast if n <= MOST_BROADCAST else (lambda x: x)
    on = F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_row") == F.col("_of_row"))
    out = rows.join(hint(others), on, "left_anti").select("_all")
    if top:
        named = rows.join(hint(others.filter("times > 0")), on)
        named = named.groupBy("_id", "_row").agg(F.first("_all").alias("_all"), F.first("times").alias("times"))
        named = copied(named, "times") if top > 1 else named
        out = out.unionByName(named.select("_all"))
    return unpacked(out, df.columns)


def dealt_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join on the column ``key`` in which both sides are dealt for the join itself.

    Where one side is already dealt by the key, as after an aggregation, Spark would leave it so and
    could not split the partition of a key that is very frequent on the other side. A hash of the key
    makes it deal both.
    """
    a = left.withColumn("_dealt", F.xxhash64(F.lit(1), key))
    b = right.select(F.xxhash64(F.lit(1), key).alias("_dealt_too"), F.col(key).alias("_dealt_key"), *[c for c in right.columns if c != key])
    return a.join(b, (F.col("_dealt") == F.col("_dealt_too")) & (F.col(key) == F.col("_dealt_key")), how).drop("_dealt", "_dealt_too", "_dealt_key")
