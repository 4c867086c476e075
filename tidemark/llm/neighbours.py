"""Approximate nearest neighbours by a permutation index.

Pivots are drawn from the vectors, as many as grow with the square root of their number. A vector is
represented by its nearest pivots in order, and posted in the inverted files of the first few of
them. A query is sent to the files of its own nearest pivots only, and meets them there by an
equality shuffle on the file; a long file is dealt as several chunks. In a file the entries are
ranked by the footrule distance between their prefixes and the query's. The best share is ranked again,
first in the file, by the distance of vectors rounded to a byte per component: how much rounding can change it
is known, so only entries that can't be among the nearest are left out. The few of each query that remain meet
their own vectors and are ranked by the exact distance. With n vectors there are about sqrt(n) pivots and a query reads about
the square root of them, so the share of the vectors that it meets falls as the table grows. Equal
vectors are one entry with its smallest ids, so that many copies of a vector neither
lengthen a file nor push others out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, table, trimmed

#: Neighbours, and one query in so many ids.
K, EVERY = 10, 100
#: Pivots in a prefix, files that an entry is posted in, and the share of a file that is ranked again.
PREFIX, POSTED, AGAIN = 64, 8, 0.3
#: Files that a query reads per square root of the pivots, besides a few more than it asks for.
READ = 2.0
#: Pivots at least, per square root of the vectors, and at most; entries in a chunk of a file.
LEAST_PIVOTS, PIVOTS, MOST_PIVOTS, CHUNK = 96, 4.0, 32768, 8192
SEED = 17
#: A pivot's number in a code; MOST_PIVOTS of them fit.
PLACES = np.uint16


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """_id and _vec (array<float> where it is one, else array<double>) of the vectors that take part."""
    v = F.col(f"`{vec_col}`")
    v = v if dict(vectors.dtypes)[vec_col] == "array<float>" else v.cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(f"`{id_col}`").try_cast("bigint").alias("_id"), v.alias("_vec")).filter("_id IS NOT NULL AND _vec IS NOT NULL").filter(fine)


def prefixes(v: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` nearest pivots of each row, nearest first."""
    d = (pivots**2).sum(1) - 2 * v @ pivots.T
    top = np.argpartition(d, length - 1, axis=1)[:, :length]
    return np.take_along_axis(top, np.argsort(np.take_along_axis(d, top, 1), axis=1, kind="stable"), 1)


class Files:
    """Inverted lists of a file: for each pivot the entries that hold it in their prefix, and its place there."""

    def __init__(self, held: np.ndarray) -> None:
        self.n, self.length = held.shape
        order = np.argsort(held.ravel(), kind="stable")
        self.entry, self.place = order // self.length, order % self.length
        self.pivots, first = np.unique(held.ravel()[order], return_index=True)
        self.bounds = np.append(first, held.size)

    def saved(self, prefix: np.ndarray) -> np.ndarray:
        """What each entry's footrule distance to ``prefix`` falls short of that of two prefixes without a common pivot."""
        at = np.minimum(np.searchsorted(self.pivots, prefix), len(self.pivots) - 1)
        there = np.flatnonzero(self.pivots[at] == prefix)
        low, high = self.bounds[at[there]], self.bounds[at[there] + 1]
        many = high - low
        where = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        return np.bincount(self.entry[where], 2 * (self.length - np.maximum(np.repeat(there, many), self.place[where])), self.n)


def files_read(pivots: int, k: int) -> int:
    """How many files a query reads: all of a few, and of many about as many as their square root."""
    return min(pivots, k + 6 + int(np.ceil(READ * pivots**0.5)))


def nearest(
    vectors: DataFrame, k: int = K, every: int = EVERY, prefix: int = PREFIX, again: float = AGAIN, id_col: str = "vec_id", vec_col: str = "embedding", seed: int = SEED
) -> DataFrame:
    """Per query (ids divisible by ``every``) its ``k`` nearest found: query_id, rank, vec_id, score.

    Score is the Euclidean distance in double precision; ties go to the smaller id. Vectors that are
    null, zero, or hold null or non-finite components, rows without an id that is a whole number, and vectors of another
    length than the most common one (the longest of these) take no part. A query with fewer
    candidates gets them all. Rows that repeat an id with an equal vector count once; an id with
    several vectors stands for each of them, as a query and as a candidate, at its nearest. Other
    columns play no part, whatever their names. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    sizes = rows.groupBy(F.size("_vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.size("_vec") == sizes[0]["d"])
    # Vectors are told apart by 128 bits of hash, so that only one of equal ones is moved; minus zero is zero.
    plain = F.transform("_vec", lambda x: F.when(x == 0, F.lit(0)).otherwise(x).cast("double"))
    rows = rows.withColumns({"_a": F.xxhash64(plain), "_b": F.xxhash64(F.lit(1), plain)})
    # Per distinct vector its smallest ids, one more than are asked for; salted, as a vector may have very many copies.
    rank = F.row_number().over(Window.partitionBy("_a", "_b", "_salt").orderBy("_id"))
    few = rows.select("_id", "_a", "_b").distinct().withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(64))).withColumn("_n", rank).filter(F.col("_n") <= k + 1)
    few = few.groupBy("_a", "_b").agg(F.slice(F.array_sort(F.collect_list("_id")), 1, k + 1).alias("ids"))
    # One id may stand for several vectors, so entries are numbered by a hash of the vector besides.
    entries = rows.groupBy("_a", "_b").agg(F.first("_vec").alias("_vec")).join(few, ["_a", "_b"])
    entries = cut(entries.withColumn("entry", F.xxhash64(F.element_at("ids", 1), "_a", "_b")))
    n = entries.count()
    m = int(min(n, max(LEAST_PIVOTS, min(MOST_PIVOTS, PIVOTS * n**0.5))))
    drawn = entries.orderBy(F.xxhash64(F.lit(seed), "entry"), "entry").limit(m).select("_vec").collect()
    pivots = np.array([r["_vec"] for r in drawn], np.float64)
    # Queries with equal vectors are looked up once.
    asked = rows.filter(F.pmod("_id", F.lit(every)) == 0).select(F.col("_id").alias("query_id"), "_a", "_b").distinct()
    asked = cut(asked.join(entries.select("_a", "_b", F.col("entry").alias("query"), "_vec"), ["_a", "_b"]).select("query_id", "query", "_vec"))
    heads = asked.groupBy("query").agg(F.first("_vec").alias("_vec"))
    near = _search(entries.select("entry", "_vec"), heads, pivots, min(prefix, m), k, again)
    met = near.join(entries.select("entry", "_vec", "ids"), "entry").join(heads.select("query", F.col("_vec").alias("_head")), "query")
    listed = _measured(met.select("query", "entry", "ids", "_vec", "_head")).withColumn("first", F.element_at("ids", 1))
    nth = F.row_number().over(Window.partitionBy("query").orderBy("score", "first", "entry"))
    listed = listed.withColumn("_n", nth).filter(F.col("_n") <= k + 1).select("query", "score", F.explode("ids").alias("vec_id"))
    pairs = asked.select("query_id", "query").join(listed, "query").filter("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def coded(v: np.ndarray, pivots: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``length`` nearest pivots of each row, and its code as bytes: these in two bytes each, its components in one each, their unit, and how far rounding moved it."""
    held = prefixes(v, pivots, length)
    unit = np.abs(v).max(1) / 127
    unit[unit == 0] = 1  # numbers too small to divide
    whole = np.rint(v / unit[:, None]).astype(np.int8)
    with np.errstate(over="ignore"):
        moved = np.sqrt(((v - whole * unit[:, None]) ** 2).sum(1)) * (1 + 1e-9)
    return held, np.concatenate([held.astype(PLACES).view(np.uint8).reshape(len(v), -1), whole.view(np.uint8), np.stack([unit, moved], 1).view(np.uint8).reshape(len(v), -1)], 1)


def decoded(code: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefixes, rounded vectors and how far each was moved, from codes."""
    held = np.ascontiguousarray(code[:, : 2 * length]).view(PLACES).astype(np.int64)
    unit, moved = np.ascontiguousarray(code[:, -16:]).view(np.float64).T
    return held, np.ascontiguousarray(code[:, 2 * length : -16]).view(np.int8) * unit[:, None], moved


def _matrix(a: pa.Array, n: int) -> np.ndarray:
    return a.flatten().to_numpy().reshape(n, -1).astype(np.float64)


def _coded(vectors: DataFrame, pivots: np.ndarray, length: int, files: int) -> DataFrame:
    """id, code and the ``files`` nearest pivots of each of ``vectors`` (id, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                v = _matrix(part.column(1), part.num_rows)
                held, code = coded(v, pivots, length)
                read = held[:, :files] if files <= length else prefixes(v, pivots, files)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(read.astype(np.int32).ravel()), files).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([row.tobytes() for row in code], pa.binary()), lists], ["id", "code", "files"])

    return vectors.mapInArrow(trimmed(run), "id bigint, code binary, files array<int>")


def _measured(met: DataFrame) -> DataFrame:
    """query, entry, ids and score, the exact distance, of rows that hold both vectors besides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                with np.errstate(over="ignore"):
                    d = np.sqrt(((_matrix(batch.column(3), batch.num_rows) - _matrix(batch.column(4), batch.num_rows)) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(d)], ["query", "entry", "ids", "score"])

    return met.mapInArrow(trimmed(run), "query bigint, entry bigint, ids array<bigint>, score double")


def _search(entries: DataFrame, heads: DataFrame, pivots: np.ndarray, length: int, k: int, again: float) -> DataFrame:
    """query and entry, of all entries met by a query and ranked again but those that are farther than its ``k`` + 1 nearest for sure."""
    spark, read = entries.sparkSession, files_read(len(pivots), k)
    placed = cut(_coded(entries, pivots, length, min(POSTED, length)))
    posted = placed.withColumn("file", F.explode("files"))
    # One row per pivot: how many chunks its file is dealt in.
    lengths = posted.groupBy("file").agg(F.count(F.lit(1)).alias("n")).select("file", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")).collect()
    chunks = F.broadcast(spark.createDataFrame(lengths, "file int, chunks int"))
    # File, chunk, and entry or query in one number.
    slot = lambda chunk, kind: (F.shiftleft(F.shiftleft(F.col("file").cast("bigint"), 32) + chunk, 1) + kind).alias("slot")
    kept = posted.join(chunks, "file").select(slot(F.pmod(F.xxhash64("id"), "chunks"), 0), "id", "code")
    queries = _coded(heads, pivots, length, read).withColumn("file", F.explode("files")).join(chunks, "file")
    queries = queries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(slot(F.col("chunk"), 1), "id", "code")
    dealt = kept.unionByName(queries).repartition(F.shiftright("slot", 1)).sortWithinPartitions("slot")

    def look(files: Files, own: np.ndarray, v: np.ndarray, moved: np.ndarray, place: dict[int, int], query: np.ndarray, code: np.ndarray) -> pa.RecordBatch:
        most = min(len(v), max(k + 1, int(np.ceil(again * len(v)))))
        who, at, low, high = [], [], [], []
        with np.errstate(over="ignore", invalid="ignore"):
            for q, (prefix, head, off) in enumerate(zip(*decoded(code, length), strict=True)):
                near = np.argpartition(-files.saved(prefix), most - 1)[:most]
                if (mine := place.get(int(query[q]))) is not None:  # its copies, whatever ties with them
                    near = np.union1d(near, [mine])
                d = np.sqrt(((v[near] - head) ** 2).sum(1))
                slack = moved[near] + off + 1e-9 * d
                least, top = d - slack, d + slack
                least[~(least > 0)], top[np.isnan(top)] = 0, np.inf
                fine = least <= (np.partition(top, k)[k] if len(top) > k else np.inf)
                who.append(np.full(int(fine.sum()), query[q]))
                at.append(near[fine])
                low.append(least[fine])
                high.append(top[fine])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(who)), pa.array(own[np.concatenate(at)]), pa.array(np.concatenate(low)), pa.array(np.concatenate(high))], ["query", "entry", "low", "high"])

    def codes(part: pa.RecordBatch) -> np.ndarray:
        return np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(part.num_rows, -1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A stream sorted by slot: a chunk's entries are held while its queries pass."""
        at, held, ready = None, [], None
        for batch in batches:
            slots = batch.column(0).to_numpy()
            edges = np.flatnonzero(np.diff(slots)) + 1
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if low == high:
                    continue
                part, (key, kind) = batch.slice(low, high - low), divmod(int(slots[low]), 2)
                if key != at:
                    at, held, ready = key, [], None
                if not kind:
                    held.append(part)
                    continue
                if not held:
                    continue
                if ready is None:
                    own = np.concatenate([x.column(1).to_numpy() for x in held])
                    prefix, v, moved = decoded(np.concatenate([codes(x) for x in held]), length)
                    ready = (Files(prefix), own, v, moved, {e: i for i, e in enumerate(own.tolist())})
                yield look(*ready, part.column(1).to_numpy(), codes(part))

    found = dealt.mapInArrow(trimmed(run), "query bigint, entry bigint, low double, high double").repartition("query")
    found = found.groupBy("query", "entry").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    nth = F.row_number().over(Window.partitionBy("query").orderBy("high", "low", "entry"))
    last = F.max(F.when(F.col("_n") <= k + 1, F.col("high"))).over(Window.partitionBy("query"))
    return found.withColumn("_n", nth).withColumn("_last", last).filter(F.col("low") <= F.col("_last")).select("query", "entry")


def op4_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {"op4_neighbours": op4_neighbours}
SQL: dict[str, str] = {}
