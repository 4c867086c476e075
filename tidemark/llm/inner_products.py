"""Exact search for the largest inner products, as a Voronoi join.

A query's ranking doesn't depend on its length, so queries are grouped by the pivot at the smallest angle. Two
passes over the data give what a group needs. With a the part of a vector along a pivot and b what is left of it,
its inner product with any query within the angle r of the pivot, as a unit vector, lies between a cos r - b sin r
and a cos r + b sin r. The first pass keeps the best lower bounds of each group, and so a score that
each of its queries reaches often enough. The second sends a vector to the groups whose score its upper bound
reaches, and to no other. Groups are gathered into joint ones of bounded size, which a vector enters once, with
a bit for each group in it that needs it; there blocks of vectors are multiplied with the queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.centroids import whole_numbers
from tidemark.llm.common import cut, dealt_join, drop_table, kept_as_table, table, trimmed

#: Neighbours, one query in so many ids, and what a component is multiplied with.
K, EVERY, SCALE = 20, 20, 64
#: Components beyond this count as this, so that inner products of up to 4,096 components fit into 64 bits.
MOST = 2**25
#: Queries per pivot, pivots at most, and what a joint group may hold: queries, and groups (the bits of a long).
PER_PIVOT, PIVOTS, QUERIES_HELD, GROUPS_HELD = 256, 1024, 32_768, 63
#: Vectors of a joint group that one task reads at least, and tasks per joint group for each of these.
SLICE, SLICES = 8192, 4
#: Vectors and queries multiplied at a time, and the room that bounds leave for rounding.
BLOCK, BLOCK_QUERIES, ROOM = 512, 2048, 1e-9
SEED, NONE = 23, np.iinfo(np.int64).min


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(n, -1).astype(np.float64)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


class Cells:
    """Groups of queries: unit pivots and the widest angle to each, as its cosine and sine."""

    def __init__(self, pivots: np.ndarray, cosines: np.ndarray) -> None:
        self.pivots, self.cos = pivots, np.clip(cosines - ROOM, -1, 1)
        self.sin = np.sqrt(1 - self.cos**2)

    def bounds(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest inner product of each row with a unit query of each cell, less and more a little."""
        a, size = v @ self.pivots.T, np.sqrt((v**2).sum(1))[:, None]
        b = np.sqrt(np.maximum(size**2 - a**2, 0))
        low = np.where(a > -size * self.cos, a * self.cos - b * self.sin, -size)
        high = np.where(a < size * self.cos, a * self.cos + b * self.sin, size)
        return low - ROOM * size, high + ROOM * size


def best_first(owner: np.ndarray, score: np.ndarray, ident: np.ndarray, most: int) -> np.ndarray:
    """Places of each owner's ``most`` best scores, ties by the smaller id, each id once; ordered by owner and rank."""
    order = np.lexsort((ident, -score, owner))
    # An id that comes again for the same owner loses to its better row.
    by_id = np.lexsort((np.arange(len(order)), ident[order], owner[order]))
    o, i = owner[order][by_id], ident[order][by_id]
    again = np.zeros(len(order), bool)
    again[by_id[1:]] = (o[1:] == o[:-1]) & (i[1:] == i[:-1])
    order = order[~again]
    starts = np.flatnonzero(np.diff(owner[order], prepend=-1))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < most]


def _reached(rows: DataFrame, cells: Cells, most: int) -> np.ndarray:
    """Per cell a score that each of its queries, as a unit vector, reaches with ``most`` different ids; none: minus infinity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = len(cells.pivots)
        owner, score, ident, least = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64), np.full(m, -np.inf)
        for part in _blocks(batches, BLOCK):
            low, _ = cells.bounds(_matrix(part.column(1), part.num_rows))
            row, cell = np.nonzero(low > least)
            if len(row):
                owner, score, ident = np.append(owner, cell), np.append(score, low[row, cell]), np.append(ident, part.column(0).to_numpy()[row])
                at = best_first(owner, score, ident, most)
                owner, score, ident = owner[at], score[at], ident[at]
                full = np.bincount(owner, minlength=m) == most
                last = np.flatnonzero(np.diff(owner, append=m))
                least[owner[last]] = np.where(full[owner[last]], score[last], -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(owner.astype(np.int32)), pa.array(ident), pa.array(score)], ["cell", "_id", "low"])

    best = Window.partitionBy("cell").orderBy(F.desc("low"), "_id")
    found = rows.mapInArrow(trimmed(run), "cell int, _id bigint, low double").groupBy("cell", "_id").agg(F.max("low").alias("low"))
    found = found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= most)
    out = np.full(len(cells.pivots), -np.inf)
    for r in found.groupBy("cell").agg(F.min("low").alias("low"), F.count(F.lit(1)).alias("n")).collect():
        if r["n"] == most:
            out[r["cell"]] = r["low"]
    return out


def joint_groups(pivots: np.ndarray, counts: list[int], most: int = QUERIES_HELD, wide: int = GROUPS_HELD) -> list[list[tuple[int, int, int]]]:
    """Cells as joint groups of at most ``wide`` cells and about ``most`` queries, near ones together: (cell, part, parts) each; a larger cell is several parts."""
    left, out, now, held = {i for i, n in enumerate(counts) if n}, [], [], 0
    at = min(left, default=0)
    while left:
        left.discard(at)
        parts = -(-counts[at] // most)
        if parts > 1:
            out += [[(at, p, parts)] for p in range(parts)]
        else:
            if now and (held + counts[at] > most or len(now) == wide):
                out, now, held = [*out, now], [], 0
            now, held = [*now, (at, 0, 1)], held + counts[at]
        at = max(left, key=lambda i: (float(pivots[i] @ pivots[at]), -i), default=0)
    return [*out, now] if now else out


class Best:
    """The queries of a joint group by cell, and the best that each has met."""

    def __init__(self, held: list[pa.RecordBatch], most: int) -> None:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        bit = whole.column(4).to_numpy()
        order = np.argsort(bit, kind="stable")
        self.head, self.bits = whole.column(3).to_numpy()[order], bit[order]
        self.q, self.most = _matrix(whole.column(5), whole.num_rows)[order], most
        n = len(order)
        self.score, self.ident = np.full((n, most), NONE), np.full((n, most), np.iinfo(np.int64).max)
        edges = np.flatnonzero(np.diff(self.bits)) + 1
        self.cells = [(int(self.bits[a]), a, b) for a, b in zip([0, *edges.tolist()], [*edges.tolist(), n], strict=True)]
        self.large = np.abs(self.q).max(initial=0)

    def meet(self, ident: np.ndarray, bits: np.ndarray, v: np.ndarray) -> None:
        exact = self.large * np.abs(v).max(initial=0) * v.shape[1] < 2**53
        for bit, low, high in self.cells:
            need = np.flatnonzero(bits & bit)
            if len(need):
                for at in range(low, high, BLOCK_QUERIES):
                    self._meet(at, min(high, at + BLOCK_QUERIES), ident[need], v[need], exact)

    def _meet(self, low: int, high: int, ident: np.ndarray, v: np.ndarray, exact: bool) -> None:
        q, n = self.q[low:high], len(ident)
        # Floating-point products of whole numbers are exact below 2^53.
        s = q @ v.T if exact else q.astype(np.int64) @ v.astype(np.int64).T
        last, last_id = self.score[low:high, -1:], self.ident[low:high, -1:]
        good = (s > last) | ((s == last) & (ident < last_id))
        if (room := self.most + n - len(np.unique(ident))) < n:
            good &= s >= np.partition(s, n - room, axis=1)[:, n - room, None]
        row, col = np.nonzero(good)
        if not len(row):
            return
        mine = np.unique(row)
        held = (self.score[low:high][mine] != NONE).ravel()
        owner = np.append(np.repeat(mine, self.most)[held], row)
        score = np.append(self.score[low:high][mine].ravel()[held], s[row, col].astype(np.int64))
        ids = np.append(self.ident[low:high][mine].ravel()[held], ident[col])
        at = best_first(owner, score, ids, self.most)
        starts = np.flatnonzero(np.diff(owner[at], prepend=-1))
        place = np.arange(len(at)) - np.repeat(starts, np.diff(np.append(starts, len(at))))
        self.score[low + owner[at], place], self.ident[low + owner[at], place] = score[at], ids[at]

    def rows(self) -> pa.RecordBatch:
        row, col = np.nonzero(self.score != NONE)
        return pa.RecordBatch.from_arrays([pa.array(self.head[row]), pa.array(self.ident[row, col]), pa.array(self.score[row, col])], ["head", "vec_id", "score"])


def _solved(dealt: DataFrame, most: int) -> DataFrame:
    """Rows sorted by joint group, slice and kind: the queries are held while the vectors pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, now = None, [], None
        for batch in _blocks(batches, BLOCK):
            group, part, kind = (batch.column(i).to_numpy() for i in range(3))
            edges = np.flatnonzero(np.diff(group) | np.diff(part) | np.diff(kind)) + 1
            for low, high in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows], strict=True):
                if low == high:
                    continue
                rows = batch.slice(low, high - low)
                if (at := (int(group[low]), int(part[low]))) != key:
                    if now:
                        yield now.rows()
                    key, held, now = at, [], None
                if not kind[low]:
                    held.append(rows)
                elif held:
                    now = now or Best(held, most)
                    now.meet(rows.column(3).to_numpy(), rows.column(4).to_numpy(), _matrix(rows.column(5), rows.num_rows))
        if now:
            yield now.rows()

    return dealt.mapInArrow(trimmed(run), "head bigint, vec_id bigint, score bigint")


DEALT = "grp int, slice int, kind int, ident bigint, bits bigint, _v array<int>"


def _dealt(rows: DataFrame, heads: DataFrame, cells: Cells, theta: np.ndarray, groups: list[list[tuple[int, int, int]]], slices: int, most: int) -> DataFrame:
    """Each query in every slice of its joint group; each vector in one slice of the joint groups that need it."""
    place = {(cell, part): (g, 1 << bit, parts) for g, group in enumerate(groups) for bit, (cell, part, parts) in enumerate(group)}
    parts = {cell: n for (cell, _), (_, _, n) in place.items()}
    index = [np.array([cell for cell, _, _ in group]) for group in groups]

    def record(group: np.ndarray, kind: int, ident: np.ndarray, bits: np.ndarray, v: pa.Array) -> pa.RecordBatch:
        zero = np.zeros(len(group), np.int32)
        columns = [pa.array(group.astype(np.int32)), pa.array(zero), pa.array(zero + kind), pa.array(ident), pa.array(bits.astype(np.int64)), v]
        return pa.RecordBatch.from_arrays(columns, ["grp", "slice", "kind", "ident", "bits", "_v"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches, BLOCK):
            cell, _ = nearest_cell(_matrix(part.column(1), part.num_rows), cells.pivots)
            head = part.column(0).to_numpy()
            found = [place[(c, h % parts[c])] for c, h in zip(cell.tolist(), head.tolist(), strict=True)]
            yield record(np.array([f[0] for f in found]), 0, head, np.array([f[1] for f in found]), part.column(1))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Of equal vectors in a batch only those of the smallest ids can be in a result.
            v = np.ascontiguousarray(batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1))
            copies = np.unique(v.view(f"V{v.strides[0]}").ravel(), return_inverse=True)[1]
            keep = np.sort(best_first(copies, np.zeros(len(v)), batch.column(0).to_numpy(), most))
            for part in _blocks(iter([batch.take(pa.array(keep))]), BLOCK):
                _, high = cells.bounds(_matrix(part.column(1), part.num_rows))
                need = high >= theta
                for g, mine in enumerate(index):
                    bits = (need[:, mine].astype(np.int64) << np.arange(len(mine))).sum(1)
                    some = np.flatnonzero(bits)
                    if len(some):
                        yield record(np.full(len(some), g), 1, part.column(0).to_numpy()[some], bits[some], part.column(1).take(pa.array(some)))

    asked = heads.mapInArrow(trimmed(ask), DEALT).withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    given = rows.mapInArrow(trimmed(answer), DEALT).withColumn("slice", F.pmod(F.xxhash64("ident"), F.lit(slices)).cast("int"))
    dealt = asked.select("grp", "slice", "kind", "ident", "bits", "_v").unionByName(given)
    return dealt.repartition("grp", "slice").sortWithinPartitions("grp", "slice", "kind")


def nearest_cell(v: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pivot at the smallest angle and its cosine; a zero vector is opposite to the first, as it has no direction."""
    size = np.sqrt((v**2).sum(1))
    a = v @ pivots.T / np.where(size, size, 1)[:, None]
    cell = np.where(size > 0, a.argmax(1), 0)
    return cell, np.where(size > 0, a[np.arange(len(v)), cell], -1.0)


def _covered(heads: DataFrame, pivots: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Per cell the smallest cosine of its queries to the pivot, and how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _blocks(batches, BLOCK):
            cell, cosine = nearest_cell(_matrix(part.column(0), part.num_rows), pivots)
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(cosine)], ["cell", "cosine"])

    cosines, counts = np.ones(len(pivots)), [0] * len(pivots)
    for r in heads.select("_v").mapInArrow(trimmed(run), "cell int, cosine double").groupBy("cell").agg(F.min("cosine").alias("cosine"), F.count(F.lit(1)).alias("n")).collect():
        cosines[r["cell"]], counts[r["cell"]] = r["cosine"], r["n"]
    return cosines, counts


def top_products(vectors: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, id_col: str = "vec_id", vec_col: str = "embedding", per_pivot: int = PER_PIVOT, held: int = QUERIES_HELD) -> DataFrame:
    """Per query (ids divisible by ``every``) the ``k`` vectors of the largest inner products: query_id, rank, vec_id, score.

    Components become floor(scale * x), at most 2^25 either way. Ties go to the smaller id. Vectors that are null or
    hold a null or non-finite component, rows without an id that is a whole number, and vectors of another length than the most common one
    (the longest of these) take no part. A query with fewer candidates gets them all. Rows that repeat an id with an
    equal vector count once; an id with several vectors stands for each of them, as a query and as a candidate, at
    its best. Vectors of zeros take part. Other columns play no part, whatever their names. An empty table gives an
    empty result.
    """
    spark, most = vectors.sparkSession, k + 1
    rows = vectors.select(F.col(f"`{id_col}`").try_cast("bigint").alias("_id"), whole_numbers(vec_col, scale, MOST).alias("_v")).filter("_id IS NOT NULL AND _v IS NOT NULL")
    rows = kept_as_table(rows)
    sizes = rows.groupBy(F.size("_v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    asked = rows.filter(F.pmod("_id", F.lit(every)) == 0).select(F.col("_id").alias("query_id"), "_v").distinct()
    asked = asked.filter(F.size("_v") == sizes[0]["d"]) if sizes else asked
    # Equal queries are looked up once, under a number.
    heads = cut(asked.select("_v").distinct().select(F.monotonically_increasing_id().alias("head"), "_v"))
    if not (n_heads := heads.count()) or not sizes[0]["d"]:
        drop_table(rows)
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    own = rows.filter(F.size("_v") == sizes[0]["d"])
    m = min(PIVOTS, -(-n_heads // per_pivot))
    drawn = heads.filter(F.exists("_v", lambda x: x != 0)).orderBy(F.xxhash64(F.lit(SEED), "_v"), "_v").limit(m).select("_v").collect()
    pivots = np.array([r["_v"] for r in drawn] or [[1.0] * sizes[0]["d"]], np.float64)
    pivots /= np.sqrt((pivots**2).sum(1))[:, None]
    cosines, counts = _covered(heads, pivots)
    cells = Cells(pivots, cosines)
    theta = _reached(own, cells, most)
    groups = joint_groups(pivots, counts, held)
    slices = int(max(1, min(-(-sizes[0]["n"] // SLICE), max(8, SLICES * len(groups)))))
    listed = _solved(_dealt(own, heads, cells, theta, groups, slices, most), most)
    nth = F.row_number().over(Window.partitionBy("head").orderBy(F.desc("score"), "vec_id"))
    listed = listed.withColumn("_n", nth).filter(F.col("_n") <= most).drop("_n")
    pairs = dealt_join(asked.join(heads, "_v").select("query_id", "head"), listed, "head").filter("vec_id <> query_id")
    pairs = pairs.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    out = cut(pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
    drop_table(rows)
    return out


def op13_products(spark, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"))


QUERIES = {"op13_products": op13_products}
SQL = {
    "op13_products": f"""
        WITH v AS MATERIALIZED (
            SELECT vec_id, [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS x FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
        s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.x, v.x) AS BIGINT) AS score FROM v q JOIN v ON q.vec_id % {EVERY} = 0 AND q.vec_id <> v.vec_id),
        r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
    """
}
