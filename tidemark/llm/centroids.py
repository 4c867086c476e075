"""Clustering around centroids in whole numbers, with partial-distance search.

Vectors are turned into whole numbers once and written as a narrow table that all rounds read. A task gets the
centroids and compares blocks of vectors with them: squared differences are summed over the dimensions of
highest variance first, a centroid is abandoned once its partial sum is strictly above the best whole distance
so far, and those that survive finish all dimensions. A round's sums are made per task and added by Spark, so
that one row per centroid reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, drop_table, kept_as_table, table, trimmed

#: Centroids, rounds, components, what a component is multiplied with, and what the choice of the first centroids is salted with.
CENTROIDS, ROUNDS, DIMENSIONS, SCALE, SALT = 40, 5, 64, 256, "2:"
#: Components beyond this count as this, so that squared distances fit into 64 bits.
MOST = 2**27
#: Share of the dimensions after which centroids are abandoned, and vectors compared at a time.
STEPS, BLOCK = (1 / 8, 1 / 4, 1 / 2), 2048


def whole_numbers(vec_col: str, scale: int, most: int) -> Column:
    """floor(scale * x) of each component, within ``most`` either way; null for vectors that are null or hold a null or non-finite component."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(v, lambda x: F.floor(F.greatest(F.lit(float(-most)), F.least(F.lit(float(most)), x * scale))).cast("int")))


def nearest_centroids(x: np.ndarray, centroids: np.ndarray, steps: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid, the smaller number of equal ones.

    ``steps``: after how many dimensions centroids are abandoned; the dimensions are in the order in which they are used.
    """

    def rest(rows: np.ndarray, which: np.ndarray, low: int, high: int | None = None) -> np.ndarray:
        d = x[rows, low:high] - centroids[which, low:high]
        return np.einsum("ij,ij->i", d, d)

    n, first, everyone = len(x), steps[0], np.arange(len(x))
    d = x[:, None, :first] - centroids[None, :, :first]
    part = np.einsum("ijk,ijk->ij", d, d)
    lead = part.argmin(1)
    best = part[everyone, lead] + rest(everyone, lead, first)
    rows, which = np.nonzero(part <= best[:, None])
    sums = part[rows, which]
    for low, high in zip(steps, [*steps[1:], x.shape[1]], strict=True):
        sums = sums + rest(rows, which, low, high)
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        ahead = np.repeat(np.minimum.reduceat(sums, starts), np.diff(np.append(starts, len(rows)))) == sums
        at = np.flatnonzero(ahead)
        at = at[np.flatnonzero(np.diff(rows[at], prepend=-1))]  # the first of the leaders of each row
        if high == x.shape[1]:
            return which[at], sums[at]
        best = np.minimum(best, sums[at] + rest(rows[at], which[at], high))
        alive = sums <= best[rows]
        rows, which, sums = rows[alive], which[alive], sums[alive]
    raise AssertionError(n)


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(n, -1).astype(np.int64)


def _order(rows: DataFrame, width: int) -> np.ndarray:
    """The dimensions, that of the highest variance first; rounding changes the work of a search, not its result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(2 * width)
        for batch in batches:
            x = _matrix(batch.column(0), batch.num_rows).astype(np.float64)
            n, sums = n + len(x), sums + np.append(x.sum(0), (x**2).sum(0))
        yield pa.RecordBatch.from_arrays([pa.array([float(n)]), pa.array([sums.tolist()], pa.list_(pa.float64()))], ["n", "sums"])

    found = rows.select("_v").mapInArrow(trimmed(run), "n double, sums array<double>")
    n, *sums = found.agg(F.sum("n"), *[F.sum(F.col("sums")[i]) for i in range(2 * width)]).first()  # type: ignore[misc]
    mean, square = np.array(sums[:width]) / n, np.array(sums[width:]) / n
    return np.argsort(mean**2 - square, kind="stable")


def _sums(rows: DataFrame, centroids: np.ndarray, order: np.ndarray, steps: list[int]) -> list[tuple[int, int, list[int]]]:
    """Per centroid that has vectors: its number, how many, and their sums by component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        n, sums, own = np.zeros(k, np.int64), np.zeros(centroids.shape, np.int64), centroids[:, order]
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                x = _matrix(part.column(0), part.num_rows)
                which, _ = nearest_centroids(x[:, order], own, steps)
                by = np.argsort(which, kind="stable")
                starts = np.flatnonzero(np.diff(which[by], prepend=-1))
                n += np.bincount(which, minlength=k)
                sums[which[by][starts]] += np.add.reduceat(x[by], starts)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    found = rows.select("_v").mapInArrow(trimmed(run), "cluster int, n bigint, sums array<bigint>")
    # Tasks' sums are added as decimals, as those of a table may leave 64 bits.
    parts = [F.sum(F.col("sums")[i].cast("decimal(20,0)")) for i in range(centroids.shape[1])]
    return [(r[0], r[1], [int(x) for x in r[2:]]) for r in found.groupBy("cluster").agg(F.sum("n"), *parts).collect()]


def clusters(
    vectors: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMENSIONS, scale: int = SCALE, salt: str = SALT, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """Per vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Vectors of another length than ``dims``, null ones and those with null or non-finite components are not in the
    result. Components become floor(scale * x), at most 2^27 either way. The first centroids are the vectors whose
    ids have the smallest SHA-256 behind ``salt`` (a null id is hashed as an empty one; equal hashes go by
    components); of fewer vectors than ``centroids`` each is one. Equal distances go to the smaller number, a
    centroid without vectors stays. Rows that repeat an id are vectors each. Other columns play no part, whatever
    their names. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").alias("_id"), F.when(F.size(F.col(f"`{vec_col}`")) == dims, whole_numbers(vec_col, scale, MOST)).alias("_v")).filter("_v IS NOT NULL")
    rows = kept_as_table(rows)
    drawn = rows.orderBy(F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256), "_v").limit(centroids).select("_v").collect()
    kind = vectors.schema[id_col].dataType.simpleString()
    if not drawn:
        return spark.createDataFrame([], f"_id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string").withColumnRenamed("_id", id_col)
    now = np.array([r["_v"] for r in drawn], np.int64)
    order = _order(rows, dims)
    steps = sorted({max(1, int(dims * s)) for s in STEPS if max(1, int(dims * s)) < dims}) or [dims]
    for _ in range(rounds):
        for cluster, n, sums in _sums(rows, now, order, steps):
            now[cluster] = [s // n for s in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                which, distance = nearest_centroids(_matrix(part.column(1), part.num_rows)[:, order], now[:, order], steps)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(which.astype(np.int32)), pa.array(distance)], ["_id", "cluster", "distance"])

    placed = cut(rows.mapInArrow(trimmed(run), f"_id {kind}, cluster int, distance bigint"))
    drop_table(rows)
    sums = {r[0]: int(r[1]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)"))).collect()}
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    figures = [(c, s, sum(sums.values()), digest(now[c].tolist())) for c, s in sums.items()]
    # One row per centroid.
    out = placed.join(F.broadcast(spark.createDataFrame(figures, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")), "cluster")
    return out.select(F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_clusters(spark, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds written out one after the other."""
    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS r, [CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x FROM embeddings"
        f" WHERE len(embedding) = {DIMENSIONS} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMENSIONS})",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('{SALT}' || vec_id)) - 1 AS INTEGER) AS c, x AS m FROM v ORDER BY sha256('{SALT}' || vec_id) LIMIT {CENTROIDS})",
    ]
    for i in range(ROUNDS + 1):
        parts.append(
            f"a{i} AS MATERIALIZED (SELECT r, vec_id, x, min((d, c)) AS best FROM (SELECT r, vec_id, x, c, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(x, m)]) AS d FROM v CROSS JOIN c{i}) GROUP BY ALL)"
        )
        if i < ROUNDS:
            parts.append(f"u{i} AS (SELECT best[2] AS c, unnest(x) AS x, generate_subscripts(x, 1) AS j FROM a{i})")
            parts.append(f"s{i} AS (SELECT c, j, sum(x) AS s, count(*) AS n FROM u{i} GROUP BY c, j)")
            parts.append(f"f{i} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS m FROM s{i} GROUP BY c)")
            parts.append(f"c{i + 1} AS MATERIALIZED (SELECT o.c, coalesce(f.m, o.m) AS m FROM c{i} o LEFT JOIN f{i} f ON o.c = f.c)")
    last = f"a{ROUNDS}"
    return (
        f"WITH {', '.join(parts)} SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, CAST(best[1] AS BIGINT) AS distance, CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia,"
        f" CAST(sum(best[1]) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM {last} JOIN c{ROUNDS} ON best[2] = c"
    )


QUERIES = {"op12_clusters": op12_clusters}
SQL = {"op12_clusters": _sql()}
