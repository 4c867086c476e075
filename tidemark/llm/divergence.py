"""Audit of how far the sources of a language differ, by dense tiles of groups and terms.

Terms are counted inside the tasks and summed by language, source and term. The kept terms of a language
are dealt as slices, and a slice meets the sources' totals in one task by an equality shuffle. There its
terms come in blocks: a block is an int64 matrix of sources by terms, and all pairs of sources are
compared by broadcasting the matrix against itself. A slice gives one partial matrix of pairs and one heap
of terms per source; partial matrices are summed and heaps merged. A language of many sources is cut into
blocks of sources, and each pair of these has slices of its own, so that no matrix grows with the table.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import MOST_BROADCAST, cut, documents, text_or_empty, trimmed

#: A kept term is in so many documents of its language; a report lists so many terms per source.
LEAST_DOCUMENTS, TOP = 3, 200
#: Shares are whole numbers of this unit, made in so many steps of a factor, so that no product leaves 64 bits.
UNIT_STEPS, STEP = 3, 1000
#: Sources in a block, terms in a slice, and numbers that a block of pairs may hold.
SOURCES, TERMS, NUMBERS = 128, 32_768, 2_000_000
#: Terms and bytes of text that a task counts before it passes its counts on, and bytes of a text looked at at a time.
HELD_TERMS, HELD_BYTES, PIECE = 200_000, 64_000_000, 4_000_000
#: Letters of ASCII and all bytes beyond it, as the contract's pattern has them on UTF-8.
TERM, BREAK = re.compile(rb"[A-Za-z\x80-\xff]+"), re.compile(rb"[^A-Za-z\x80-\xff]")


def pieces(text: bytes) -> Iterator[bytes]:
    """``text`` in parts of about ``PIECE`` bytes that cut no term."""
    at = 0
    while at < len(text):
        end = BREAK.search(text, at + PIECE) if len(text) > at + PIECE else None
        yield text[at : (stop := end.start() if end else len(text))]
        at = stop


def _counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs: sums over parts of a task's documents."""

    def flush(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, in_docs) in held.items():
            for at in range(0, len(n), 20_000):
                terms = list(n)[at : at + 20_000] if len(n) > 20_000 else list(n)
                columns = [pa.array([x] * len(terms), pa.string()) for x in (lang, source)]
                columns += [pa.array(terms, pa.binary()).cast(pa.string()), pa.array([n[t] for t in terms], pa.int64()), pa.array([in_docs[t] for t in terms], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        terms = size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
                n, in_docs = held.setdefault((lang, source), (Counter(), Counter()))
                before, seen, raw = len(n), set(), text.as_py()
                for part in pieces(raw):
                    found = TERM.findall(part.lower())
                    n.update(found)
                    seen.update(found)
                in_docs.update(seen)
                terms, size = terms + len(n) - before, size + len(raw)
                if terms > HELD_TERMS or size > HELD_BYTES:
                    yield from flush(held)
                    held, terms, size = {}, 0, 0
        yield from flush(held)

    return docs.mapInArrow(trimmed(run), "lang string, source string, term string, n bigint, docs bigint")


def shares(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(1000000000 * (count + 1) / whole), exact for wholes below 2**53 by long division."""
    rest, out = count + 1, np.zeros(np.broadcast_shapes(count.shape, whole.shape), np.int64)
    for _ in range(UNIT_STEPS):
        rest = rest * STEP
        digit = rest // whole
        out, rest = out * STEP + digit, rest - digit * whole
    return out + 1


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); shares are at most 10^9 + 1, so the square stays below 2^63."""
    d = p - q
    d *= d
    return (d.view(np.uint64) // q.view(np.uint64)).view(np.int64)


class Slice:
    """What a task knows of one slice: the totals of two blocks of sources, and the sums and heaps so far."""

    def __init__(self, key: tuple) -> None:
        self.lang, self.first = key[0], key[2] == 0
        self.totals: tuple[dict[str, int], dict[str, int]] = ({}, {})
        self.terms = self.whole = 0
        self.pairs: np.ndarray | None = None
        self.heaps: dict[str, list[tuple[int, str]]] = {}

    def _start(self) -> None:
        self.names = [list(t) for t in self.totals]
        self.bases = [np.array(list(t.values()), np.int64)[:, None] + self.terms for t in self.totals]
        self.pairs = np.zeros((len(self.names[0]), len(self.names[1])), np.int64)

    def _tile(self, side: int, rows: np.ndarray, names: pa.Array, counts: np.ndarray, n: int) -> np.ndarray:
        """Occurrences per source of a side (rows) and term (columns)."""
        tile = np.zeros((len(self.names[side]), n), np.int64)
        at = pc.fill_null(pc.index_in(names, value_set=pa.array(self.names[side], pa.string())), -1).to_numpy()
        tile[at[at >= 0], rows[at >= 0]] = counts[at >= 0]
        return tile

    def add(self, batch: pa.RecordBatch, top: int) -> None:
        if self.pairs is None:
            self._start()
        held, n = batch.column("held"), batch.num_rows
        rows = np.repeat(np.arange(n), pc.list_value_length(held).to_numpy())
        flat = held.flatten()
        names, counts = flat.field(0), flat.field(1).to_numpy()
        own = self._tile(0, rows, names, counts, n)
        p = shares(own, self.bases[0])
        q = p if self.names[0] == self.names[1] else shares(self._tile(1, rows, names, counts, n), self.bases[1])
        width = max(1, NUMBERS // max(1, p.shape[0] * q.shape[0]))
        for at in range(0, n, width):
            self.pairs += excess(p[:, None, at : at + width], np.ascontiguousarray(q[None, :, at : at + width])).sum(2)
        if self.first:
            self._rank(batch.column("name"), own, p, shares(batch.column("total").to_numpy(), np.array(self.whole + self.terms)), top)

    def _rank(self, terms: pa.Array, own: np.ndarray, p: np.ndarray, q: np.ndarray, top: int) -> None:
        for i, source in enumerate(self.names[0]):
            at = np.flatnonzero((own[i] > 0) & (p[i] > q))
            f = excess(p[i, at], np.ascontiguousarray(q[at]))
            if len(at) > top:
                more = f >= np.partition(f, len(f) - top)[len(f) - top]
                at, f = at[more], f[more]
            new = zip((-f).tolist(), terms.take(pa.array(at)).to_pylist(), strict=True)
            self.heaps[source] = heapq.nsmallest(top, [*self.heaps.get(source, ()), *new])

    def rows(self) -> pa.RecordBatch:
        if self.pairs is None:
            self._start()
        a, b = self.names
        pairs = [(x, y, v) for i, x in enumerate(a) for y, v in zip(b, self.pairs[i].tolist(), strict=True) if x != y]  # type: ignore[index]
        terms = [(x, t, -v) for x, heap in self.heaps.items() for v, t in heap]
        both = [*pairs, *terms]
        parts = ["pair"] * len(pairs) + ["term"] * len(terms)
        columns = [pa.array([self.lang] * len(both), pa.string()), pa.array([x[0] for x in both], pa.string()), pa.array(parts, pa.string()), pa.array([x[1] for x in both], pa.string()), pa.array([x[2] for x in both], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "part", "item", "value"])


def _compared(dealt: DataFrame, top: int) -> DataFrame:
    """Partial sums of pairs and heaps of terms from rows sorted by slice and kind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, None
        for batch in batches:
            lang, numbers, kind = batch.column(0).to_pylist(), [batch.column(i).to_numpy() for i in range(1, 4)], batch.column(4).to_numpy()
            keys = list(zip(lang, *(x.tolist() for x in numbers), strict=True))
            edges = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or kind[i] != kind[i - 1]]
            for low, high in zip([0, *edges], [*edges, len(keys)], strict=True):
                if low == high:
                    continue
                if keys[low] != key:
                    if now:
                        yield now.rows()
                    key, now = keys[low], Slice(keys[low])
                part = batch.slice(low, high - low)
                if kind[low] == 3:
                    now.add(part, top)  # type: ignore[union-attr]
                elif kind[low]:
                    now.totals[kind[low] - 1].update(zip(part.column("name").to_pylist(), part.column("total").to_pylist(), strict=True))  # type: ignore[union-attr]
                else:
                    now.terms, now.whole = part.column("terms")[0].as_py(), part.column("total")[0].as_py()  # type: ignore[union-attr]
        if now:
            yield now.rows()

    return dealt.mapInArrow(trimmed(run), "lang string, source string, part string, item string, value bigint")


def divergence(
    df: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", sources: int = SOURCES, terms: int = TERMS
) -> DataFrame:
    """lang, source, part, item, value, rank: how each source differs from the others of its language, and by which terms.

    A term is a run of letters of ASCII, in lower case, or of any other characters beyond ASCII. A language
    keeps those in at least ``least`` of its documents (rows; a repeated row is a document each time). With
    n the occurrences of a kept term in a group, N their sum and V the number of kept terms, its share is
    1 + floor(10^9 (n + 1) / (N + V)). Part ``pair`` compares a source with each other one by the sum of
    floor((p - q)^2 / q) over all kept terms; part ``term`` lists the ``top`` terms by which a source exceeds
    its language most. Null texts, languages and sources count as empty ones; a group without terms has its
    pairs, with 0 where its language keeps no term. Ties go by the item's bytes. Texts of any length are read
    whole. Other columns play no part, whatever their names. An empty table gives an empty result.
    """
    docs = df.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"), text_or_empty(text_col).alias("_text"))
    groups = docs.select("lang", "source").distinct()
    counts = _counted(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    # A list holds one entry per source of the language that has the term.
    by_term = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("held"))
    kept = cut(by_term.filter(F.col("docs") >= least).select("lang", "term", "total", "held"))
    totals = kept.select("lang", F.explode("held").alias("x")).groupBy("lang", F.col("x.source").alias("source")).agg(F.sum("x.n").alias("total"))
    groups = cut(groups.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")))
    langs = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / sources).cast("int").alias("blocks"))
    figures = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("whole"))
    langs = cut(langs.join(figures, "lang", "left").select("lang", "blocks", F.coalesce("terms", F.lit(0)).alias("terms"), F.coalesce("whole", F.lit(0)).alias("whole")))
    few = F.broadcast(langs) if langs.count() <= MOST_BROADCAST else langs

    slices = F.greatest(F.lit(1), F.ceil(F.col("terms") / terms)).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    block = lambda source, blocks: F.pmod(F.xxhash64(source), blocks).cast("int")
    none, order = F.lit(None).cast(kept.schema["held"].dataType), ["lang", "left", "right", "slice", "kind", "name", "total", "terms", "held"]
    head = langs.withColumn("left", numbers(F.col("blocks"))).withColumn("right", numbers(F.col("blocks"))).withColumn("slice", numbers(slices))
    head = head.select("lang", "left", "right", "slice", F.lit(0).alias("kind"), F.lit("").alias("name"), F.col("whole").alias("total"), "terms", none.alias("held"))
    own = groups.join(few, "lang").withColumn("own", block(F.col("source"), F.col("blocks"))).withColumn("other", numbers(F.col("blocks"))).withColumn("slice", numbers(slices))
    sides = [own.select("lang", F.col(a).alias("left"), F.col(b).alias("right"), "slice", F.lit(k).alias("kind"), F.col("source").alias("name"), "total", "terms", none.alias("held")) for k, a, b in ((1, "own", "other"), (2, "other", "own"))]
    rows = kept.join(few, "lang").withColumn("left", numbers(F.col("blocks"))).withColumn("right", numbers(F.col("blocks")))
    held = F.filter("held", lambda x: block(x["source"], F.col("blocks")).isin(F.col("left"), F.col("right")))
    rows = rows.select("lang", "left", "right", F.pmod(F.xxhash64("term"), slices).cast("int").alias("slice"), F.lit(3).alias("kind"), F.col("term").alias("name"), "total", "terms", F.when(F.col("blocks") == 1, F.col("held")).otherwise(held).alias("held"))
    dealt = head.unionByName(sides[0]).unionByName(sides[1]).unionByName(rows).select(*order)
    dealt = dealt.repartition("lang", "left", "right", "slice").sortWithinPartitions("lang", "left", "right", "slice", "kind")

    found = cut(_compared(dealt, top))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = found.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(best))
    listed = found.filter("part = 'term'").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return pairs.unionByName(listed).select("lang", "source", "part", "item", "value", "rank")


def op11_divergence(spark, sf_dir: str) -> DataFrame:
    return divergence(documents(spark, sf_dir))


QUERIES = {"op11_divergence": op11_divergence}
SQL = {
    "op11_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS r, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
        w AS MATERIALIZED (SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
        l AS (SELECT lang, count(*) AS v, sum(n) AS whole FROM k GROUP BY lang),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS MATERIALIZED (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
        s AS (SELECT lang, source, sum(n) AS whole FROM c GROUP BY ALL),
        p AS MATERIALIZED (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // CAST(coalesce(s.whole, 0) + l.v AS HUGEINT) AS p,
                   1 + CAST(1000000000 AS HUGEINT) * (k.n + 1) // CAST(l.whole + l.v AS HUGEINT) AS q
            FROM g JOIN l USING (lang) JOIN k USING (lang) LEFT JOIN s USING (lang, source) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
        u AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT lang, source, part, item, value, rank FROM u WHERE part = 'pair' OR rank <= 200
    """
}
