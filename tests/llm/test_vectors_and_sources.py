"""Source divergence, clustering and inner products against brute force, on small tables with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tidemark.llm import centroids, divergence, inner_products

# ---------------------------------------------------------------- source divergence


def audited(rows, least=3, top=200):
    """The contract in whole numbers of any length."""
    docs = [(g or "", s or "", t or "") for g, s, t in rows]
    found = [(g, s, [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)]) for g, s, t in docs]
    out = []
    for lang in {g for g, _, _ in docs}:
        df = Counter(x for g, _, ts in found if g == lang for x in set(ts))
        kept = [x for x in df if df[x] >= least]
        count = defaultdict(Counter)
        for g, s, ts in found:
            if g == lang:
                count[s].update(x for x in ts if x in set(kept))
        whole = sum(count.values(), Counter())
        share = lambda c, x: 1 + 1_000_000_000 * (c[x] + 1) // (c.total() + len(kept))
        for s in count:
            pairs = [(-sum((share(count[s], x) - share(count[o], x)) ** 2 // share(count[o], x) for x in kept), o.encode(), o) for o in count if o != s]
            terms = [(-((share(count[s], x) - share(whole, x)) ** 2 // share(whole, x)), x.encode(), x) for x in kept if count[s][x] and share(count[s], x) > share(whole, x)]
            out += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pairs), 1)] + [(lang, s, "term", x, -v, i) for i, (v, _, x) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def sources():
    rng = random.Random(3)
    names = ["alpha", "Alpha", "été", "Été", "straße", "x" * 3000, "日本", "a", "b", "c", "d1e", "_f", "g-h"]
    rows = [(rng.choice(["en", None, "", "fr"]), rng.choice(["s1", "s2", "s3", None, "é"]), " ".join(rng.choice(names) for _ in range(rng.randint(0, 25)))) for _ in range(120)]
    return [*rows, *rows[:9], ("en", "s9", None), ("it", "s1", ""), ("it", "s2", "12 34"), ("it", "s3", "one"), ("es", "only", "uno uno"), ("en", "long", "Wort, " * 40_000)]


def answered(df):
    return sorted(map(tuple, df.collect()))


def test_divergence(spark, sources):
    df = spark.createDataFrame([(g, s, t, 7, "n") for g, s, t in sources], "lang string, source string, text string, total long, held string")
    out = divergence.divergence(df)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert answered(out) == audited(sources)
    assert any(r[0] == "it" and r[2] == "pair" and r[4] == 0 for r in answered(out))
    assert divergence.divergence(df.limit(0)).count() == 0


def test_divergence_in_blocks_of_sources_and_slices_of_terms(spark):
    rng = random.Random(5)
    rows = [("en", f"s{rng.randint(0, 30)}", " ".join("abcdefgh"[rng.randint(0, 7)] + "abcdefgh"[min(7, int(rng.expovariate(0.5)))] for _ in range(20))) for _ in range(300)]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert answered(divergence.divergence(df, top=5, sources=7, terms=10)) == audited(rows, top=5)


def test_divergence_counts_in_parts(spark, sources, monkeypatch):
    text = b"ab, " * 5 + b"x" * 50 + b" end"
    monkeypatch.setattr(divergence, "PIECE", 7)
    assert b"".join(divergence.pieces(text)) == text
    assert [t for p in divergence.pieces(text) for t in divergence.TERM.findall(p)] == divergence.TERM.findall(text)
    assert list(divergence.pieces(b"")) == []


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(500):
        whole = rng.randint(1, 2**52)
        count = rng.randint(0, whole - 1)
        assert divergence.shares(np.array([count]), np.array([whole]))[0] == 1 + 1_000_000_000 * (count + 1) // whole
    p, q = np.array([1_000_000_001, 1, 5]), np.array([1, 1_000_000_001, 5])
    assert divergence.excess(p, q).tolist() == [10**18, (10**9) ** 2 // 1_000_000_001, 0]


# ---------------------------------------------------------------- clustering


def clustered(rows, k, rounds, scale, dims):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows if v and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    now = [v for _, v in sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    place = lambda v: min((far(v, c), j) for j, c in enumerate(now))
    for _ in range(rounds):
        by = defaultdict(list)
        for _, v in kept:
            by[place(v)[1]].append(v)
        now = [[sum(x) // len(by[j]) for x in zip(*by[j], strict=True)] if by[j] else c for j, c in enumerate(now)]
    placed = [(i, *place(v)) for i, v in kept]
    inertia = Counter()
    for _, d, j in placed:
        inertia[j] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return [(i, j, d, inertia[j], inertia.total(), digest[j]) for i, d, j in placed]


def vectors(seed, n, dims, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return [(int(i), [float(np.float32(x)) for x in middle[rng.integers(centres)] + 0.3 * rng.normal(size=dims)]) for i in range(n)]


SCHEMA = "vec_id long, embedding array<float>, cluster string, _v string"
ordered = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r))


def test_clusters(spark):
    rows = [*vectors(1, 300, 8), (None, [0.5] * 8), (None, [0.25] * 8), (900, None), (901, []), (902, [1.0] * 7), (903, [None] + [1.0] * 7), (904, [float("nan")] * 8), (905, [float("inf")] + [0.0] * 7)]
    rows += rows[:5] + [(5, [9.0] * 8)] + [(1000 + i, [0.125] * 8) for i in range(150)]
    df = spark.createDataFrame([(i, v, "c", "v") for i, v in rows], SCHEMA).repartition(7)
    out = centroids.clusters(df, centroids=12, dims=8)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    want = clustered(rows, 12, 5, 256, 8)
    assert ordered(map(tuple, out.collect())) == ordered(want)
    assert centroids.clusters(df.limit(0)).count() == 0
    assert centroids.clusters(df).count() == 0  # no vector of 64 components
    few = rows[:4]
    assert ordered(map(tuple, centroids.clusters(spark.createDataFrame([(i, v, "", "") for i, v in few], SCHEMA), dims=8).collect())) == ordered(clustered(few, 40, 5, 256, 8))


def test_clusters_of_extreme_and_equal_vectors(spark):
    rows = [(i, [3e38, -3e38]) for i in range(3)] + [(9, [0.0, 0.0])]
    out = {r["vec_id"]: r for r in centroids.clusters(spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA), centroids=2, dims=2).collect()}
    assert len(out) == 4 and all(r["distance"] >= 0 for r in out.values())


def test_partial_distances_are_whole_ones():
    rng = np.random.default_rng(2)
    for k, dims, steps in ((1, 3, [1]), (7, 16, [2, 4, 8]), (40, 64, [8, 16, 32])):
        x, c = rng.integers(-3, 4, (500, dims)), rng.integers(-3, 4, (k, dims))
        which, distance = centroids.nearest_centroids(x, c, steps)
        d = ((x[:, None] - c[None]) ** 2).sum(2)
        assert which.tolist() == d.argmin(1).tolist() and distance.tolist() == d.min(1).tolist()


# ---------------------------------------------------------------- inner products


def multiplied(rows, k, every, scale, dims):
    kept = {(i, tuple(int(np.floor(scale * float(np.float32(x)))) for x in v)) for i, v in rows if i is not None and v and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in sorted({i for i, _ in kept if i % every == 0}):
        best: dict[int, int] = {}
        for _, a in (r for r in kept if r[0] == q):
            for i, b in kept:
                if i != q:
                    s = sum(x * y for x, y in zip(a, b, strict=True))
                    best[i] = max(best.get(i, s), s)
        out += [(q, n, i, s) for n, (s, i) in enumerate(sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:k], 1)]
    return out


ODD = [(None, [1.0] * 8), (4000, None), (4001, []), (4020, [1.0] * 7), (4040, [None] + [1.0] * 7), (4060, [float("nan")] * 8), (4080, [0.0] * 8), (4100, [0.0] * 8), (4101, [0.0] * 8)]


@pytest.mark.parametrize(("per_pivot", "held"), [(256, 32_768), (3, 7), (5, 2)])
def test_products(spark, per_pivot, held):
    rows = [*vectors(4, 600, 8, 9), *ODD]
    rows += rows[:40] * 3 + [(20, [2.0] * 8), (7, [3.0] + [0.0] * 7)] + [(5000 + i, [0.5] * 8) for i in range(400)]
    df = spark.createDataFrame([(i, v, "c", "v") for i, v in rows], SCHEMA).repartition(5)
    out = inner_products.top_products(df, per_pivot=per_pivot, held=held)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert answered(out) == multiplied(rows, 20, 20, 64, 8)


def test_products_of_few_none_and_large(spark):
    df = spark.createDataFrame([(i, v, "", "") for i, v in ODD], SCHEMA)
    assert answered(inner_products.top_products(df)) == multiplied(ODD, 20, 20, 64, 8)
    assert inner_products.top_products(df.limit(0)).count() == 0
    one = [(20, [1.0, 2.0])]
    assert inner_products.top_products(spark.createDataFrame([(i, v, "", "") for i, v in one], SCHEMA)).count() == 0
    large = [(20 * i, [float(400_000 - i), float(300_000 + i)]) for i in range(30)]
    assert answered(inner_products.top_products(spark.createDataFrame([(i, v, "", "") for i, v in large], SCHEMA))) == multiplied(large, 20, 20, 64, 2)


def test_bounds_hold_and_leave_out():
    """Products lie within the bounds of their cell; where queries lie close together, most vectors go to few cells."""
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(12, 16))
    v = np.floor(64 * np.repeat(middle, 40, 0) + 3 * rng.normal(size=(480, 16)))
    queries, pivots = v[::7], v[::40]
    pivots = pivots / np.sqrt((pivots**2).sum(1))[:, None]
    cell, cosine = inner_products.nearest_cell(queries, pivots)
    worst = np.array([cosine[cell == c].min(initial=1.0) for c in range(12)])
    low, high = inner_products.Cells(pivots, worst).bounds(v)
    unit = queries / np.sqrt((queries**2).sum(1))[:, None]
    s = v @ unit.T
    assert (low[:, cell] <= s).all() and (s <= high[:, cell]).all()
    theta = np.sort(low, axis=0)[-21]
    assert (high >= theta).mean() < 0.5
    groups = inner_products.joint_groups(pivots, [5, 0, 90, 40, 3, 3, 3, 3, 3, 3, 3, 3], most=40, wide=3)
    assert sorted(c for g in groups for c, p, _ in g if not p) == [0, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]
    assert all(len(g) <= 3 for g in groups) and [p for g in groups for c, p, _ in g if c == 2] == [0, 1, 2]
