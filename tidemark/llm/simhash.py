"""SimHash near duplicates through deletion-variant signatures.

A fingerprint of B bits and a radius of k bits are cut into k // 2 + 1 segments, so that one of the
segments of two linked fingerprints differs by at most one bit. Each segment is indexed once per
bit position with that bit wiped out; two segments that differ by at most one bit share such a
variant. Equal fingerprints are one class from the start, variants of distinct fingerprints meet by
an equality shuffle, and each bucket is read as a sorted stream, compared in blocks and reduced to a
spanning forest, so a bucket of n fingerprints gives fewer than n links and never all its pairs. A
bucket of very many fingerprints isn't held: its rows go on to a second index over the bits outside
the bucket's segment, cut and wiped in the same way, which loses no link either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import MOST_BROADCAST, as_often, cut, dealt_join, documents, drop_table, kept_as_table, row_hash, trimmed
from tidemark.llm.components import components

#: The contract's fixed values.
WORDS, BITS, RADIUS, HASH_SEED = 4, 64, 4, 42
#: Shingles hashed at a time, and fingerprints compared at a time.
SHINGLES, BLOCK = 1 << 20, 1024
#: Fingerprints of a bucket that a task holds; larger buckets are indexed again.
HEAVY = 1 << 15
#: For documents that are alike: words in a shingle, and the least similarity as a fraction.
ALIKE_WORDS, ALIKE = 5, (4, 5)
#: One text in so many is read for the common shingles, which are those of so many sampled texts, and the most that are kept.
SAMPLED, COMMON, MOST_COMMON = 16, 3, 1 << 16
#: Odd multipliers: of the words of a shingle by place, of its mixing, and of the orders that give a bucket's leaders.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
#: Bits of the sketch that rules out pairs before their sets are fetched: at least, per shingle (then up to a power of two), and at most.
LEAST_ODD, ODD, MOST_ODD = 1 << 9, 4, 1 << 16
LEADERS = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def _halves(buffer: bytes, n_words: int) -> Iterator[bytes]:
    """The shingles of space-joined words."""
    ends = [i for i in np.flatnonzero(np.frombuffer(buffer, np.uint8) == 32).tolist()]
    starts, ends = [0, *(i + 1 for i in ends)], [*ends, len(buffer)]
    if len(starts) <= n_words:
        return iter([buffer])
    return (buffer[a:b] for a, b in zip(starts, ends[n_words - 1 :], strict=False))


def words_of(text: str | None) -> bytes:
    """The text with A-Z lower-cased and its words joined by one space; bytes split on ASCII white space only."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def shingle_hashes(text: str | None, n_words: int = WORDS, seed: int = HASH_SEED) -> Iterator[np.ndarray]:
    """XXH64 of the shingles, in blocks; nothing for a text without words."""
    joined = words_of(text)
    if not joined:
        return
    block: list[int] = []
    digest = xxhash.xxh64_intdigest
    for shingle in _halves(joined, n_words):
        block.append(digest(shingle, seed))
        if len(block) == SHINGLES:
            yield np.array(block, np.uint64)
            block = []
    if block:
        yield np.array(block, np.uint64)


def _bit_counts(h: np.ndarray) -> np.ndarray:
    """How many of ``h`` have each bit set; column 0 is the highest bit."""
    bits = np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    out = np.zeros(64, np.int64)
    for i in range(0, len(bits), 255):  # sums of 255 rows fit in a byte
        out += np.add.reduce(bits[i : i + 255], axis=0, dtype=np.uint8)
    return out


def fingerprint(text: str | None, n_words: int = WORDS, bits: int = BITS) -> list[int]:
    """One unsigned 64-bit number per 64 bits; 0 for a text without words."""
    out = []
    for lane in range(bits // 64):
        counts, n = np.zeros(64, np.int64), 0
        for h in shingle_hashes(text, n_words, HASH_SEED + lane):
            counts += _bit_counts(h)
            n += len(h)
        out.append(int(np.packbits(counts * 2 > n).view(">u8")[0]) if n else 0)
    return out


def with_fingerprint(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS, bits: int = BITS) -> DataFrame:
    """Per row: _id and one long ``f0``, ``f1``, ... per 64 bits of the fingerprint (two's complement)."""
    lanes = bits // 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), n_words, bits) for t in batch.column(1)], np.uint64).reshape(-1, lanes).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, k]) for k in range(lanes))], ["_id", *(f"f{k}" for k in range(lanes))])

    rows = df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(trimmed(run), ", ".join([f"_id {kind}", *(f"f{k} bigint" for k in range(lanes))]))


def segments(bits: int, radius: int) -> list[tuple[int, int]]:
    """First bit and width of each segment."""
    n = radius // 2 + 1
    edges = [bits * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _variants(f: np.ndarray, places: list[int], radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each segment of the bits at ``places`` and each wiped bit, a number and what is left of each fingerprint's segment."""
    number = 0
    for first, width in segments(len(places), radius):
        part = np.zeros(len(f), np.uint64)
        for i in places[first : first + width]:
            part = (part << np.uint64(1)) | ((f[:, i // 64] >> np.uint64(63 - i % 64)) & np.uint64(1))
        for i in range(width):
            yield number, part & ~np.uint64(1 << i)
            number += 1


def _outside(number: int, bits: int, radius: int) -> list[int]:
    """The bits outside the segment of variant ``number``."""
    for first, width in segments(bits, radius):
        if number < width:
            return [i for i in range(bits) if not first <= i < first + width]
        number -= width
    raise ValueError(number)


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


class _Forest:
    """Union-find over positions; the roots are the least positions."""

    def __init__(self) -> None:
        self.parent: list[int] = []

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def spanning(f: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the graph that links rows of ``f`` at ``radius`` bits or fewer.

    Rows are added one by one. Every row belongs to the ball of a leader at most ``radius`` away, so
    a row can only be linked to members of a ball whose leader is within twice the radius. Once a
    row has met every component that it could meet, the rest of its candidates are not compared.
    """
    links, forest = [], _Forest()
    leaders: list[int] = []
    balls: list[list[int]] = []
    heads = np.zeros((16, f.shape[1]), np.uint64)
    for i in range(len(f)):
        forest.parent.append(i)
        near = _popcount(heads[: len(leaders)] ^ f[i]).sum(1, dtype=np.int64)
        close = np.flatnonzero(near <= 2 * radius)
        close = close[np.argsort(near[close], kind="stable")].tolist()
        for b in close:  # a ball's members are linked to its leader, so they are one component
            if forest.find(leaders[b]) == forest.find(i):
                continue
            if near[b] <= radius:
                forest.join(leaders[b], i)
                links.append((leaders[b], i))
            else:
                members = np.array(balls[b])
                hit = members[_popcount(f[members] ^ f[i]).sum(1, dtype=np.int64) <= radius]
                if len(hit):
                    forest.join(int(hit[0]), i)
                    links.append((int(hit[0]), i))
        if close and near[close[0]] <= radius:
            balls[close[0]].append(i)
        else:
            if len(leaders) == len(heads):
                heads = np.concatenate([heads, np.zeros_like(heads)])
            heads[len(leaders)] = f[i]
            leaders.append(i)
            balls.append([i])
    return links


def _bucket_links(f: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Small buckets are compared at once, larger ones through leaders."""
    n = len(f)
    if n > BLOCK:
        return spanning(f, radius)
    a, b = np.nonzero(np.triu(_popcount(f[:, None, :] ^ f[None, :, :]).sum(2, dtype=np.uint16) <= radius, 1))
    if len(a) < n:
        return list(zip(a.tolist(), b.tolist(), strict=True))
    forest = _Forest()
    forest.parent = list(range(n))
    return [(i, j) for i, j in zip(a.tolist(), b.tolist(), strict=True) if forest.join(i, j)]


def _buckets(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Keys, ids and fingerprints of whole buckets from a stream sorted by key; the last bucket of a batch waits for the next.

    With ``most``, a bucket that spans batches and grows beyond it comes in parts, which are marked.
    """
    rest: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    heavy = None

    def joined(parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))  # type: ignore[return-value]

    for batch in batches:
        key, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        f = np.column_stack([batch.column(k).to_numpy() for k in range(2, batch.num_columns)]).view(np.uint64)
        if heavy is not None and len(key):
            n = int(np.searchsorted(key, heavy, "right"))
            if n:
                yield key[:n], ids[:n], f[:n], True
            key, ids, f = key[n:], ids[n:], f[n:]
            heavy = None if len(key) else heavy
        if not len(key):
            continue
        last = int(np.searchsorted(key, key[-1]))
        if last or (rest and rest[-1][0][-1] != key[0]):
            whole = joined([*rest, (key[:last], ids[:last], f[:last])])
            rest = []
            if len(whole[0]):
                yield *whole, False
        rest.append((key[last:], ids[last:], f[last:]))
        if most is not None and sum(len(x[0]) for x in rest) > most:
            heavy = int(key[-1])
            yield *joined(rest), True
            rest = []
    if rest:
        yield *joined(rest), False


def links_of(classes: DataFrame, bits: int = BITS, radius: int = RADIUS, heavy: int = HEAVY) -> DataFrame:
    """Links u, v between classes (node, f0, ...) whose fingerprints differ in ``radius`` bits or fewer.

    Within each bucket the links form a spanning forest, so the components are those of all pairs.
    Buckets of more than ``heavy`` fingerprints are indexed again by the bits that their fingerprints
    need not share; whatever is linked in the bucket shares one of the smaller buckets.
    """
    lanes = [f"f{k}" for k in range(bits // 64)]
    longs = ", ".join(f"{x} bigint" for x in lanes)

    def lanes_of(part: pa.RecordBatch, first: int) -> np.ndarray:
        return np.column_stack([part.column(first + k).to_numpy() for k in range(len(lanes))]).view(np.uint64)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                for number, left in _variants(lanes_of(part, 1), list(range(bits)), radius):
                    yield pa.RecordBatch.from_arrays([pa.array((left | np.uint64(number << 40)).view(np.int64)), *part.columns], ["key", "node", *lanes])

    def index_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            for number in np.unique(key >> 40).tolist():
                part = batch.filter(pa.array(key >> 40 == number))
                own = part.column(0).to_numpy().view(np.uint64) * PLACES[0]
                for again, left in _variants(lanes_of(part, 2), _outside(number, bits, radius), radius):
                    # A hash of both buckets; a clash of two only makes a bucket larger.
                    mixed = (own ^ (left | np.uint64(again << 48)) * PLACES[1]) * MIX[0]
                    yield pa.RecordBatch.from_arrays([pa.array((mixed ^ (mixed >> np.uint64(31))).view(np.int64)), *part.columns[1:]], ["key", "node", *lanes])

    def compare(most: int | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Links as (u, v, null ...); rows of buckets that are too large as (node, key, fingerprint)."""
            seen: set[tuple[int, int]] = set()
            for key, ids, f, large in _buckets(batches, most):
                if large:
                    yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(key), *(pa.array(f[:, k].view(np.int64)) for k in range(len(lanes)))], ["u", "v", *lanes])
                    continue
                edges = np.flatnonzero(np.diff(key)) + 1
                starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(key)]])
                many = ends - starts
                u: list[int] = []
                v: list[int] = []
                pairs = starts[many == 2]
                if len(pairs):  # most buckets that link anything
                    hit = pairs[_popcount(f[pairs] ^ f[pairs + 1]).sum(1, dtype=np.int64) <= radius]
                    u, v = ids[hit].tolist(), ids[hit + 1].tolist()
                for a, b in zip(starts[many > 2].tolist(), ends[many > 2].tolist(), strict=True):
                    for i, j in _bucket_links(f[a:b], radius):
                        u.append(int(ids[a + i]))
                        v.append(int(ids[a + j]))
                new = {(x, y) if x > y else (y, x) for x, y in zip(u, v, strict=True)} - seen
                seen = seen | new if len(seen) < 100_000 else new  # spares most repeats, no more
                if new:
                    a, b = zip(*new, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), *(pa.nulls(len(a), pa.int64()) for _ in lanes)], ["u", "v", *lanes])

        return run

    def dealt(keys: DataFrame) -> DataFrame:
        return keys.repartition("key").sortWithinPartitions("key", "node")

    keys = classes.select("node", *lanes).mapInArrow(trimmed(index), f"key bigint, node bigint, {longs}")
    found = cut(dealt(keys).mapInArrow(trimmed(compare(heavy)), f"u bigint, v bigint, {longs}"))
    links, large = found.filter("f0 IS NULL").select("u", "v"), found.filter("f0 IS NOT NULL").select(F.col("v").alias("key"), F.col("u").alias("node"), *lanes)
    if large.isEmpty():
        return links
    again = dealt(large.mapInArrow(trimmed(index_again), f"key bigint, node bigint, {longs}")).mapInArrow(trimmed(compare(None)), f"u bigint, v bigint, {longs}")
    return links.unionByName(again.select("u", "v"))


def simhash_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS, bits: int = BITS, radius: int = RADIUS) -> DataFrame:
    """Per row: id, fingerprint (hex), component_id (the least id that its links reach, itself included).

    Null and empty texts, and texts of white space, have fingerprint zero, which links like any
    other. Texts shorter than ``n_words`` words are one shingle, texts of any length are read whole. Rows with a
    null id form classes like the rest, and take the component of the rows with an id, or null if there are none.
    Repeated rows have the same result each. Ids may be of any type that has an order. Other columns play no
    part, whatever their names. An empty table gives an empty result.
    """
    lanes = [f"f{k}" for k in range(bits // 64)]
    marked = cut(with_fingerprint(df, id_col, text_col, n_words, bits))
    kind = marked.schema["_id"].dataType.simpleString()
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    # Classes are told apart by their least id, or by a number where ids are none.
    number = F.col("first").cast("bigint") if whole else F.monotonically_increasing_id()
    classes = cut(marked.filter(F.col("_id").isNotNull()).groupBy(*lanes).agg(F.min("_id").alias("first")).select("first", number.alias("node"), *lanes))
    reach = components(links_of(classes.select("node", *lanes), bits, radius))
    found = classes.join(reach, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if whole:
        found = found.select(*lanes, F.col("component").cast(kind).alias("component_id"))
    else:
        least = found.groupBy(F.col("component").alias("_of")).agg(F.min("first").alias("component_id"))
        found = found.join(least, F.col("component") == F.col("_of")).select(*lanes, "component_id")
    shown = F.lower(F.concat(*[F.lpad(F.hex(x), 16, "0") for x in lanes]))
    return marked.join(found, lanes, "left").select(F.col("_id").alias(id_col), shown.alias("fingerprint"), "component_id")


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``ALIKE_WORDS``-word shingles; of all words where there are fewer; none without a word."""
    split = words_of(text).split()
    if not split:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(w, HASH_SEED) for w in split), np.uint64, len(split))
    n = min(ALIKE_WORDS, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out += h[k : len(out) + k] * PLACES[k]
    for m in MIX:
        out ^= out >> np.uint64(33)
        out *= m
    return np.unique(out ^ (out >> np.uint64(33)))


def odd_sketch(h: np.ndarray) -> bytes:
    """For each bit whether an odd number of shingles fall on it; two sets differ in at least as many shingles as their sketches in bits."""
    bits = min(MOST_ODD, max(LEAST_ODD, 1 << (ODD * len(h) - 1).bit_length() if len(h) else 0))
    return np.packbits((np.bincount((h % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def odd_difference(a: bytes, b: bytes) -> int:
    """In how many bits two sketches differ; the longer one is folded to the length of the other."""
    x, y = sorted((np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(_popcount(x ^ y).sum(dtype=np.int64))


def most_apart(sizes: np.ndarray) -> np.ndarray:
    """In how many shingles sets that are alike differ at most, by the sum of their sizes."""
    return sizes * (ALIKE[1] - ALIKE[0]) // (ALIKE[1] + ALIKE[0])


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sets of shingles share ``ALIKE`` of their union or more; two empty sets do."""
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common * ALIKE[1] >= (len(x) + len(y) - common) * ALIKE[0]


def prefix(h: np.ndarray, common: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a set, as many as make every set that is alike hold one of them among its own first.

    ``common`` are shingles in ascending order, which come last and by their ``rank``; the others come
    by hash. Sets that are alike share ``ALIKE`` of either, so each leaves out at most the rest.
    """
    n = len(h) - -(-len(h) * ALIKE[0] // ALIKE[1]) + 1 if len(h) else 0
    late = np.zeros(len(h), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        late = np.where(common[at] == h, rank[at], 0)
    return h[np.argsort(late, kind="stable")[:n]]


def packed(n: int, places: int) -> np.ndarray:
    """A set's size and a place in it, for its first ``places`` places."""
    return n << 32 | np.arange(places)


def _near_in_size(held: np.ndarray, i: int) -> np.ndarray:
    """Which sets are large and small enough to be alike to set ``i``."""
    n = held >> 32
    return np.minimum(n, n[i]) * ALIKE[1] >= np.maximum(n, n[i]) * ALIKE[0]


def _may(held: np.ndarray, i: int) -> np.ndarray:
    """Which sets may be alike to set ``i``, if none of its shingles before its place in the bucket is in theirs.

    They are near in size, and what stands from the bucket's shingle on is as much as they have to share.
    A pair that shares an earlier shingle is looked at in that one's bucket.
    """
    n, rest = held >> 32, (held >> 32) - (held & 0xFFFFFFFF)
    return _near_in_size(held, i) & (np.minimum(rest, rest[i]) * (ALIKE[0] + ALIKE[1]) >= (n + n[i]) * ALIKE[0])


def star_pairs(nodes: np.ndarray, held: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Leaders of a bucket, each with others near in size; every row has a leader in each of the orders."""
    for order in LEADERS:
        key, left = nodes.view(np.uint64) * order, np.ones(len(nodes), bool)
        while left.any():
            i = int(np.flatnonzero(left)[key[left].argmin()])
            near = left & _near_in_size(held, i)
            left &= ~near
            near[i] = False
            yield i, np.flatnonzero(near)


def open_pairs(group: np.ndarray, held: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of a bucket with the later ones that may be alike and are not of its group yet."""
    for i in range(len(held) - 1):
        other = _may(held, i) & (group != group[i])
        other[: i + 1] = False
        yield i, np.flatnonzero(other)


class Sketches:
    """The odd sketches of a bucket as a matrix for each length, and each folded once."""

    def __init__(self, odd: list[bytes]) -> None:
        self.length = np.fromiter((len(x) // 8 for x in odd), np.int64, len(odd))
        self.row, self.by = np.zeros(len(odd), np.int64), {}
        for n in np.unique(self.length).tolist():
            mine = np.flatnonzero(self.length == n)
            self.row[mine] = np.arange(len(mine))
            self.by[n] = np.frombuffer(b"".join(odd[k] for k in mine.tolist()), np.uint64).reshape(-1, n)
        self.folded = {n: m[:, : n // 2] ^ m[:, n // 2 :] for n, m in self.by.items() if n > 1}

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """In how many bits the rows ``others`` differ from row ``i`` at least; sets near in size differ in length by a factor of two at most."""
        out, n = np.zeros(len(others), np.int64), int(self.length[i])
        for many, own, matrix in ((n, self.by[n], self.by[n]), (2 * n, self.by[n], self.folded.get(2 * n)), (n // 2, self.folded.get(n), self.by.get(n // 2))):
            at = np.flatnonzero(self.length[others] == many)
            if len(at) and own is not None and matrix is not None:
                out[at] = _popcount(matrix[self.row[others[at]]] ^ own[self.row[i]]).sum(1, dtype=np.int64)
        return out


def sifted_pairs(group: np.ndarray, held: np.ndarray, odd: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """The open pairs of a bucket that their sketches don't rule out."""
    sketches, n = Sketches(odd), held >> 32
    for i, others in open_pairs(group, held):
        yield i, others[sketches.apart(i, others) <= most_apart(n[others] + n[i])]


def _pairs(found: Iterator[tuple[np.ndarray, Iterator[tuple[int, np.ndarray]]]]) -> Iterator[pa.RecordBatch]:
    """Distinct pairs of nodes as batches of u > v; repeats are spared only as far as is remembered."""
    seen: set[tuple[int, int]] = set()
    out: list[tuple[int, int]] = []

    def flushed() -> pa.RecordBatch:
        u, v = zip(*out, strict=True)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for nodes, pairs in found:
        for i, others in pairs:
            a, b = nodes[i], nodes[others]
            for pair in zip(np.maximum(a, b).tolist(), np.minimum(a, b).tolist(), strict=True):
                if pair not in seen:
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(pair)
                    out.append(pair)
            if len(out) >= 10_000:
                yield flushed()
    if out:
        yield flushed()


def without_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int | None = None) -> DataFrame:
    """The rows of ``df`` without near copies: one row of each group of linked texts, that of the smallest id.

    Texts are linked at a similarity of ``ALIKE`` or more over the sets of ``ALIKE_WORDS``-word
    shingles; with ``radius``, texts whose fingerprints differ in that many bits or fewer are linked too, as in
    :func:`simhash_groups`, and a group may hold links of both kinds. Texts of equal sets are one class. Each class is indexed under its first shingles in an
    order of all shingles (see ``prefix``), so that every linked pair shares a bucket; common shingles
    come last in that order, which is read from a sample and changes the size of buckets only. In each
    bucket all are compared with a few leaders, then all pairs that the groups found so far leave open; but for pairs that can't share enough from the bucket's shingle on. Every decision is made on the whole sets, but for pairs that a bound rules out. Null ids count
    as larger than all others; of rows with the id that stays the one with the smallest hash of the whole
    row stays, and of wholly equal rows any one. Null, empty and blank texts are alike. Texts of any
    length count whole. All columns pass through, whatever their names and kinds. An empty table gives
    an empty result. Two sets of shingles that share their 64-bit number stop the query.
    """
    kind = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), row_hash(df).alias("_row"), F.col(f"`{text_col}`").cast("string").alias("_text"))

    def node_of(h: np.ndarray) -> int:
        return int(np.uint64(xxhash.xxh3_64_intdigest(h.tobytes())).view(np.int64))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(node_of(h), int(np.bitwise_xor.reduce(h * PLACES[0])) if len(h) else 0, len(h), odd_sketch(h)) for h in (shingle_set(t.as_py()) for t in batch.column(2))]
            nodes, proof, n, odd = zip(*found, strict=True) if found else ((), (), (), ())
            lane = pa.nulls(batch.num_rows, pa.int64()) if radius is None else pa.array(np.array([fingerprint(t.as_py())[0] for t in batch.column(2)], np.uint64).view(np.int64))
            proof_ = pa.array(np.array(proof, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), proof_, pa.array(n, pa.int64()), pa.array(odd, pa.binary()), lane], ["_id", "_row", "node", "proof", "n", "odd", "f0"])

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.fromiter((odd_difference(a, b) for a, b in zip(batch.column(3).to_pylist(), batch.column(5).to_pylist(), strict=True)), np.int64, batch.num_rows)
            most = most_apart(batch.column(2).to_numpy() + batch.column(4).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(apart <= most))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(2):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(t.as_py()).view(np.int64))], ["key"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingle_set(t.as_py()).tobytes() for t in part.column(1)], pa.binary())], ["node", "held"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sure = [alike(np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(sure, pa.bool_()))

    sample = rows.filter(F.pmod(F.xxhash64("_id", "_row"), F.lit(SAMPLED)) == 0).mapInArrow(trimmed(hashes), "key bigint")
    often = sample.groupBy("key").count().filter(F.col("count") >= COMMON).orderBy(F.desc("count"), "key").limit(MOST_COMMON).collect()
    common, rank = np.array([r["key"] for r in often], np.int64).view(np.uint64), np.array([r["count"] for r in often], np.int64)
    common, rank = common[np.argsort(common)], rank[np.argsort(common)]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                held = [shingle_set(t.as_py()) for t in batch.column(2).slice(at, 256)]
                keys = [prefix(h, common, rank) for h in held]
                many = [len(k) for k in keys]
                nodes, sizes = np.repeat([node_of(h) for h in held], many), np.concatenate([packed(len(h), k) for h, k in zip(held, many, strict=True)])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64())], ["key", "node", "n"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Buckets of the same classes are one: that of their first common shingle, whose places are the least.
        seen: dict[bytes, int] = {}
        for key, ids, n, _ in _buckets(batches):
            new = np.concatenate([[True], (np.diff(key) != 0) | (np.diff(ids) != 0)])  # copies of a class are next to each other
            key, ids, n = key[new], ids[new], n[new, 0].view(np.int64)
            edges = np.flatnonzero(np.diff(key)) + 1
            starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(key)]])
            out = []
            for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
                mark = xxhash.xxh3_128_digest(ids[a:b].tobytes())
                if int(n[a]) < seen.get(mark, 1 << 62):
                    if len(seen) < 100_000:
                        seen[mark] = int(n[a])
                    out.append((ids[a:b], n[a:b]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.list_(pa.int64())), pa.array([x for _, x in out], pa.list_(pa.int64()))], ["nodes", "sizes"])

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = ((x.values.to_numpy(), y.values.to_numpy()) for b in batches for x, y in zip(b.column(0), b.column(1), strict=True))
        return _pairs((x, star_pairs(x, y)) for x, y in lists)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = ((*(x.values.field(k).to_numpy() for k in range(3)), x.values.field(3).to_pylist()) for b in batches for x in b.column(0))
        return _pairs((nodes, sifted_pairs(group, n, odd)) for group, nodes, n, odd in lists)

    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    marks = cut(rows.mapInArrow(trimmed(mark), f"_id {kind}, _row bigint, node bigint, proof bigint, n bigint, odd binary, f0 bigint"))
    one = F.when((F.min("proof") == F.max("proof")) & (F.min("n") == F.max("n")), F.first("n")).otherwise(F.raise_error(F.lit("two sets of shingles share their number")).cast("bigint"))
    classes = cut(marks.groupBy("node").agg(F.min(order).alias("first"), one.alias("n"), F.first("odd").alias("odd")))
    dealt = rows.mapInArrow(trimmed(index), "key bigint, node bigint, n bigint").repartition("key").sortWithinPartitions("key", "node")
    buckets = cut(dealt.mapInArrow(trimmed(gather), "nodes array<bigint>, sizes array<bigint>").groupBy("nodes").agg(F.min("sizes").alias("sizes")))

    def linked(pairs: DataFrame) -> DataFrame:
        brief = classes.select("node", "n", "odd")
        near = cut(pairs.join(brief.toDF("u", "na", "a"), "u").join(brief.toDF("v", "nb", "b"), "v").select("u", "v", "na", "a", "nb", "b").mapInArrow(trimmed(sift), "u bigint, v bigint"))
        # The whole sets, from one row of each class.
        wanted = kept_as_table(near.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(classes, "node").select("node", F.col("first.id").alias("_id"), F.col("first.row").alias("_row")))
        few = F.broadcast(wanted) if wanted.count() <= MOST_BROADCAST else wanted
        mine = rows.join(few, rows["_id"].eqNullSafe(wanted["_id"]) & (rows["_row"] == wanted["_row"])).select("node", "_text")
        held = cut(mine.mapInArrow(trimmed(whole), "node bigint, held binary").dropDuplicates(["node"]))
        drop_table(wanted)
        both = near.join(held.toDF("u", "a"), "u").join(held.toDF("v", "b"), "v").select("u", "v", "a", "b")
        return cut(both.mapInArrow(trimmed(compare), "u bigint, v bigint"))

    # Buckets of two are settled by the first round; of the others those that hold several groups are open.
    several = buckets.filter(F.size("nodes") > 2).select(F.xxhash64("nodes").alias("bucket"), F.explode(F.arrays_zip("nodes", "sizes")).alias("x")).select("bucket", F.col("x.nodes").alias("node"), F.col("x.sizes").alias("n"))

    tried = cut(buckets.mapInArrow(trimmed(stars), "u bigint, v bigint").distinct())
    links = linked(tried)
    of = several.join(components(links), "node", "left").groupBy("bucket").agg(F.collect_list(F.struct(F.coalesce("component", "node").alias("group"), "node", "n")).alias("x"))
    of = of.filter(F.size(F.array_distinct("x.group")) > 1).select("bucket", F.explode("x").alias("y")).select("bucket", "y.*")
    # Their sketches go with them, so that only pairs leave a bucket that may be links.
    of = of.join(classes.select("node", "odd"), "node").groupBy("bucket").agg(F.collect_list(F.struct("group", "node", "n", "odd")).alias("x"))
    left = of.select("x").mapInArrow(trimmed(rest), "u bigint, v bigint").distinct().join(tried, ["u", "v"], "left_anti")
    links = links.unionByName(linked(left))
    if radius is not None:
        # A fingerprint is held by the least of its classes, to which the others are linked.
        held = cut(marks.select("node", "f0").distinct())
        least = cut(held.groupBy("f0").agg(F.min("node").alias("least")))
        same = dealt_join(held, least, "f0").filter("node <> least").select(F.col("node").alias("u"), F.col("least").alias("v"))
        near = links_of(least.select(F.col("least").alias("node"), "f0"), BITS, radius).filter("u <> v")
        links = links.unionByName(same).unionByName(near)
    reach = components(links)
    group = F.coalesce("component", "node").alias("group")
    stays = classes.join(reach, "node", "left").groupBy(group).agg(F.min("first").alias("kept"))
    kept = classes.select("node").join(reach, "node", "left").select("node", group).join(stays, "group").select("node", "kept")
    # Of the rows only those that go, or that are there several times, are joined to the table again.
    out = dealt_join(marks.groupBy("node", "_id", "_row").agg(F.count(F.lit(1)).alias("copies")), kept, "node")
    times = (F.col("_id").eqNullSafe(F.col("kept.id")) & (F.col("_row") == F.col("kept.row"))).cast("int")
    return as_often(df, id_col, out.withColumn("times", times).filter("times <> copies").select("_id", "_row", "times"))


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir))


QUERIES = {"op5_simhash": op5_simhash}
SQL: dict[str, str] = {}
