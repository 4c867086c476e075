r"""Secrets in text: three patterns, and runs of characters whose entropy is too high for prose.

Only DataFrame functions, and no shuffle. A document's matches are found by ``regexp_extract_all``
and placed by the lengths of what ``split`` leaves between them. The entropy part takes candidate
strings of one character class, slides a window over each, keeps the counts of the window's
characters and the sum of c*log2(c) by adding the character that enters and taking away the one
that leaves, and joins the windows at or over the threshold into spans. Candidates on the
allow-list and spans inside a pattern's span are suppressed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import documents, text_or_empty, whole_row

#: Fixed values of the contract: kind, pattern, the group whose length counts, and the least length.
PATTERNS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]+", 0, 16),
)
#: Kind, candidate pattern, alphabet (case matters only if it has both), window, least bits of entropy.
CLASSES = (
    ("entropy_hex", r"(?<![A-Za-z0-9])(?=[a-fA-F]*[0-9])(?=[0-9]*[a-fA-F])[0-9a-fA-F]{24,}(?![A-Za-z0-9])", "0123456789abcdefABCDEF", 24, 3.0),
    ("entropy_base64", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[A-Z0-9+/_-]*[a-z])(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{24,}", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 24, 4.0),
)
#: Candidates that match one of these are no secrets: UUIDs, running alphabets, examples in manuals, paths.
ALLOW = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"(?i)abcdefgh|0123456789|EXAMPLE|xxxxxxxx",
    r"^/?([A-Za-z0-9_-]{1,15}/){3,}",
)
CHUNK = 256
NO_SPANS = "array<struct<start:int,end:int,kind:int>>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; a plain repeated expression would be computed at each place."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(lengths: Column) -> Column:
    """Running sums of an int array, itself included; by chunks, so that long arrays stay cheap."""
    cuts = lambda a: F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(a) - 1) / F.lit(CHUNK)).cast("int"))), lambda c: F.slice(a, c * CHUNK + 1, F.lit(CHUNK)))
    add = lambda x, y: x + y

    def within(a: Column, base: Column) -> Column:
        first = F.struct(base.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(a, first, lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"] + x)).alias("out")), lambda s: s["out"])

    def whole(chunks: Column) -> Column:
        totals = F.transform(chunks, lambda a: F.aggregate(a, F.lit(0), add))
        return _let(totals, lambda t: F.flatten(F.transform(chunks, lambda a, i: within(a, F.aggregate(F.slice(t, F.lit(1), i), F.lit(0), add)))))

    return _let(lengths, lambda a: _let(cuts(a), whole))


def _found(text: Column, pattern: str) -> Column:
    """The matches as structs of start, end and string; offsets count code points."""

    def placed(hits: Column) -> Column:
        steps = F.zip_with(F.split(text, pattern, -1), hits, lambda g, h: F.length(g) + F.coalesce(F.length(h), F.lit(0)))
        return F.zip_with(F.slice(_running(steps), F.lit(1), F.size(hits)), hits, lambda e, h: F.struct((e - F.length(h)).alias("start"), e.alias("end"), h.alias("hit")))

    return _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def pattern_spans(text: Column, kind: int) -> Column:
    """Spans of one pattern: leftmost, non-overlapping, the short ones dropped afterwards."""
    _, pattern, group, least = PATTERNS[kind]
    lone = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}.get(PATTERNS[kind][0])
    if lone:  # a run is one match, so asking for its least length at once drops the same matches
        spans = F.transform(_found(text, lone), lambda m: F.struct(m["start"], m["end"], F.lit(kind).alias("kind")))
        return F.when(text.rlike(lone), spans).otherwise(F.array().cast(NO_SPANS))
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda g: F.length(g))
    spans = F.zip_with(_found(text, pattern), sizes, lambda m, n: F.struct(m["start"], m["end"], F.when(n >= least, F.lit(kind)).otherwise(-1).alias("kind")))
    return F.when(text.rlike(pattern), F.filter(spans, lambda s: s["kind"] >= 0)).otherwise(F.array().cast(NO_SPANS))


def window_spans(hit: Column, alphabet: str, window: int, bits: float) -> Column:
    """Joined windows of ``hit`` with an entropy of ``bits`` or more, as structs of start and end."""
    clog = [0.0, *(c * math.log2(c) for c in range(1, window + 2))]
    table = F.array(*[F.lit(x) for x in clog])
    first = F.struct(
        F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).alias("clog"),
        F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("out"),
    )

    def move(s: Column, x: Column) -> Column:
        """Take in the next character, drop the one that leaves, and extend or open a span."""
        entered, left = F.get(s["counts"], x["new"]), F.get(s["counts"], x["old"])
        grown = F.get(table, entered + 1) - F.get(table, entered)
        changed = F.when(x["old"] < 0, s["clog"] + grown).when(x["old"] == x["new"], s["clog"]).otherwise(s["clog"] + grown + F.get(table, left - 1) - F.get(table, left))
        counts = F.transform(s["counts"], lambda c, j: c + (j == x["new"]).cast("int") - (j == x["old"]).cast("int"))

        def judged(total: Column) -> Column:
            high = (x["i"] >= window - 1) & (total <= window * (math.log2(window) - bits) + 1e-9)
            opens = high & (x["i"] - (window - 1) > s["end"])
            return F.struct(
                counts.alias("counts"), total.alias("clog"), F.when(opens, x["i"] - (window - 1)).otherwise(s["start"]).alias("start"),
                F.when(high, x["i"] + 1).otherwise(s["end"]).alias("end"),
                F.when(opens & (s["start"] >= 0), F.concat(s["out"], F.array(F.struct(s["start"], s["end"])))).otherwise(s["out"]).alias("out"),
            )

        return _let(changed, judged)

    def slid(codes: Column) -> Column:
        steps = F.transform(codes, lambda c, i: F.struct(c.alias("new"), F.when(i >= window, F.get(codes, i - window)).otherwise(-1).alias("old"), i.alias("i")))
        done = lambda s: F.when(s["start"] >= 0, F.concat(s["out"], F.array(F.struct(s["start"], s["end"])))).otherwise(s["out"])
        return F.aggregate(steps, first, move, done)

    return _let(F.transform(F.split(hit, ""), lambda c: F.instr(F.lit(alphabet), c) - 1), slid)


def entropy_spans(text: Column, k: int) -> Column:
    """Spans of one character class, without the allowed ones."""
    _, pattern, alphabet, window, bits = CLASSES[k]
    allowed = lambda h: h.rlike("|".join(f"(?:{p})" for p in ALLOW))
    found = F.filter(_found(text, pattern), lambda m: ~allowed(m["hit"]))
    spans = F.flatten(
        F.transform(found, lambda m: F.transform(window_spans(m["hit"], alphabet, window, bits), lambda s: F.struct((m["start"] + s["start"]).alias("start"), (m["start"] + s["end"]).alias("end"), F.lit(len(PATTERNS) + k).alias("kind"))))
    )
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(NO_SPANS))


def secret_spans(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with ``secret_base`` and ``secret_added``: arrays of start, end (code points, end exclusive) and kind.

    Kinds are numbered as in ``PATTERNS`` and then ``CLASSES``. Base spans are kept whole; an added
    span inside a base span, or inside an added span of an earlier class, is left out. Null and
    empty texts have no spans; texts of any length count whole. Other columns pass through, whatever
    their names and kinds; only columns of those two names give way. An empty table gives an empty result.
    """
    text = F.col("_text")
    out = df.select(whole_row(df).alias("_all"), text_or_empty(text_col).alias("_text"))
    ordered = lambda a: F.array_sort(F.transform(a, lambda s: F.struct(s["start"], s["kind"], s["end"])))
    base = ordered(F.concat(*[pattern_spans(text, k) for k in range(len(PATTERNS))]))
    added = ordered(F.concat(*[entropy_spans(text, k) for k in range(len(CLASSES))]))
    inside = lambda s, b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])
    new = lambda b, a: F.filter(a, lambda s: ~F.exists(b, lambda x: inside(s, x)) & ~F.exists(a, lambda x: (x["kind"] < s["kind"]) & inside(s, x)))
    both = _let(base, lambda b: _let(added, lambda a: F.struct(b.alias("base"), new(b, a).alias("added"))))
    kept = [c for c in df.columns if c not in ("secret_base", "secret_added")]
    out = out.select("_all", both.alias("_both"))
    return out.select(*[F.col(f"_all.`{c}`") for c in kept], F.col("_both.base").alias("secret_base"), F.col("_both.added").alias("secret_added"))


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k[0]) for k in (*PATTERNS, *CLASSES)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_assign, n_access, n_hex, base_sha256, spans, n_added.

    Null and empty texts have no spans and the digest of the empty string. One row comes out per row,
    null and repeated ids included; other columns play no part. An empty table gives an empty result.
    """
    found = secret_spans(df.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_in")), "_in")
    count = lambda k: F.size(F.filter("secret_base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{PATTERNS[k][0]}")
    counts = [count(k) for k in range(len(PATTERNS))]
    every = F.array_sort(F.concat("secret_base", "secret_added"))
    return found.select(F.col("_id").alias(id_col), *counts, F.sha2(_joined(F.col("secret_base")), 256).alias("base_sha256"), _joined(every).alias("spans"), F.size("secret_added").cast("bigint").alias("n_added"))


def op3_secrets(spark, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir))


QUERIES = {"op3_secrets": op3_secrets}
SQL: dict[str, str] = {}
