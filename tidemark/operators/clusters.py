"""Records into cycle rows, cycle rows into clusters by time gaps, clusters into one row each."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import derived_abstract, instant
from tidemark.functions.text import clean


def expand_cycles(df: DataFrame, paper: str, abstract: str, prefix: str = "cycle") -> DataFrame:
    """One row per review cycle of two parallel arrays: i (from 0), n_cycles, label, paper_raw, abstract_raw.

    There is one row at least. A missing paper entry falls back to the first, a missing abstract
    entry doesn't. The label is empty unless there is more than one paper entry.
    """
    n, papers = F.greatest(F.size(paper), F.size(abstract), F.lit(1)), F.size(paper)
    rows = df.withColumn("i", F.explode(F.sequence(F.lit(0), n - 1)))
    filled = lambda c: F.nullif(c, F.lit(""))
    return rows.select(
        "*",
        papers.alias("n_cycles"),
        F.when(papers > 1, F.concat(F.lit(f"{prefix} "), (F.col("i") + 1).cast("string"))).otherwise("").alias("label"),
        F.coalesce(filled(F.get(paper, F.col("i"))), filled(F.get(paper, F.lit(0)))).alias("paper_raw"),
        filled(F.get(abstract, F.col("i"))).alias("abstract_raw"),
    )


def cycle_of(*texts: Column, own: Column | None = None) -> Column:
    """``cycle n`` as a number or in words; else the row's own cycle, or null."""
    text = F.concat_ws(" ", *texts)
    number = F.regexp_extract(text, r"(?i)\bcycle\s*(\d+)", 1)
    out = F.lit(None).cast("string")
    for i, word in ((3, "third|3rd"), (2, "second|2nd"), (1, "first|1st")):
        out = F.when(text.rlike(rf"(?i)\b({word})\s+cycle\b"), F.lit(f"cycle {i}")).otherwise(out)
    found = F.when(number != "", F.concat(F.lit("cycle "), number)).otherwise(out)
    return found if own is None else F.coalesce(found, own)


#: The venues whose tracks are told apart, and the tracks with the words that tell them, in order.
TRACK_VENUES = ("ICSE", "FSE", "ASE", "ISSTA")
TRACKS = (
    (r"\bseip\b", "SEIP"), (r"\bjf\b|journal[- ]first|journal first", "Journal First"), (r"\bnier\b|new ideas", "NIER"), (r"\bsrc\b|student research", "SRC"), (r"\bdemo(s)?\b|demonstration", "Demo"),
    (r"doctoral|\bdoctoral symposium\b", "Doctoral Symposium"), (r"artifact|artefact", "Artifact"), (r"industry|practice", "Industry"), (r"education|\bseet\b", "Education"), (r"workshop|companion|tutorial|poster", "Companion"),
)


def track_of(text: Column, rules: tuple[tuple[str, str], ...] = TRACKS, venue: Column | None = None, venues: tuple[str, ...] = TRACK_VENUES) -> Column:
    """The label of the first pattern that the lower-case text matches, or empty; with ``venue``, for ``venues`` alone."""
    out = F.lit("")
    for pattern, label in reversed(rules):
        out = F.when(F.lower(text).rlike(pattern), F.lit(label)).otherwise(out)
    return out if venue is None else F.when(venue.isin(*venues), out).otherwise("")


def display_rows(df: DataFrame, paper: str, abstract: str, year: str, zone: str, note: str, as_of: date, prefix: str = "cycle") -> DataFrame:
    """``expand_cycles`` for the board: years of the window only, and the cycle's instants in UTC.

    Adds paper_at, abstract_at (seven days before the paper where there is none and the note says so),
    abstract_shown and effective_at, the abstract's instant or else the paper's.
    """
    kept = df.filter(F.col(year).between(as_of.year - 2, as_of.year + 1))
    rows = expand_cycles(kept, paper, abstract, prefix).withColumn("paper_at", instant(F.col("paper_raw"), F.col(zone)))
    said = instant(F.col("abstract_raw"), F.col(zone))
    rows = rows.withColumn("abstract_at", F.coalesce(said, derived_abstract(F.col("paper_at"), F.col(note))))
    shown = F.coalesce("abstract_raw", F.when(F.col("abstract_at").isNotNull(), "derived: paper - 7 days"), F.lit(""))
    return rows.withColumn("abstract_shown", shown).withColumn("effective_at", F.coalesce("abstract_at", "paper_at"))


def dedupe(df: DataFrame, keys: list[str], cycle: str, track: str, abstract: str, paper: str, priority: str, tie: str, describe: list[str], source: list[str], days: int = 14) -> DataFrame:
    """One row per venue, year and part: the rows of a cycle, else of a track, are one; the others are clustered by their gaps.

    ``cycle`` and ``track`` are empty where a row has none. Adds part and cluster to the keys. The gaps are
    those of the rows' effective time, the abstract's or else the paper's.
    """
    part = F.when(F.col(cycle) != "", F.lower(F.col(cycle))).when(F.col(track) != "", F.concat(F.lit("track:"), F.lower(F.col(track)))).otherwise("main")
    rows = df.withColumn("part", part).withColumn("_at", F.least(abstract, paper))
    apart = gap_clusters(rows, [*keys, "part"], "_at", days * 86_400, tie)
    # Both kinds pass the same window; only the rows of no cycle and track use its number.
    apart = apart.withColumn("cluster", F.when(F.col("part") == "main", F.col("cluster")).otherwise(F.lit(1).cast("bigint"))).drop("_at")
    return merge_clusters(apart, [*keys, "part", "cluster"], abstract, paper, priority, tie, describe, days, source)


def in_first_seen_order(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """One row per key: ``first_seen``, the least ordinal, and n; in the order in which the keys come up first."""
    return df.groupBy(*keys).agg(F.min(ordinal).alias("first_seen"), F.count(F.lit(1)).alias("n")).orderBy("first_seen")


def gap_clusters(df: DataFrame, keys: list[str], time: str, seconds: int, tie: str, name: str = "cluster") -> DataFrame:
    """``df`` with a cluster number per key: a new one after a gap of more than ``seconds``.

    Rows without a time come last and are a cluster each. One window over the keys; the input's
    ascending order makes the distance to a cluster the distance to the row before.
    """
    order = Window.partitionBy(*keys).orderBy(F.col(time).asc_nulls_last(), tie)
    gap = F.unix_micros(time) - F.unix_micros(F.lag(time).over(order))
    new = F.when(F.col(time).isNull() | gap.isNull() | (gap > seconds * 1_000_000), 1).otherwise(0)
    return df.withColumn("_new", new).withColumn(name, F.sum("_new").over(order).cast("bigint")).drop("_new")


def first_known(value: str, priority: str, tie: str) -> Column:
    """The value of the best priority that isn't blank, ties to the smaller ``tie``."""
    kept = F.when(clean(F.col(value)) != "", F.struct(priority, tie, value))
    return F.min(kept)[value]


def merge_clusters(df: DataFrame, keys: list[str], abstract: str, paper: str, priority: str, tie: str, describe: list[str], days: int = 14, source: list[str] | None = None) -> DataFrame:
    """One row per key: abstract, paper, effective, n_merged, sources and the described fields.

    ``sources`` is an array of structs, each distinct priority with the ``source`` columns once, by priority.

    Dates are the earliest abstract and the latest paper over all rows, whatever their priority;
    fields are the best priority's first value that isn't blank. Without an abstract, two different
    papers at most ``days`` apart are taken as abstract and paper. Equal dates leave the paper alone,
    and a pair in the wrong order is turned round.
    """
    grouped = df.groupBy(*keys).agg(
        F.min(abstract).alias("_a"), F.max(paper).alias("_p"), F.min(paper).alias("_first"), F.min(F.least(abstract, paper)).alias("_any"),
        F.count(F.lit(1)).alias("n_merged"), F.array_sort(F.collect_set(F.struct(priority, *(source or [])))).alias("sources"),
        *[F.coalesce(first_known(c, priority, tie), F.lit("")).alias(c) for c in describe],
    )
    apart = F.unix_micros("_p") - F.unix_micros("_first")
    inferred = F.col("_a").isNull() & (apart > 0) & (apart <= days * 86_400_000_000)
    a = F.when(inferred, F.col("_first")).otherwise(F.col("_a"))
    pair = grouped.withColumn("_a", a)
    both = F.col("_a").isNotNull() & F.col("_p").isNotNull()
    out = pair.withColumn("abstract", F.when(both & (F.col("_a") == F.col("_p")), F.lit(None)).otherwise(F.when(both, F.least("_a", "_p")).otherwise(F.col("_a"))))
    out = out.withColumn("paper", F.when(both, F.greatest("_a", "_p")).otherwise(F.col("_p")))
    return out.select(*keys, "abstract", "paper", F.coalesce("abstract", "paper", "_any").alias("effective"), "n_merged", "sources", *describe)
