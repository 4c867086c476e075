"""How well a record's value is corroborated: by sources that are independent of each other, each group counted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.partitions import in_parts
from tidemark.sources.versions import scratch

#: The share of its statements that a mirror has from another source. Sources of fewer statements are no mirrors.
MIRRORED, LEAST_STATEMENTS = 0.9, 3
#: Statements of a task.
STATEMENTS = 500_000
#: Tiers of official sources, of others that are evidence, and of trackers, which are none.
OFFICIAL, SECONDARY, TRACKER = ("T0", "T1"), ("T2", "T3"), ("T4",)


def connected(links: DataFrame) -> DataFrame:
    """Per node of ``links`` (u, v) the least node that it is linked to over any number of links: node, group.

    Larger neighbours are linked to the least of a neighbourhood, and then smaller ones, in turn, until all links lead
    to a group's least node; the rounds grow with the logarithm of the longest chain. Lineage is cut by checkpoints. Null ends are
    nothing, and so is a link of a node to itself.
    """
    scratch(links.sparkSession)
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), (F.col("u").isNull() | F.col("v").isNull()).alias("_none"))
    edges, before = edges.filter("NOT _none AND u > v").select("u", "v").distinct().checkpoint(), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.first("u")).alias("_low"))
        large = both.join(low, F.col("u") == F.col("_u")).filter("v > u AND v > _low").select(F.col("v").alias("u"), F.col("_low").alias("v")).distinct()
        least = large.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("_low"))
        ends = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("_low").alias("v")), F.struct(F.col("u").alias("u"), F.col("_low").alias("v"))))
        edges = large.join(least, F.col("u") == F.col("_u")).select(ends.alias("e")).select("e.u", "e.v").filter("u > v").distinct().checkpoint()
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("group")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("group")).distinct())
        before = now


def copied_from(statements: DataFrame, source: str, record: str, text: str, at: str, share: float = MIRRORED, least: int = LEAST_STATEMENTS) -> DataFrame:
    """Mirrors and what they mirror: source, original.

    A text on a record is its first source's (by time, ties to the lesser name). A source of which at least ``share`` of its
    statements are another's is a mirror of it; that is at most one other. Every text has one first source, so statements are
    compared with that alone, never with each other. A statement that is repeated counts once; those without a source,
    a record, a text or a time tell nothing.
    """
    rows = statements.select(F.col(source).alias("source"), F.col(record).alias("record"), F.col(text).alias("text"), F.col(at).alias("at")).dropna()
    rows = in_parts(rows, "record", "text", rows=STATEMENTS).groupBy("record", "text", "source").agg(F.min("at").alias("at"))
    first = F.min(F.struct("at", "source")).over(Window.partitionBy("record", "text"))["source"]
    by = rows.select("source", first.alias("original")).groupBy("source", "original").agg(F.count(F.lit(1)).alias("n"))
    total = by.groupBy(F.col("source").alias("_s")).agg(F.sum("n").alias("total"))
    by = by.join(total, F.col("source") == F.col("_s")).filter((F.col("source") != F.col("original")) & (F.col("total") >= least) & (F.col("n") >= share * F.col("total")))
    return by.select("source", "original")


def independent(sources: DataFrame, mirrors: DataFrame, source: str, domain: str) -> DataFrame:
    """Per source its ``group``: sources that mirror each other, or are of one domain, are one."""
    known = sources.select(F.col(source).alias("source"), F.col(domain).alias("_domain")).filter("source IS NOT NULL")
    least = known.filter("_domain IS NOT NULL").groupBy("_domain").agg(F.min("source").alias("_least"))
    same = known.join(least, "_domain").select(F.col("source").alias("u"), F.col("_least").alias("v"))
    groups = connected(mirrors.select(F.col("source").alias("u"), F.col("original").alias("v")).unionByName(same))
    names = known.select("source").distinct()
    return names.join(groups, F.col("source") == F.col("node"), "left").select(F.col("source").alias(source), F.coalesce("group", "source").alias("group"))


def corroborated(records: DataFrame, statements: DataFrame, sources: DataFrame, groups: DataFrame, key: str, value: str, source: str, tier: str) -> DataFrame:
    """Per record: n_groups (independent groups of sources, trackers apart, that state its value), n_against, and ``state``.

    ``records`` has key and value, null where there is none yet; ``statements`` source, key and value. NOT_APPLICABLE without a value;
    VERIFIED_OFFICIAL if an official source states it; CONTRADICTED if none does and some source that is evidence states another;
    CORROBORATED_SECONDARY, TRACKER_ONLY or NO_SOURCE by the best that states it. A group that states both counts for both.
    """
    who = sources.select(F.col(source).alias("_source"), F.col(tier).alias("_tier")).join(groups.select(F.col(source).alias("_s"), "group"), F.col("_source") == F.col("_s")).select("_source", "_tier", "group")
    said = statements.select(F.col(source).alias("_from"), F.col(key).alias("_key"), F.col(value).alias("_said")).dropna()
    said = in_parts(said, "_key", rows=STATEMENTS).distinct()
    said = said.join(who, F.col("_from") == F.col("_source"))
    rows = records.select(F.col(key).alias("key"), F.col(value).alias("value")).join(said, F.col("key") == F.col("_key"), "left")
    same, evidence = F.col("_said") == F.col("value"), F.col("_tier").isin(*OFFICIAL, *SECONDARY)
    # The groups of a record are told apart before they are counted.
    by = rows.groupBy("key", "value", "group").agg(*[F.coalesce(F.bool_or(c), F.lit(False)).alias(n) for n, c in (("_off", same & F.col("_tier").isin(*OFFICIAL)), ("_sec", same & F.col("_tier").isin(*SECONDARY)), ("_trk", same & F.col("_tier").isin(*TRACKER)), ("_against", ~same & evidence))])
    out = by.groupBy("key", "value").agg(F.count_if(F.col("_off") | F.col("_sec")).alias("n_groups"), F.count_if("_against").alias("n_against"), F.bool_or("_off").alias("_o"), F.bool_or("_sec").alias("_s"), F.bool_or("_trk").alias("_t"))
    state = (
        F.when(F.col("value").isNull(), "NOT_APPLICABLE").when(F.col("_o"), "VERIFIED_OFFICIAL").when(F.col("n_against") > 0, "CONTRADICTED")
        .when(F.col("_s"), "CORROBORATED_SECONDARY").when(F.col("_t"), "TRACKER_ONLY").otherwise("NO_SOURCE")
    )
    none = F.col("value").isNull()
    return out.select(F.col("key").alias(key), F.when(none, 0).otherwise(F.col("n_groups")).alias("n_groups"), F.when(none, 0).otherwise(F.col("n_against")).alias("n_against"), state.alias("state"))
