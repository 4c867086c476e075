"""Which source speaks for a record at a time: tiers of sources, how old each may be, and what to do where they differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Days that an observation of a tier may be old, by the risk of what it is used for; none is refused.
STALENESS = {"T1": {"R0": 90, "R1": 90, "R2": 30, "R3": 14}, "T2": {"R0": 120, "R1": 120, "R2": 45}, "T3": {"R0": 180, "R1": 180, "R2": 60}}
LIVE_DAYS, DAY = 1, 86_400


def staleness(spark: SparkSession, days: dict[str, dict[str, float]] | None = None, live: float = LIVE_DAYS) -> DataFrame:
    """The bounds as a table: tier, risk, seconds. The live tier, T0, has one for all risks."""
    days = {"T0": dict.fromkeys(("R0", "R1", "R2", "R3"), live)} | (STALENESS if days is None else days)
    return spark.createDataFrame([(t, r, int(d * DAY)) for t, by in days.items() for r, d in by.items()], "tier string, risk string, seconds bigint")


def last_within(left: DataFrame, right: DataFrame, keys: list[str], at: str, seconds: int, order: list[str], name: str) -> DataFrame:
    """``left`` with ``name``, the last row of ``right`` (a struct) with its keys, not after it and at most ``seconds`` older; null if none.

    An as-of join by one sort of both sides. Time is cut into stretches of ``seconds``; a row of the right side is dealt to its
    own stretch and the next, so what a row of the left side looks for is in its stretch, and a key of very many
    rows is many windows. ``order`` breaks ties of time on the right side, the greatest last. Rows of either side without a
    key or a time find and are nothing.
    """
    us, width = lambda c: F.unix_micros(F.col(c).cast("timestamp")), max(1, seconds) * 1_000_000
    stretch = F.floor(us(at) / width)
    row = F.struct(*[F.col(f"`{c}`") for c in right.columns])
    said = right.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in [*keys, at]))
    said = said.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], us(at).alias("_us"), F.explode(F.array(stretch, stretch + 1)).alias("_stretch"), F.lit(0).alias("_side"), F.struct(*order).alias("_order"), row.alias("_right"))
    whole = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    asked = left.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], us(at).alias("_us"), stretch.alias("_stretch"), F.lit(1).alias("_side"), whole.alias("_left"))
    both = said.unionByName(asked, allowMissingColumns=True)
    by = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))], "_stretch").orderBy("_us", "_side", "_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.last(F.when(F.col("_side") == 0, F.struct("_us", "_right")), True).over(by)
    out = both.withColumn("_held", held).filter("_side = 1")
    fits = F.col("_us") - F.col("_held._us") <= seconds * 1_000_000
    return out.select("_left.*", F.when(fits, F.col("_held._right")).alias(name))


def tiered(claims: DataFrame, observations: DataFrame, bounds: DataFrame, record: str, at: str, risk: str, tier: str, value: str, tie: str) -> DataFrame:
    """``claims`` with ``tier``, ``value`` and ``age`` (seconds) of the source that speaks, ``n_sources``, ``n_differ`` and ``decision``: use, hold or none.

    Of each tier the last observation of the record counts that is not older than ``bounds`` (tier, risk, seconds) allows;
    the lowest tier speaks. It is held where a newer observation of a weaker tier has a later value, which may be a new
    extension, and for the highest risk in ``bounds`` where any differs. ``tie`` breaks ties of time among observations.
    Claims of an unknown risk or without a record have none; equal claims are one.
    """
    widest, top = bounds.agg(F.max("seconds"), F.max("risk")).first()  # type: ignore[misc]
    # A claim is asked of each tier that its risk admits: a row per tier.
    asked = claims.join(F.broadcast(bounds.select(F.col("tier").alias("_tier"), F.col("risk").alias("_risk"), F.col("seconds").alias("_seconds"))), F.col(risk) == F.col("_risk"), "left").drop("_risk")
    asked = asked.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in claims.columns])).select(F.col(record).alias("_record"), "_tier", F.col(at).alias("_at"), "_seconds", "_row")
    seen = observations.select(F.col(record).alias("_record"), F.col(tier).alias("_tier"), F.col(at).alias("_at"), F.col(value).alias("_value"), F.col(tie).alias("_tie"))
    found = last_within(asked, seen, ["_record", "_tier"], "_at", widest or 1, ["_tie"], "seen")
    age = (F.unix_micros(F.col("_at").cast("timestamp")) - F.unix_micros(F.col("seen._at").cast("timestamp"))) / 1_000_000
    found = found.withColumn("_age", age).withColumn("seen", F.when(F.col("_age") <= F.col("_seconds"), F.struct("_tier", F.col("seen._at").alias("at"), F.col("seen._value").alias("value"), F.col("_age").alias("age"))))
    by = found.groupBy("_row").agg(F.array_sort(F.collect_list("seen")).alias("_seen"))  # one entry per tier
    best = F.get("_seen", F.lit(0))
    differ: Column = F.filter("_seen", lambda s: ~s["value"].eqNullSafe(best["value"]))
    held = F.exists(differ, lambda s: (s["at"] > best["at"]) & (s["value"] > best["value"])) | ((F.col(f"_row.`{risk}`") == top) & (F.size(differ) > 0))
    decision = F.when(best.isNull(), "none").when(F.coalesce(held, F.lit(False)), "hold").otherwise("use")
    return by.select("_row.*", best["_tier"].alias("tier"), best["value"].alias("value"), best["age"].alias("age"), F.size("_seen").alias("n_sources"), F.size(differ).alias("n_differ"), decision.alias("decision"))
