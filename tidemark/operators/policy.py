"""What is done with a proposal: its risk, the direction of its change, and a table of rules that decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Days within which a deadline is near, and those that an extension may move it.
NEAR_DAYS, EXTENSION_DAYS = 45, 30
#: What a rule looks at, in order.
LOOKS = ("gate", "refuter", "tier", "direction", "blind", "quote")
#: The decision matrix; * stands for any value, and of the rules that fit the one with the fewest * decides.
MATRIX = (
    ("VERIFIED", "CONFIRMED", "*", "safe", "*", "*", "APPLY"),
    ("VERIFIED", "CONFIRMED", "R3", "safe", "agrees", "*", "APPLY"),
    ("VERIFIED", "CONFIRMED", "R3", "safe", "*", "*", "HOLD"),
    ("VERIFIED", "CONFIRMED", "*", "extension", "agrees", "*", "APPLY"),
    ("VERIFIED", "CONFIRMED", "*", "*", "*", "*", "HOLD"),
    ("VERIFIED", "CONFIRMED", "R4", "safe", "*", "*", "HOLD"),
    ("VERIFIED", "UNSURE", "R0", "safe", "*", "*", "APPLY"),
    ("VERIFIED", "UNSURE", "R1", "safe", "*", "*", "APPLY"),
    ("VERIFIED", "UNSURE", "*", "*", "*", "*", "HOLD"),
    ("VERIFIED", "REFUTED", "*", "*", "*", "*", "HOLD"),
    ("UNCONFIRMED", "CONFIRMED", "R0", "safe", "*", "grounded", "APPLY"),
    ("UNCONFIRMED", "CONFIRMED", "R1", "safe", "*", "grounded", "APPLY"),
    ("UNCONFIRMED", "CONFIRMED", "*", "*", "*", "*", "HOLD"),
    ("UNCONFIRMED", "UNSURE", "*", "*", "*", "*", "HOLD"),
    ("UNCONFIRMED", "REFUTED", "*", "*", "*", "*", "DISCARD"),
    ("UNREACHABLE", "*", "*", "*", "*", "*", "HOLD"),
    ("UNREACHABLE", "REFUTED", "*", "*", "*", "*", "DISCARD"),
    ("REJECTED_SOURCE", "*", "*", "*", "*", "*", "DISCARD"),
    ("*", "*", "*", "*", "*", "*", "HOLD"),
)


def risk_tier(before: Column, after: Column, changes_deadline: Column, deletes: Column, days_left: Column) -> Column:
    """R4 deletes, R3 is about a deadline that is near, R0 fills one in, R2 changes one that is far, R1 is all else.

    ``before`` and ``after`` are the concrete deadline now and as proposed, null where there is none; ``days_left`` are the days
    until the nearer of the two.
    """
    near = F.coalesce(days_left <= NEAR_DAYS, F.lit(False))
    fills = before.isNull() & after.isNotNull()
    return F.when(deletes, "R4").when(near, "R3").when(fills, "R0").when(changes_deadline, "R2").otherwise("R1")


def direction(before: Column, after: Column, token: Column) -> Column:
    """Where a change moves the instant that counts: ``safe`` if earlier, equal or filled in, else ``risk``; ``extension`` for one of
    few days whose quote says so. Taking an instant away is a risk, as what is shown instead is the latest reading.
    """
    later = F.coalesce((after > before) | (before.isNotNull() & after.isNull()), F.lit(False))
    days = F.timestamp_diff("DAY", before.cast("timestamp"), after.cast("timestamp"))
    short = F.coalesce((days < EXTENSION_DAYS) | (after.cast("timestamp") == before.cast("timestamp") + F.make_dt_interval(F.lit(EXTENSION_DAYS))), F.lit(False))
    return F.when(~later, "safe").when(F.coalesce(token, F.lit(False)) & short, "extension").otherwise("risk")


def rules_table(spark: SparkSession, rules: tuple[tuple[str, ...], ...] = MATRIX) -> DataFrame:
    """Rules as rows: the columns of ``LOOKS``, decision and rule, their number."""
    schema = ", ".join(f"{c} string" for c in (*LOOKS, "decision")) + ", rule int"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rules)], schema)


def decide(rows: DataFrame, rules: DataFrame, looks: tuple[str, ...] = LOOKS, decision: str = "decision", rule: str = "rule") -> DataFrame:
    """``rows`` with ``decision`` and ``rule`` of the most specific rule that fits, ties to the smaller number; null if none does.

    A row is looked up under each pattern of * that the rules use, by an equality join; the patterns are at most two to the
    number of columns. A null value fits * alone.
    """
    wild = [F.col(c) == "*" for c in looks]
    # Which columns a rule leaves open, as bits.
    mask = sum((F.when(w, 1 << i).otherwise(0) for i, w in enumerate(wild)), F.lit(0)).cast("int")
    key = lambda values, bits: F.to_json(F.struct(*[F.when(bits.bitwiseAND(1 << i) != 0, "*").otherwise(v).alias(f"v{i}") for i, v in enumerate(values)]), {"ignoreNullFields": "false"})
    table = rules.withColumn("_mask", mask)
    table = table.groupBy(key([F.col(c) for c in looks], F.col("_mask")).alias("_key"), "_mask").agg(F.min(F.struct(F.col(rule).alias("rule"), F.col(decision).alias("decision"))).alias("_rule"))
    masks = sorted(r[0] for r in table.select("_mask").distinct().collect())  # at most 2 ** len(looks)
    if not masks:
        return rows.withColumns({"decision": F.lit(None).cast("string"), "rule": F.lit(None).cast("int")})
    # Rows with the same values are decided once.
    asked = rows.select(*looks).distinct().withColumn("_at", F.explode(F.array(*map(F.lit, masks))))
    asked = asked.select(*looks, key([F.col(c).cast("string") for c in looks], F.col("_at")).alias("_key"), F.col("_at").alias("_mask"))
    found = asked.join(table, ["_key", "_mask"])
    best = found.groupBy(*looks).agg(F.min(F.struct(F.bit_count("_mask").alias("open"), F.col("_rule.rule").alias("rule"), F.col("_rule.decision").alias("decision"))).alias("_best"))
    best = best.select(*[F.col(c).alias(f"_l_{c}") for c in looks], "_best.decision", "_best.rule")
    same = F.lit(True)
    for c in looks:
        same = same & F.col(c).eqNullSafe(F.col(f"_l_{c}"))
    return rows.join(best, same, "left").drop(*[f"_l_{c}" for c in looks])


def shrunk_rates(history: DataFrame, venue: str, group: str, has: str) -> DataFrame:
    """Per venue: n (editions), a (those that have it), ``rate``, its share drawn to that of its group, and ``prior``.

    ``history`` has a row per edition; ``has`` is whether it has the field. A group's venues are taken as draws from a beta
    distribution, fitted by the moments of their shares in one aggregation; a venue of few editions lies near its group's
    mean, one of many near its own share. SUPPORTS a deletion are three editions or more of which none has the field, OPPOSES half of them
    or more that have it. Rows without a venue, or where ``has`` is null, count only for nothing; null groups are one group.
    """
    by = history.filter(F.col(venue).isNotNull()).groupBy(venue, group).agg(F.count(F.col(has)).alias("n"), F.count_if(F.col(has)).alias("a"))
    share = F.when(F.col("n") > 0, F.col("a") / F.col("n"))
    g = by.groupBy(F.col(group).alias("_g")).agg(F.avg(share).alias("_p"), F.coalesce(F.var_samp(share), F.lit(0.0)).alias("_v"), F.avg(F.when(F.col("n") > 0, F.col("n"))).alias("_n"))
    spread = F.col("_p") * (1 - F.col("_p"))
    # How alike a venue's editions are; none alike: all venues have the group's rate, all alike: each has its own.
    rho = F.when(spread <= 0, 0.0).when(F.col("_n") <= 1, 0.5).otherwise((F.col("_n") * F.col("_v") / spread - 1) / (F.col("_n") - 1))
    rho = F.least(F.lit(0.999), F.greatest(F.lit(0.001), rho))
    g = g.select("_g", "_p", ((1 - rho) / rho).alias("_m"))
    rows = by.join(g, F.col(group).eqNullSafe(F.col("_g")))
    prior = F.when((F.col("n") >= 3) & (F.col("a") == 0), "SUPPORTS").when((F.col("n") > 0) & (F.col("a") * 2 >= F.col("n")), "OPPOSES").otherwise("NEUTRAL")
    return rows.select(venue, group, "n", "a", ((F.col("a") + F.col("_p") * F.col("_m")) / (F.col("n") + F.col("_m"))).alias("rate"), prior.alias("prior"))
