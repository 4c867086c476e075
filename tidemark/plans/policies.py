"""Queries on policies: brakes on changes, levels with hysteresis, tiers of sources, risks and decisions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.operators import corroboration, hysteresis, policy, quarantine, tiers
from tidemark.plans.base import ORDERS_SQL, editions, query, table

DAY = 86_400_000_000
#: The events span a month, so windows are shorter here than the fixed ones.
BRAKES = quarantine.Brakes(window=5 * DAY, rest=DAY // 24, reverts=2)
BRAKED = ("user_id", "event_type", "ts", "kind", "said", "event_id")
WAVER, STABLE = 5 * DAY, 2 * DAY
TIER_DAYS = {"T1": {"R0": 9, "R1": 9, "R2": 3, "R3": 1.4}, "T2": {"R0": 12, "R1": 12, "R2": 4.5}, "T3": {"R0": 18, "R1": 18, "R2": 6}}


def changes_of(events):
    """Events as changes of a user's fields; small values clear."""
    value = F.floor("value").cast("bigint")
    return events.select("user_id", "event_type", "ts", F.when(value < 1, "clear").otherwise("apply").alias("kind"), (value % 3).cast("string").alias("said"), "event_id")


@query()
def change_brakes(spark, sf_dir):
    """Each change applied, held or closed by the changes of its record before it (see test_quarantine for the same by plain rules, and as a stream)."""
    return quarantine.decided(changes_of(table(spark, sf_dir, "events")), *BRAKED, BRAKES).select("user_id", "event_id", "event_type", "decision")


LEVELS_SQL = """e AS (SELECT user_id, event_id, ts, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 END AS seen,
              row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
    r AS (SELECT user_id, n, event_id, ts, seen, coalesce(seen, -1) AS lvl, -1 AS low FROM e WHERE n = 1
          UNION ALL
          SELECT e.user_id, e.n, e.event_id, e.ts, e.seen,
                 CASE WHEN e.seen IS NULL THEN r.lvl WHEN e.seen >= r.lvl THEN e.seen WHEN r.low < 0 THEN r.lvl ELSE greatest(r.low, e.seen) END,
                 CASE WHEN e.seen IS NULL THEN r.low WHEN e.seen >= r.lvl THEN -1 WHEN r.low < 0 THEN e.seen ELSE -1 END
          FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1),
    l AS (SELECT user_id, event_id, ts, seen, CASE WHEN lvl >= 0 THEN lvl END AS level FROM r)"""


def _levels(spark, sf_dir):
    kinds = F.array(*map(F.lit, ("view", "click", "purchase", "signup")))
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), (F.array_position(kinds, F.col("event_type")) - 1).cast("int").alias("seen"))
    return hysteresis.levels_after(events, "user_id", "ts", "event_id", "seen", 4)


@query(f"WITH RECURSIVE {LEVELS_SQL} SELECT user_id, event_id, CAST(seen AS INTEGER) AS seen, CAST(level AS INTEGER) AS level FROM l")
def record_levels(spark, sf_dir):
    """A user's level over the events: up at once, down when confirmed."""
    return _levels(spark, sf_dir).select("user_id", "event_id", "seen", "level")


@query(
    f"""
    WITH RECURSIVE {LEVELS_SQL}, b AS (SELECT *, lag(level) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM l),
    c AS (SELECT *, coalesce(level <> before, FALSE) AS change FROM b),
    d AS (SELECT *, count(CASE WHEN change THEN 1 END) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 5 DAY PRECEDING AND CURRENT ROW) AS near,
                 last_value(CASE WHEN change THEN ts END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last,
                 last_value(CASE WHEN change THEN ts END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since FROM c),
    f AS (SELECT *, sum(CASE WHEN change AND (last IS NULL OR ts - last >= INTERVAL 2 DAY) THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM d),
    g AS (SELECT *, coalesce(bool_or(change AND near >= 3) OVER w AND ts - since < INTERVAL 2 DAY, FALSE) AS frozen FROM f WINDOW w AS (PARTITION BY user_id, run ORDER BY ts, event_id))
    SELECT user_id, event_id, CAST(level AS INTEGER) AS level, frozen,
           CAST(CASE WHEN frozen THEN min(CASE WHEN frozen THEN CASE WHEN change THEN least(level, before) ELSE level END END) OVER (PARTITION BY user_id, run ORDER BY ts, event_id) ELSE level END AS INTEGER) AS shown FROM g
    """
)
def shown_levels(spark, sf_dir):
    """The level that is shown: the lowest while a record wavers."""
    return hysteresis.shown_levels(_levels(spark, sf_dir), "user_id", "ts", "event_id", 3, WAVER, STABLE).select("user_id", "event_id", "level", "frozen", "shown")


@query(
    f"""
    WITH b(tier, risk, seconds) AS (VALUES {", ".join(f"('{t}', '{r}', {int(d * 86400)})" for t, by in ({"T0": dict.fromkeys(("R0", "R1", "R2", "R3"), 1)} | TIER_DAYS).items() for r, d in by.items())}),
    e AS (SELECT *, DATE '2026-01-01' + CAST(floor(value) % 3 AS INTEGER) AS day, CASE event_type WHEN 'view' THEN 'T0' WHEN 'click' THEN 'T1' WHEN 'signup' THEN 'T2' WHEN 'error' THEN 'T3' END AS tier FROM events),
    o AS (SELECT user_id, tier, ts, arg_max(day, event_id) AS day FROM e WHERE tier IS NOT NULL GROUP BY ALL),
    q AS (SELECT event_id, user_id, ts, risk, b.tier, seconds FROM (SELECT *, 'R' || event_id % 4 AS risk FROM events WHERE event_type = 'purchase') p LEFT JOIN b USING (risk)),
    a AS (SELECT q.event_id, q.risk, q.tier, o.day, o.ts AS since, (epoch_us(q.ts) - epoch_us(o.ts)) / 1000000 AS age FROM q ASOF JOIN o ON q.user_id = o.user_id AND q.tier = o.tier AND q.ts >= o.ts WHERE epoch_us(q.ts) - epoch_us(o.ts) <= CAST(seconds AS BIGINT) * 1000000),
    w AS (SELECT event_id, min(tier) AS tier, arg_min(day, tier) AS day, arg_min(since, tier) AS since, arg_min(age, tier) AS age, count(*) AS n FROM a GROUP BY event_id),
    d AS (SELECT w.event_id, count(CASE WHEN a.day <> w.day THEN 1 END) AS n, coalesce(bool_or(a.day <> w.day AND a.since > w.since AND a.day > w.day), FALSE) AS later FROM w JOIN a USING (event_id) GROUP BY 1)
    SELECT p.event_id, w.tier, w.day, CAST(w.age AS DOUBLE) AS age, CAST(coalesce(w.n, 0) AS INTEGER) AS n_sources, CAST(coalesce(d.n, 0) AS INTEGER) AS n_differ,
           CASE WHEN w.tier IS NULL THEN 'none' WHEN later OR (p.event_id % 4 = 3 AND d.n > 0) THEN 'hold' ELSE 'use' END AS decision
    FROM (SELECT event_id FROM events WHERE event_type = 'purchase') p LEFT JOIN w USING (event_id) LEFT JOIN d USING (event_id)
    """
)
def source_tiers(spark, sf_dir):
    """The source that speaks for each claim, of tiers with bounds on their age."""
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    tier = F.when(F.col("event_type") == "view", "T0").when(F.col("event_type") == "click", "T1").when(F.col("event_type") == "signup", "T2").when(F.col("event_type") == "error", "T3")
    seen = e.select("user_id", "event_id", "ts", tier.alias("tier"), F.date_add(F.lit("2026-01-01").cast("date"), (F.floor("value") % 3).cast("int")).alias("day"))
    claims = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", F.concat(F.lit("R"), F.col("event_id") % 4).alias("risk"))
    out = tiers.tiered(claims, seen, tiers.staleness(spark, TIER_DAYS), "user_id", "ts", "risk", "tier", "day", "event_id")
    return out.select("event_id", "tier", F.col("value").alias("day"), "age", "n_sources", "n_differ", "decision")


#: The day that the decisions are made on.
DECIDED = date(1995, 6, 1)
PROPOSED_SQL = f"""{ORDERS_SQL},
    p AS (SELECT k, CASE place WHEN '2-HIGH' THEN 'UNCONFIRMED' WHEN '3-MEDIUM' THEN 'UNREACHABLE' WHEN '4-NOT SPECIFIED' THEN 'REJECTED_SOURCE' ELSE 'VERIFIED' END AS gate,
                 CASE status WHEN 'F' THEN 'CONFIRMED' WHEN 'O' THEN 'UNSURE' ELSE 'REFUTED' END AS refuter, CASE WHEN cust % 5 > 0 THEN day END AS before,
                 CASE WHEN cust % 11 > 0 THEN day + CAST((k % 9 - 4) * 10 AS INTEGER) END AS after, link = '3' AS token, CASE WHEN cust % 2 = 0 THEN 'agrees' ELSE 'differs' END AS blind, CASE WHEN cust % 3 = 0 THEN 'grounded' ELSE 'none' END AS quote FROM o),
    q AS (SELECT *, CASE WHEN after IS NULL THEN 'R4' WHEN date_diff('day', DATE '{DECIDED}', least(before, after)) <= 45 THEN 'R3' WHEN before IS NULL THEN 'R0' WHEN before <> after THEN 'R2' ELSE 'R1' END AS tier,
                 CASE WHEN NOT coalesce(after > before OR (before IS NOT NULL AND after IS NULL), FALSE) THEN 'safe' WHEN token AND date_diff('day', before, after) <= 30 THEN 'extension' ELSE 'risk' END AS direction FROM p)"""


def _proposed(spark, sf_dir):
    o = editions(spark, sf_dir)
    before = F.when(F.col("cust") % 5 > 0, F.col("day"))
    after = F.when(F.col("cust") % 11 > 0, F.date_add("day", ((F.col("k") % 9 - 4) * 10).cast("int")))
    gate = F.when(F.col("place") == "2-HIGH", "UNCONFIRMED").when(F.col("place") == "3-MEDIUM", "UNREACHABLE").when(F.col("place") == "4-NOT SPECIFIED", "REJECTED_SOURCE").otherwise("VERIFIED")
    refuter = F.when(F.col("status") == "F", "CONFIRMED").when(F.col("status") == "O", "UNSURE").otherwise("REFUTED")
    left = F.datediff(F.least(before, after), F.lit(DECIDED))
    return o.select(
        "k", gate.alias("gate"), refuter.alias("refuter"), policy.risk_tier(before, after, before != after, after.isNull(), left).alias("tier"), policy.direction(before, after, F.col("link") == "3").alias("direction"),
        F.when(F.col("cust") % 2 == 0, "agrees").otherwise("differs").alias("blind"), F.when(F.col("cust") % 3 == 0, "grounded").otherwise("none").alias("quote"),
    )


@query(
    f"""
    WITH {PROPOSED_SQL} SELECT k, tier, direction,
        CASE WHEN gate = 'REJECTED_SOURCE' THEN 'DISCARD' WHEN gate = 'UNREACHABLE' THEN CASE WHEN refuter = 'REFUTED' THEN 'DISCARD' ELSE 'HOLD' END
             WHEN gate = 'UNCONFIRMED' THEN CASE WHEN refuter = 'REFUTED' THEN 'DISCARD' WHEN refuter = 'CONFIRMED' AND tier IN ('R0', 'R1') AND direction = 'safe' AND quote = 'grounded' THEN 'APPLY' ELSE 'HOLD' END
             WHEN refuter = 'CONFIRMED' AND direction = 'extension' AND blind = 'agrees' THEN 'APPLY'
             WHEN refuter = 'CONFIRMED' AND direction = 'safe' AND (tier IN ('R0', 'R1', 'R2') OR (tier = 'R3' AND blind = 'agrees')) THEN 'APPLY'
             WHEN refuter = 'UNSURE' AND direction = 'safe' AND tier IN ('R0', 'R1') THEN 'APPLY' ELSE 'HOLD' END AS decision FROM q
    """
)
def decision_matrix(spark, sf_dir):
    """What happens to each proposal, by rules in a table."""
    return policy.decide(_proposed(spark, sf_dir), policy.rules_table(spark)).select("k", "tier", "direction", "decision")


@query(
    f"""
    WITH {ORDERS_SQL}, b AS (SELECT cust, c_mktsegment AS segment, count(*) AS n, count(CASE WHEN status = 'P' THEN 1 END) AS a FROM o JOIN customer ON c_custkey = cust GROUP BY ALL),
    g AS (SELECT segment, avg(a / n) AS p, coalesce(var_samp(a / n), 0) AS v, avg(n) AS m FROM b GROUP BY segment),
    r AS (SELECT segment, p, least(0.999, greatest(0.001, CASE WHEN p * (1 - p) <= 0 THEN 0 WHEN m <= 1 THEN 0.5 ELSE (m * v / (p * (1 - p)) - 1) / (m - 1) END)) AS rho FROM g)
    SELECT cust, n, a, round((a + p * (1 - rho) / rho) / (n + (1 - rho) / rho), 9) AS rate, CASE WHEN n >= 3 AND a = 0 THEN 'SUPPORTS' WHEN 2 * a >= n THEN 'OPPOSES' ELSE 'NEUTRAL' END AS prior FROM b JOIN r USING (segment)
    """
)
def deletion_prior(spark, sf_dir):
    """How often a venue has had a field, drawn to its group where there is little history."""
    o = editions(spark, sf_dir).join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust"), F.col("c_mktsegment").alias("segment")), "cust")
    out = policy.shrunk_rates(o.withColumn("has", F.col("status") == "P"), "cust", "segment", "has")
    return out.select("cust", "n", "a", F.round("rate", 9).alias("rate"), "prior")


#: Line items as statements of sources on orders. Two more sources state what the first and the fourth do, a day later; the first and the third share a domain.
STATED_SQL = """t AS (SELECT 's' || l_suppkey % 9 AS source, l_orderkey AS k, l_partkey || l_returnflag AS text, CAST(l_shipdate AS DATE) AS since, CAST(l_linenumber % 3 AS INTEGER) AS said FROM lineitem),
    s AS (SELECT * FROM t UNION ALL SELECT 'm' || source[2], k, text, since + 1, said FROM t WHERE source IN ('s0', 's3')),
    w AS (SELECT DISTINCT source, CASE source WHEN 's0' THEN 'T0' WHEN 's1' THEN 'T1' WHEN 's2' THEN 'T2' WHEN 's3' THEN 'T2' WHEN 'm0' THEN 'T3' WHEN 'm3' THEN 'T2' ELSE 'T4' END AS tier, CASE WHEN source IN ('s0', 's2') THEN 'one.example' END AS domain FROM s),
    u AS (SELECT source, k, text, min(since) AS since FROM s GROUP BY ALL),
    o AS (SELECT u.source, f.source AS original, count(*) AS n, sum(count(*)) OVER (PARTITION BY u.source) AS total FROM u JOIN (SELECT k, text, arg_min(source, (since, source)) AS source FROM u GROUP BY k, text) f USING (k, text) GROUP BY u.source, f.source),
    e AS (SELECT source AS a, original AS b FROM o WHERE source <> original AND total >= 3 AND n >= 0.9 * total UNION SELECT x.source, y.source FROM w x JOIN w y USING (domain)),
    reach AS (SELECT source AS a, source AS b FROM w UNION SELECT r.a, x.b FROM reach r JOIN (SELECT a, b FROM e UNION SELECT b, a FROM e) x ON x.a = r.b),
    g AS (SELECT a AS source, min(b) AS grp FROM reach GROUP BY a)"""


def _stated(spark, sf_dir):
    t = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey") % 9).alias("source"), F.col("l_orderkey").alias("k"), F.concat(F.col("l_partkey").cast("string"), "l_returnflag").alias("text"), F.to_date("l_shipdate").alias("at"), (F.col("l_linenumber") % 3).cast("int").alias("said"),
    )
    mirror = t.filter(F.col("source").isin("s0", "s3")).select(F.concat(F.lit("m"), F.substring("source", 2, 1)).alias("source"), "k", "text", F.date_add("at", 1).alias("at"), "said")
    s = t.unionByName(mirror)
    tier = F.coalesce(*[F.when(F.col("source").isin(*names), n) for n, names in (("T0", ["s0"]), ("T1", ["s1"]), ("T2", ["s2", "s3", "m3"]), ("T3", ["m0"]))], F.lit("T4"))
    who = s.select("source").distinct().select("source", tier.alias("tier"), F.when(F.col("source").isin("s0", "s2"), "one.example").alias("domain"))
    return s, who, corroboration.independent(who, corroboration.copied_from(s, "source", "k", "text", "at"), "source", "domain")


@query(f"WITH RECURSIVE {STATED_SQL} SELECT source, grp AS \"group\" FROM g")
def independent_sources(spark, sf_dir):
    """Sources that mirror each other or share a domain, as groups."""
    return _stated(spark, sf_dir)[2]


@query(
    f"""
    WITH RECURSIVE {STATED_SQL}, r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS said FROM orders),
    j AS (SELECT r.k, r.said, g.grp, w.tier, coalesce(x.said = r.said, FALSE) AS same, x.said IS NOT NULL AND r.said IS NOT NULL AND x.said <> r.said AS other FROM r LEFT JOIN (SELECT DISTINCT source, k, said FROM s) x USING (k) LEFT JOIN w USING (source) LEFT JOIN g USING (source)),
    c AS (SELECT k, said, count(DISTINCT CASE WHEN same AND tier < 'T4' THEN grp END) AS n, count(DISTINCT CASE WHEN other AND tier < 'T4' THEN grp END) AS against,
                 bool_or(same AND tier < 'T2') AS off, bool_or(same AND tier IN ('T2', 'T3')) AS sec, bool_or(same AND tier = 'T4') AS trk FROM j GROUP BY ALL)
    SELECT k, n AS n_groups, against AS n_against,
           CASE WHEN said IS NULL THEN 'NOT_APPLICABLE' WHEN off THEN 'VERIFIED_OFFICIAL' WHEN against > 0 THEN 'CONTRADICTED' WHEN sec THEN 'CORROBORATED_SECONDARY' WHEN trk THEN 'TRACKER_ONLY' ELSE 'NO_SOURCE' END AS state FROM c
    """
)
def corroboration_states(spark, sf_dir):
    """How well each order's value is corroborated, mirrors counted once."""
    s, who, groups = _stated(spark, sf_dir)
    r = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 7 > 0, (F.col("o_orderkey") % 3).cast("int")).alias("said"))
    out = corroboration.corroborated(r, s.select("source", "k", "said"), who, groups, "k", "said", "source", "tier")
    return out.withColumns({c: F.col(c).cast("bigint") for c in ("n_groups", "n_against")})
