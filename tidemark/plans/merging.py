"""Queries on clusters, merges and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.dates import day_label, days_left, displayed, urgency
from tidemark.operators import clusters, merge, quality, report
from tidemark.plans.base import LAYERS_SQL, ORDERS_SQL, SOURCES_SQL, TODAY, TODAY_SQL, editions, layers, query, sources, table
from tidemark.streaming import sessions

DAY = 86_400


@query(
    """
    WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 86400000000 THEN 1 ELSE 0 END AS fresh
               FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
    c AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS BIGINT) AS cluster FROM g)
    SELECT user_id, event_type, cluster, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS n, arg_min(value, event_id) AS first_value
    FROM c GROUP BY user_id, event_type, cluster
    """
)
def gap_clusters(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("at", F.col("ts").cast("timestamp"))
    rows = clusters.gap_clusters(events, ["user_id", "event_type"], "at", DAY, "event_id")
    return rows.groupBy("user_id", "event_type", "cluster").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n"), F.min_by("value", "event_id").alias("first_value"))


@query(
    """
    WITH g AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR epoch_us(ts) - epoch_us(lag(ts) OVER w) > 86400000000 THEN 1 ELSE 0 END AS fresh
               FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
    c AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS cluster FROM g)
    SELECT user_id, event_type, min(ts) AS first, max(ts) AS last, count(*) AS n FROM c GROUP BY user_id, event_type, cluster
    """
)
def gap_sessions(spark, sf_dir):
    """Gap clusters as sessions, in the form that a stream takes."""
    out = sessions.gap_sessions(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", DAY)
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first", "last")})


@query(
    f"""
    WITH {ORDERS_SQL}, d AS (SELECT k, CASE WHEN status <> 'P' THEN date_diff('day', {TODAY_SQL}, day) END AS days FROM o)
    SELECT k, days, CASE WHEN days IS NULL THEN 'TBA' WHEN days < 0 THEN 'D+' || -days WHEN days = 0 THEN 'D-Day' ELSE 'D-' || days END AS label,
           CASE WHEN days IS NULL THEN 'tba' WHEN days < 0 THEN 'past' WHEN days <= 14 THEN 'urgent' WHEN days <= 60 THEN 'soon' ELSE 'later' END AS urgency
    FROM d
    """
)
def day_label_buckets(spark, sf_dir):
    days = F.when(F.col("status") != "P", days_left(F.col("day"), TODAY)).cast("bigint")
    return editions(spark, sf_dir).select("k", days.alias("days")).select("k", "days", day_label(F.col("days")).alias("label"), urgency(F.col("days")).alias("urgency"))


CATEGORIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]


@query(
    f"""
    WITH {ORDERS_SQL}, b AS (SELECT k, CAST(year(day) AS BIGINT) AS year, CASE WHEN status <> 'P' THEN date_diff('day', {TODAY_SQL}, day) END AS days, place
               FROM o WHERE year(day) BETWEEN 1996 AND 1999 AND status <> 'F')
    SELECT k, year, days, place, CAST(CASE place WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3 ELSE 4 END AS BIGINT) AS category_order,
           count(*) OVER (PARTITION BY year) AS n_in_year
    FROM b WHERE days IS NULL OR days >= -365
    """
)
def year_window_board(spark, sf_dir):
    o = editions(spark, sf_dir).withColumn("year", F.year("day").cast("bigint"))
    o = o.withColumn("days", F.when(F.col("status") != "P", days_left(F.col("day"), TODAY)).cast("bigint"))
    window = F.col("year").between(TODAY.year - 2, TODAY.year + 1)
    rows = report.board(o, "year", "days", "place", "k", CATEGORIES, [window, F.col("status") != "F", F.col("days").isNull() | (F.col("days") >= -365)])
    return rows.select("k", "year", "days", "place", F.col("category_order").cast("bigint"), "n_in_year")


MERGED_SQL = (
    LAYERS_SQL
    + """, g AS (SELECT k, status, link, CASE WHEN upper(trim(place)) NOT IN ('', 'TBA', 'TBD') THEN place END AS place FROM c), j AS (SELECT coalesce(e.k, g.k, m.k) AS k, e.k IS NOT NULL AS he, g.k IS NOT NULL AS hc, coalesce(m.set_fields, []) AS sets,
                 e.status AS es, e.place AS ep, e.link AS el, m.status AS ms, m.place AS mp, m.link AS ml,
                 CASE WHEN NOT list_contains(coalesce(m.set_fields, []), 'status') AND g.status IS NOT NULL THEN g.status ELSE e.status END AS bs,
                 CASE WHEN NOT list_contains(coalesce(m.set_fields, []), 'place') AND g.place IS NOT NULL THEN g.place ELSE e.place END AS bp,
                 CASE WHEN NOT list_contains(coalesce(m.set_fields, []), 'link') AND g.link IS NOT NULL THEN g.link ELSE e.link END AS bl
          FROM e FULL JOIN g ON e.k = g.k FULL JOIN m ON coalesce(e.k, g.k) = m.k),
    r AS (SELECT *, CASE WHEN list_contains(sets, 'status') THEN ms ELSE bs END AS status, CASE WHEN list_contains(sets, 'place') THEN mp ELSE bp END AS place,
                 CASE WHEN list_contains(sets, 'link') THEN ml ELSE bl END AS link FROM j),
    f AS (SELECT k, status, place, link,
                 concat_ws(',', CASE WHEN list_contains(sets, 'status') AND status IS DISTINCT FROM bs THEN 'status' END,
                   CASE WHEN list_contains(sets, 'place') AND place IS DISTINCT FROM bp THEN 'place' END,
                   CASE WHEN list_contains(sets, 'link') AND link IS DISTINCT FROM bl THEN 'link' END) AS overridden,
                 CASE WHEN he AND hc THEN 'both' WHEN he THEN 'existing' WHEN hc THEN 'upstream' ELSE 'override' END AS origin,
                 CASE WHEN NOT he THEN 'created' WHEN status IS NOT DISTINCT FROM es AND place IS NOT DISTINCT FROM ep AND link IS NOT DISTINCT FROM el THEN 'kept' ELSE 'updated' END AS change
          FROM r)"""
)


def _merged(spark, sf_dir):
    return merge.layered_merge(*layers(spark, sf_dir), ["k"], ["status", "place", "link"])


@query(f"WITH {MERGED_SQL} SELECT * FROM f")
def layered_merge(spark, sf_dir):
    return _merged(spark, sf_dir)


@query(f"WITH {MERGED_SQL} SELECT origin, change, count(*) AS n, count(CASE WHEN overridden <> '' THEN 1 END) AS n_overridden FROM f GROUP BY origin, change")
def change_classification(spark, sf_dir):
    return _merged(spark, sf_dir).groupBy("origin", "change").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("overridden") != "").alias("n_overridden"))


@query(
    f"""
    WITH {LAYERS_SQL}
    SELECT o.k, CASE WHEN list_contains(m.set_fields, 'status') THEN m.status ELSE o.status END AS status,
           CASE WHEN list_contains(m.set_fields, 'link') THEN m.link ELSE o.link END AS link,
           coalesce(list_contains(m.set_fields, 'link'), FALSE) AS deleted
    FROM o LEFT JOIN m ON o.k = m.k
    """
)
def override_null_delete(spark, sf_dir):
    _, _, override = layers(spark, sf_dir)
    rows = editions(spark, sf_dir).alias("o").join(override.alias("m"), "k", "left")
    owns = lambda f: merge.owned(F.col("set_fields"), f)
    return rows.select(
        "k", merge.overridden(F.col("o.status"), F.col("m.status"), owns("status")).alias("status"), merge.overridden(F.col("o.link"), F.col("m.link"), owns("link")).alias("link"), owns("link").alias("deleted")
    )


@query(
    f"""
    WITH {LAYERS_SQL}
    SELECT k, concat_ws(',', CASE WHEN e.link IS DISTINCT FROM c.link THEN 'link' END, CASE WHEN e.place IS DISTINCT FROM c.place THEN 'place' END,
           CASE WHEN e.status IS DISTINCT FROM c.status THEN 'status' END) AS changed
    FROM e JOIN c USING (k)
    """
)
def record_diff(spark, sf_dir):
    e, c, _ = layers(spark, sf_dir)
    rows = e.alias("e").join(c.alias("c"), "k")
    return rows.select("k", merge.changed_fields({f: (F.col(f"e.{f}"), F.col(f"c.{f}")) for f in ("status", "place", "link")}).alias("changed"))


@query(f"WITH {SOURCES_SQL} SELECT k, flag, line, ship, part FROM s WHERE pos = 1")
def source_priority_winner(spark, sf_dir):
    return merge.source_winner(sources(spark, sf_dir), ["k"], "pos", "part").select("k", "flag", "line", "ship", "part")


@query(
    f"""
    WITH {SOURCES_SQL}, p AS (SELECT *, max(CASE WHEN flag = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY pos) AS seen FROM s)
    SELECT k, count(*) AS usable, max(pos) AS last_pos FROM p WHERE seen = 0 GROUP BY k
    """
)
def usable_source_prefix(spark, sf_dir):
    rows = merge.usable_prefix(sources(spark, sf_dir).withColumn("failed", F.col("flag") == "R"), ["k"], "pos", "failed")
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("usable"), F.max("pos").alias("last_pos"))


@query(
    f"""
    WITH {SOURCES_SQL}, v AS (SELECT k, pos, year(ship) AS y, CASE WHEN line = 'F' THEN ship END AS a FROM s),
    w AS (SELECT v.*, first_value(y) OVER (PARTITION BY k ORDER BY pos) AS wy FROM v)
    SELECT k, max(CASE WHEN pos = 1 THEN a END) AS abstract,
           coalesce(max(CASE WHEN pos = 1 THEN a END), arg_min(a, pos) FILTER (WHERE pos > 1 AND y = wy AND a IS NOT NULL)) AS filled
    FROM w GROUP BY k
    """
)
def cross_fill(spark, sf_dir):
    rows = sources(spark, sf_dir).select("k", "pos", F.array(F.year("ship")).alias("cycles"), F.when(F.col("line") == "F", F.col("ship")).alias("abstract"))
    return merge.cross_fill(rows, ["k"], "pos", "cycles", "abstract").select("k", "abstract", "filled")


def _dates(spark, sf_dir):
    """Orders with their own day and the ship days of their line items, as arrays."""
    ships = sources(spark, sf_dir).groupBy("k").agg(F.array_sort(F.collect_list("ship")).alias("ships"))
    days = F.when(F.col("status") == "P", F.array().cast("array<date>")).otherwise(F.array("day", F.date_add("day", 200)))
    return editions(spark, sf_dir).join(ships, "k", "left").select("k", days.alias("days"), F.coalesce("ships", F.array().cast("array<date>")).alias("ships"))


DATES_SQL = f"""{ORDERS_SQL}, {SOURCES_SQL},
    x AS (SELECT o.k, d.d FROM o, unnest(CASE WHEN status = 'P' THEN CAST([] AS DATE[]) ELSE [day, CAST(day + INTERVAL 200 DAY AS DATE)] END) AS d(d)),
    near AS (SELECT x.k, x.d, min(abs(date_diff('day', s.ship, x.d))) AS apart FROM x JOIN s ON s.k = x.k GROUP BY x.k, x.d)"""


@query(f"WITH {DATES_SQL} SELECT o.k, coalesce((SELECT bool_or(apart > 90) FROM near WHERE near.k = o.k AND d >= {TODAY_SQL}), FALSE) AS railed FROM o")
def safety_rail(spark, sf_dir):
    return _dates(spark, sf_dir).select("k", merge.rail(F.col("days"), F.col("ships"), TODAY).alias("railed"))


@query(f"WITH {DATES_SQL} SELECT o.k, (SELECT max(apart) FROM near WHERE near.k = o.k) AS days, coalesce((SELECT max(apart) FROM near WHERE near.k = o.k) > 90, FALSE) AS large FROM o")
def large_move(spark, sf_dir):
    rows = _dates(spark, sf_dir).select("k", merge.largest_move(F.col("days"), F.col("ships")).cast("bigint").alias("days"))
    return rows.withColumn("large", F.coalesce(F.col("days") > merge.RAIL_DAYS, F.lit(False)))


@query(
    f"""
    WITH {SOURCES_SQL}, h AS (SELECT k, pos % 2 AS side, ship, row_number() OVER (PARTITION BY k, pos % 2 ORDER BY ship) AS r FROM s),
    p AS (SELECT coalesce(a.k, b.k) AS k, a.ship IS NULL OR b.ship IS NULL OR abs(date_diff('day', a.ship, b.ship)) > 400 AS apart
          FROM (SELECT * FROM h WHERE side = 1) a FULL JOIN (SELECT * FROM h WHERE side = 0) b ON a.k = b.k AND a.r = b.r)
    SELECT k, bool_or(apart) AS disagree FROM p GROUP BY k
    """
)
def source_disagreement(spark, sf_dir):
    side = lambda n: F.filter(F.collect_list(F.when(F.col("pos") % 2 == n, F.col("ship"))), lambda d: d.isNotNull())
    rows = sources(spark, sf_dir).groupBy("k").agg(side(1).alias("a"), side(0).alias("b"))
    return rows.select("k", merge.disagree(F.col("a"), F.col("b"), 400).alias("disagree"))


@query(
    f"""
    WITH {ORDERS_SQL}
    SELECT k, CASE WHEN year(day) >= 1998 THEN 'slot' || link ELSE coalesce(CASE WHEN status <> 'O' THEN place END, 'slot' || link) END AS full_name,
           'x' || lpad(CAST(year(day) % 100 AS VARCHAR), 2, '0') AS id
    FROM o
    """
)
def enforce_dimension(spark, sf_dir):
    o = editions(spark, sf_dir)
    name = merge.enforce(F.when(F.col("status") != "O", F.col("place")), F.concat(F.lit("slot"), "link"), F.year("day"), 1998)
    return o.select("k", name.alias("full_name"), F.concat(F.lit("x"), F.lpad((F.year("day") % 100).cast("string"), 2, "0")).alias("id"))


@query(
    f"""
    WITH {LAYERS_SQL}, n AS (SELECT e.k, CASE e.place WHEN '1-URGENT' THEN 'CFP not announced yet' WHEN '2-HIGH' THEN 'bring a poster' WHEN '3-MEDIUM' THEN 'dates not yet available' END AS note, e.status <> 'P' AS had,
                                    coalesce(d.status, e.status) <> 'P' AS has FROM e LEFT JOIN (SELECT k, 'O' AS status FROM o WHERE month(day) <= 6) d ON e.k = d.k)
    SELECT k, CASE WHEN NOT had AND has AND regexp_matches(coalesce(note, ''), '{quality.STALE}') THEN NULL ELSE note END AS note FROM n
    """
)
def stale_note(spark, sf_dir):
    e, _, _ = layers(spark, sf_dir)
    dated = editions(spark, sf_dir).filter(F.month("day") <= 6).select("k", F.lit("O").alias("status"))
    rows = e.alias("e").join(dated.alias("d"), "k", "left")
    note = F.when(F.col("place") == "1-URGENT", "CFP not announced yet").when(F.col("place") == "2-HIGH", "bring a poster").when(F.col("place") == "3-MEDIUM", "dates not yet available")
    had, has = F.col("e.status") != "P", F.coalesce("d.status", "e.status") != "P"
    return rows.select("k", merge.without_stale_note(note, had, has, quality.STALE).alias("note"))


@query(
    f"""
    WITH {LAYERS_SQL}
    SELECT k, list_contains(set_fields, 'link') IS NOT TRUE
              AND (NOT list_contains(set_fields, 'status') OR coalesce(m.status = c.status, FALSE))
              AND (NOT list_contains(set_fields, 'place') OR coalesce(m.place = c.place, FALSE)) AS obsolete
    FROM m JOIN c USING (k)
    """
)
def obsolete_override(spark, sf_dir):
    _, c, m = layers(spark, sf_dir)
    rows = m.alias("m").join(c.alias("c"), "k")
    return rows.select("k", merge.obsolete(F.col("set_fields"), {f: (F.col(f"m.{f}"), F.col(f"c.{f}")) for f in ("status", "place", "link")}).alias("obsolete"))


def _cycles(spark, sf_dir):
    """Orders with the days of their line items as papers, and the first one's day as an abstract where that line is finished."""
    s = sources(spark, sf_dir).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("ship").cast("string").alias("d"), "line"))).alias("x"))
    s = s.select("k", F.transform("x", lambda v: v["d"]).alias("papers"), F.get("x", F.lit(0))["line"].alias("line"))
    return s.select("k", "papers", F.when(F.col("line") == "F", F.slice("papers", 1, 1)).otherwise(F.array().cast("array<string>")).alias("abstracts"))


CYCLES_SQL = f"""{SOURCES_SQL}, z AS (SELECT k, pos, CAST(ship AS VARCHAR) AS paper, count(*) OVER (PARTITION BY k) AS n, line FROM s),
    y AS (SELECT k, CAST(pos - 1 AS BIGINT) AS i, n AS n_cycles, CASE WHEN n > 1 THEN 'cycle ' || pos ELSE '' END AS label, paper AS paper_raw,
                 CASE WHEN line = 'F' AND pos = 1 THEN paper END AS abstract_raw FROM z)"""


@query(f"WITH {CYCLES_SQL} SELECT * FROM y")
def expand_cycles(spark, sf_dir):
    rows = clusters.expand_cycles(_cycles(spark, sf_dir), "papers", "abstracts")
    return rows.select("k", F.col("i").cast("bigint"), F.col("n_cycles").cast("bigint"), "label", "paper_raw", "abstract_raw")


@query(
    f"""
    WITH {SOURCES_SQL},
    t AS (SELECT k, pos, CAST(ship AS TIMESTAMP) AS p, CASE WHEN line = 'F' THEN CAST(ship - INTERVAL 5 DAY AS TIMESTAMP) END AS a, CASE WHEN flag = 'N' THEN '' ELSE flag END AS note FROM s),
    g AS (SELECT *, CASE WHEN lag(p) OVER w IS NULL OR epoch_us(p) - epoch_us(lag(p) OVER w) > 14 * 86400000000 THEN 1 ELSE 0 END AS fresh FROM t WINDOW w AS (PARTITION BY k ORDER BY p, pos)),
    c AS (SELECT *, CAST(sum(fresh) OVER (PARTITION BY k ORDER BY p, pos) AS BIGINT) AS cluster FROM g),
    m AS (SELECT k, cluster, min(a) AS a0, max(p) AS p0, min(p) AS f0, count(*) AS n_merged, array_to_string(list_sort(list(DISTINCT pos)), ',') AS sources,
                 coalesce(arg_min(note, pos) FILTER (WHERE note <> ''), '') AS note FROM c GROUP BY k, cluster),
    x AS (SELECT *, CASE WHEN a0 IS NULL AND epoch_us(p0) > epoch_us(f0) AND epoch_us(p0) - epoch_us(f0) <= 14 * 86400000000 THEN f0 ELSE a0 END AS a1 FROM m)
    SELECT k, cluster, CAST(CASE WHEN a1 = p0 THEN NULL WHEN a1 > p0 THEN p0 ELSE a1 END AS DATE) AS abstract, CAST(CASE WHEN a1 > p0 THEN a1 ELSE p0 END AS DATE) AS paper,
           CAST(least(coalesce(a1, p0), p0) AS DATE) AS effective, n_merged, sources, note FROM x
    """
)
def dedupe_cycles(spark, sf_dir):
    rows = sources(spark, sf_dir).select(
        "k", "pos", F.col("ship").cast("timestamp").alias("p"), F.when(F.col("line") == "F", F.date_sub("ship", 5).cast("timestamp")).alias("a"), F.when(F.col("flag") == "N", "").otherwise(F.col("flag")).alias("note")
    )
    grouped = clusters.gap_clusters(rows, ["k"], "p", 14 * DAY, "pos")
    out = clusters.merge_clusters(grouped, ["k", "cluster"], "a", "p", "pos", "pos", ["note"])
    return out.select("k", "cluster", F.to_date("abstract").alias("abstract"), F.to_date("paper").alias("paper"), F.to_date("effective").alias("effective"), "n_merged", F.array_join(F.transform("sources", lambda x: x["pos"].cast("string")), ",").alias("sources"), "note")


RAILED_SQL = f"""{ORDERS_SQL}, {SOURCES_SQL},
    e AS (SELECT k, status, [CAST(day AS VARCHAR) || ' 23:59', CAST(CAST(day + INTERVAL 200 DAY AS DATE) AS VARCHAR) || ' 23:59'] AS deadline FROM o WHERE place <> '5-LOW'),
    c AS (SELECT k, 'up' AS status, list(CAST(ship AS VARCHAR) || ' 12:00' ORDER BY pos) AS deadline FROM s GROUP BY k),
    m AS (SELECT k, CAST(NULL AS VARCHAR) AS status, [CAST(day AS VARCHAR) || ' 00:00'] AS deadline, ['deadline'] AS set_fields FROM o WHERE day(day) <= 3),
    x AS (SELECT e.k, d.d FROM e, unnest([e.deadline[1], e.deadline[2]]) AS d(d)),
    near AS (SELECT x.k, CAST(left(x.d, 10) AS DATE) AS d, min(abs(date_diff('day', s.ship, CAST(left(x.d, 10) AS DATE)))) AS apart FROM x JOIN s ON s.k = x.k GROUP BY x.k, x.d),
    rail AS (SELECT k, bool_or(apart > 90) AS hit FROM near WHERE d >= {TODAY_SQL} GROUP BY k),
    j AS (SELECT coalesce(e.k, c.k, m.k) AS k, e.k IS NOT NULL AS he, c.k IS NOT NULL AS hc, m.k IS NOT NULL AS hm, coalesce(rail.hit, FALSE) AND m.k IS NULL AND c.k IS NOT NULL AS railed,
                 e.status AS es, e.deadline AS ed, c.status AS cs, c.deadline AS cd, m.deadline AS md
          FROM e FULL JOIN c ON e.k = c.k FULL JOIN m ON coalesce(e.k, c.k) = m.k LEFT JOIN rail ON rail.k = coalesce(e.k, c.k)),
    r AS (SELECT *, CASE WHEN hc AND NOT railed THEN cs ELSE es END AS status, CASE WHEN hm THEN md WHEN hc AND NOT railed THEN cd ELSE ed END AS deadline FROM j)"""


@query(
    f"""
    WITH {RAILED_SQL}
    SELECT k, status, array_to_string(deadline, ',') AS deadline, railed,
           CASE WHEN NOT he THEN 'created' WHEN railed THEN 'railed' WHEN status IS NOT DISTINCT FROM es AND deadline IS NOT DISTINCT FROM ed THEN 'kept' ELSE 'updated' END AS change
    FROM r
    """
)
def railed_merge(spark, sf_dir):
    """The merge under the safety rail: dates as lists, candidates from the line items."""
    o, s = editions(spark, sf_dir), sources(spark, sf_dir)
    at = lambda d, t: F.concat(d.cast("string"), F.lit(f" {t}"))
    e = o.filter("place <> '5-LOW'").select("k", "status", F.array(at(F.col("day"), "23:59"), at(F.date_add("day", 200), "23:59")).alias("deadline"))
    c = s.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("pos", at(F.col("ship"), "12:00").alias("d")))).alias("x")).select("k", F.lit("up").alias("status"), F.transform("x", lambda v: v["d"]).alias("deadline"))
    m = o.filter(F.dayofmonth("day") <= 3).select("k", F.lit(None).cast("string").alias("status"), F.array(at(F.col("day"), "00:00")).alias("deadline"), F.array(F.lit("deadline")).alias("set_fields"))
    rows = merge.layered_merge(e, c, m, ["k"], ["status", "deadline"], deadlines="deadline", as_of=TODAY)
    return rows.select("k", "status", F.array_join("deadline", ",").alias("deadline"), "railed", "change")


@query(
    f"""
    WITH {ORDERS_SQL}, z AS (SELECT k, year(day) AS year, CAST(CASE status WHEN 'F' THEN 0 WHEN 'O' THEN 540 ELSE -720 END AS INTEGER) AS minutes, CAST(day AS TIMESTAMP) + INTERVAL 23 HOUR + INTERVAL 59 MINUTE AS t0, place FROM o WHERE year(day) BETWEEN 1996 AND 1999),
    t AS (SELECT k, CAST(0 AS BIGINT) AS i, t0 - to_minutes(minutes) AS p, CASE WHEN place = '1-URGENT' THEN t0 - to_minutes(minutes) - INTERVAL 3 DAY WHEN place = '2-HIGH' THEN t0 - to_minutes(minutes) - INTERVAL 7 DAY END AS a FROM z)
    SELECT k, i, strftime(p, '%Y-%m-%d %H:%M') AS paper, strftime(a, '%Y-%m-%d %H:%M') AS abstract, strftime(coalesce(a, p) + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS shown FROM t
    """
)
def display_rows(spark, sf_dir):
    """Cycle rows of the board: the year window, zones, and an abstract that the note alone tells of."""
    o = editions(spark, sf_dir)
    at = lambda d: F.array(F.concat(d.cast("string"), F.lit(" 23:59")))
    rows = o.select(
        "k", F.year("day").alias("year"), at(F.col("day")).alias("papers"), F.when(F.col("place") == "1-URGENT", at(F.date_sub("day", 3))).otherwise(F.array().cast("array<string>")).alias("abstracts"),
        F.when(F.col("status") == "F", "UTC").when(F.col("status") == "O", "Asia/Seoul").alias("zone"), F.when(F.col("place") == "2-HIGH", "Abstracts are due 1 week before the papers").alias("note"),
    )
    out = clusters.display_rows(rows, "papers", "abstracts", "year", "zone", "note", TODAY)
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm")
    return out.select("k", F.col("i").cast("bigint"), shown("paper_at").alias("paper"), shown("abstract_at").alias("abstract"), displayed(F.col("effective_at")).alias("shown"))


@query(
    f"""
    WITH {SOURCES_SQL}, p AS (SELECT p_partkey, p_type, p_name FROM part),
    t AS (SELECT s.k, s.pos, CAST(s.ship AS TIMESTAMP) AS paper, CASE WHEN s.line = 'F' THEN CAST(s.ship - INTERVAL 5 DAY AS TIMESTAMP) END AS abstract,
                 CASE WHEN s.flag = 'R' THEN 'cycle 1' WHEN s.flag = 'A' THEN '' ELSE '' END AS cycle, CASE WHEN s.flag = 'A' AND p.p_type = 'PROMO' THEN 'Demo' ELSE '' END AS track
          FROM s JOIN p ON p.p_partkey = s.part),
    u AS (SELECT *, CASE WHEN cycle <> '' THEN cycle WHEN track <> '' THEN 'track:demo' ELSE 'main' END AS part, least(coalesce(abstract, paper), paper) AS t0 FROM t),
    g AS (SELECT *, CASE WHEN lag(t0) OVER w IS NULL OR epoch_us(t0) - epoch_us(lag(t0) OVER w) > 14 * 86400000000 THEN 1 ELSE 0 END AS fresh FROM u WINDOW w AS (PARTITION BY k, part ORDER BY t0, pos)),
    c AS (SELECT *, CASE WHEN part = 'main' THEN CAST(sum(fresh) OVER (PARTITION BY k, part ORDER BY t0, pos) AS BIGINT) ELSE 1 END AS cluster FROM g),
    m AS (SELECT k, part, cluster, min(abstract) AS a0, max(paper) AS p0, min(paper) AS f0, count(*) AS n_merged FROM c GROUP BY ALL),
    x AS (SELECT *, CASE WHEN a0 IS NULL AND epoch_us(p0) > epoch_us(f0) AND epoch_us(p0) - epoch_us(f0) <= 14 * 86400000000 THEN f0 ELSE a0 END AS a1 FROM m)
    SELECT k, part, cluster, CAST(CASE WHEN a1 = p0 THEN NULL WHEN a1 > p0 THEN p0 ELSE a1 END AS DATE) AS abstract, CAST(CASE WHEN a1 > p0 THEN a1 ELSE p0 END AS DATE) AS paper, n_merged FROM x
    """
)
def dedupe_parts(spark, sf_dir):
    """Rows of a cycle or track are one, the others are clustered; tracks of a few venues only."""
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("part"), "p_type")
    rows = sources(spark, sf_dir).join(p, "part").withColumn("venue", F.when(F.col("flag") == "A", "ICSE").otherwise("CCS"))
    said = F.when(F.col("flag") == "R", "the first cycle")
    track = clusters.track_of(F.concat_ws(" ", F.when(F.col("p_type") == "PROMO", "Demonstrations"), said), venue=F.col("venue"))
    rows = rows.select("k", "pos", F.col("ship").cast("timestamp").alias("p"), F.when(F.col("line") == "F", F.date_sub("ship", 5).cast("timestamp")).alias("a"), F.coalesce(clusters.cycle_of(said), F.lit("")).alias("cycle"), track.alias("track"))
    out = clusters.dedupe(rows, ["k"], "cycle", "track", "a", "p", "pos", "pos", [], [])
    return out.select("k", "part", "cluster", F.to_date("abstract").alias("abstract"), F.to_date("paper").alias("paper"), "n_merged")


@query("SELECT event_type, min(event_id) AS first_seen, count(*) AS n FROM events GROUP BY event_type")
def first_seen_groups(spark, sf_dir):
    return clusters.in_first_seen_order(table(spark, sf_dir, "events"), ["event_type"], "event_id")


@query(
    """
    WITH h AS (SELECT l_orderkey AS k, l_linenumber AS src, list(CAST(l_shipdate AS DATE) ORDER BY CAST(l_shipdate AS DATE)) AS days, min(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS a FROM lineitem GROUP BY 1, 2),
    w AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY src) AS n, first_value(days) OVER (PARTITION BY k ORDER BY src) AS wanted FROM h)
    SELECT k, max(CASE WHEN n = 1 THEN len(days) END) AS n_days, coalesce(max(CASE WHEN n = 1 THEN a END), arg_min(a, src) FILTER (WHERE n > 1 AND days = wanted AND a IS NOT NULL)) AS filled FROM w GROUP BY k
    """
)
def cross_fill_cycles(spark, sf_dir):
    """Cross-filling over sources that list several days each."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    rows = l.groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("src")).agg(F.array_sort(F.collect_list(F.to_date("l_shipdate"))).alias("days"), F.min(F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))).alias("a"))
    return merge.cross_fill(rows, ["k"], "src", "days", "a").select("k", F.size("days").cast("bigint").alias("n_days"), "filled")


@query(
    f"""
    WITH {ORDERS_SQL}, b AS (SELECT k, CAST(year(day) AS BIGINT) AS year, CASE WHEN status <> 'P' THEN date_diff('day', {TODAY_SQL}, day) END AS days, place, link FROM o WHERE day(day) > 3 AND status || link <> 'F7')
    SELECT k, year, days, place, count(*) OVER (PARTITION BY year) AS n_in_year FROM b WHERE contains('venue ' || link, 'venue 1') AND year = 1998 AND place = '2-HIGH' AND coalesce(days, 0) >= 0
    """
)
def filtered_board(spark, sf_dir):
    """All of the board's filters at once: text, year, category, upcoming, tracks and workshops."""
    o = editions(spark, sf_dir).withColumn("year", F.year("day").cast("bigint")).withColumn("days", F.when(F.col("status") != "P", days_left(F.col("day"), TODAY)).cast("bigint"))
    track = F.when((F.col("status") == "F") & (F.col("link") == "7"), "Demo").otherwise("")
    filters = report.board_filters([F.lit("Venue"), F.col("link")], " VENUE 1", F.col("year"), "1998", F.col("place"), "2-HIGH", F.col("days"), F.col("days"), True, track, F.dayofmonth("day") <= 3, False)
    return report.board(o, "year", "days", "place", "k", CATEGORIES, filters).select("k", "year", "days", "place", "n_in_year")
