"""Queries on quality, proposals, reports, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.dates import days_left
from tidemark.operators import evidence, matching, proposals, quality, report
from tidemark.plans.base import LAYERS_SQL, ORDERS_SQL, SOURCES_SQL, TODAY, TODAY_SQL, editions, layers, query, sources, table
from tidemark.sources import records

@query(
    f"""
    WITH {ORDERS_SQL}, r AS (SELECT k, status, year(day) AS y, CASE k % 5 WHEN 0 THEN 'TBA' WHEN 1 THEN strftime(day, '%Y-%m-%d') ELSE strftime(day, '%Y-%m-%d') || ' 23:59' END AS d,
                                    [NULL, ' tbd', '2020-1-1 00:00', '2020-01-01 00:00', 'soon'][1 + CAST(cust % 5 AS INTEGER)] AS a,
                                    ['AoE', 'Mars/Base', 'somewhere', 'Europe/Berlin', 'UTC+9', NULL, 'America/Argentina/Buenos_Aires'][1 + CAST(k % 7 AS INTEGER)] AS z, CASE WHEN link = '7' THEN 'ftp://x' ELSE 'https://x' END AS l FROM o)
    SELECT k, concat_ws(',', CASE WHEN status = 'P' THEN 'title' END, CASE WHEN y NOT BETWEEN 1996 AND 1999 THEN 'year' END, CASE WHEN d = 'TBA' THEN 'no deadline' END,
             CASE WHEN d <> 'TBA' AND NOT regexp_matches(d, ':') THEN 'bad deadline' END, CASE WHEN a IN ('2020-1-1 00:00', 'soon') THEN 'bad abstract' END, CASE WHEN z = 'somewhere' THEN 'bad zone' END,
             CASE WHEN z = 'Mars/Base' THEN 'unknown zone' END, CASE WHEN l = 'ftp://x' THEN 'bad link' END) AS errors
    FROM r
    """
)
def record_validation(spark, sf_dir):
    k, day, pick = F.col("k"), F.col("day").cast("string"), lambda c, *v: F.get(F.array(*[F.lit(x).cast("string") for x in v]), (c % len(v)).cast("int"))
    d = F.when(k % 5 == 0, "TBA").when(k % 5 == 1, day).otherwise(F.concat(day, F.lit(" 23:59")))
    a = F.array(pick(F.col("cust"), None, " tbd", "2020-1-1 00:00", "2020-01-01 00:00", "soon"))
    z = pick(k, "AoE", "Mars/Base", "somewhere", "Europe/Berlin", "UTC+9", None, "America/Argentina/Buenos_Aires")
    link = F.when(F.col("link") == "7", "ftp://x").otherwise("https://x")
    errors = quality.record_errors(F.col("status"), F.year("day"), F.array(d), a, z, link, F.col("status") != "P", TODAY)
    return editions(spark, sf_dir).select("k", F.array_join(errors, ",").alias("errors"))


REASONS_SQL = f"""CASE WHEN days BETWEEN 0 AND 45 THEN 'soon' END, CASE WHEN status = 'P' THEN 'tba' END, CASE WHEN place = '5-LOW' AND days > 300 THEN 'stale' END"""


@query(
    f"""
    WITH {ORDERS_SQL}, d AS (SELECT *, date_diff('day', {TODAY_SQL}, day) AS days FROM o), r AS (SELECT k, concat_ws(',', {REASONS_SQL}) AS reasons FROM d)
    SELECT k, reasons, CAST(CASE split_part(reasons, ',', 1) WHEN 'soon' THEN 0 WHEN 'tba' THEN 1 ELSE 2 END AS INTEGER) AS rank FROM r WHERE reasons <> ''
    """
)
def watchlist_reasons(spark, sf_dir):
    days = days_left(F.col("day"), TODAY)
    reasons = [("soon", days.between(0, 45)), ("tba", F.col("status") == "P"), ("stale", (F.col("place") == "5-LOW") & (days > 300))]
    return quality.watchlist(editions(spark, sf_dir), reasons, ["k"]).select("k", "reasons", "rank")


WATCH_SQL = f"""{ORDERS_SQL}, {SOURCES_SQL}, n AS (SELECT k, count(DISTINCT ship) > 6 AS disagrees FROM s GROUP BY k),
    w AS (SELECT o.k, cust, CAST(year(day) AS INTEGER) AS year, CASE WHEN status <> 'P' THEN day END AS d, CASE place WHEN '1-URGENT' THEN 'CFP not announced yet' WHEN '2-HIGH' THEN 'bring a poster' END AS note,
                 CASE WHEN place = '5-LOW' THEN 'tbd' ELSE place END AS place, coalesce(disagrees, FALSE) AS disagrees, day(day) <= 5 AS pinned FROM o LEFT JOIN n ON n.k = o.k),
    r AS (SELECT k, year, list_filter([CASE WHEN d BETWEEN {TODAY_SQL} AND {TODAY_SQL} + 45 THEN 'deadline-within-45-days' END, CASE WHEN year >= 1998 AND d IS NULL THEN 'tba-upcoming-cycle' END,
                 CASE WHEN (d IS NULL OR d >= {TODAY_SQL}) AND pinned THEN 'manual-override-active' END, CASE WHEN (d IS NULL OR d >= {TODAY_SQL}) AND disagrees THEN 'cross-source-disagreement' END,
                 CASE WHEN year >= 1998 AND note LIKE 'CFP%' THEN 'stale-placeholder-note' END, CASE WHEN year >= 1998 AND d >= {TODAY_SQL} AND place = 'tbd' THEN 'tba-metadata' END], lambda x: x IS NOT NULL) AS reasons FROM w),
    g AS (SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT cust FROM w WHERE year >= 1999))"""


def _watched(spark, sf_dir):
    """Orders as records, watched for what the columns say; customers are the targets to cover."""
    found = sources(spark, sf_dir).groupBy("k").agg((F.count_distinct("ship") > 6).alias("disagrees"))
    o = editions(spark, sf_dir).join(found, "k", "left").withColumn("year", F.year("day"))
    days = F.array(F.when(F.col("status") != "P", F.col("day").cast("string")).otherwise("TBA"))
    note = F.when(F.col("place") == "1-URGENT", "CFP not announced yet").when(F.col("place") == "2-HIGH", "bring a poster")
    place = F.when(F.col("place") == "5-LOW", " tbd").otherwise(F.col("place"))
    reasons = quality.watch_reasons(F.col("year"), days, note, place, F.lit("May 1, 1998"), F.lit("AoE"), F.coalesce("disagrees", F.lit(False)), F.dayofmonth("day") <= 5, TODAY)
    targets = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("title"))
    covered = o.select(F.concat(F.lit("c"), "cust").alias("title"), "year")
    return quality.full_watchlist(o.withColumn("title", F.concat(F.lit("o"), "k")), reasons, targets, covered, "title", "year", TODAY.year + 1)


@query(
    f"""
    WITH {WATCH_SQL}, a AS (SELECT 'o' || k AS title, year, reasons FROM r WHERE len(reasons) > 0 UNION ALL SELECT 'c' || c_custkey, 1999, ['coverage-gap'] FROM g)
    SELECT title, year, array_to_string(reasons, ',') AS reasons,
           CAST(list_position(['deadline-within-45-days', 'tba-upcoming-cycle', 'manual-override-active', 'cross-source-disagreement', 'stale-placeholder-note', 'coverage-gap', 'tba-metadata'], reasons[1]) - 1 AS INTEGER) AS rank FROM a
    """
)
def watchlist(spark, sf_dir):
    return _watched(spark, sf_dir).select("title", "year", F.array_join("reasons", ",").alias("reasons"), "rank")


@query(
    f"""
    WITH {WATCH_SQL}, a AS (SELECT 'o' || k AS title, year, reasons FROM r WHERE len(reasons) > 0 UNION ALL SELECT 'c' || c_custkey, 1999, ['coverage-gap'] FROM g)
    SELECT '{{"title":"' || title || '","year":' || year || ',"reasons":["' || array_to_string(reasons, '","') || '"],"rank":'
           || (list_position(['deadline-within-45-days', 'tba-upcoming-cycle', 'manual-override-active', 'cross-source-disagreement', 'stale-placeholder-note', 'coverage-gap', 'tba-metadata'], reasons[1]) - 1) || '}}' AS value FROM a
    """
)
def watchlist_sink(spark, sf_dir):
    return records.watchlist_json(_watched(spark, sf_dir), ["title", "year"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998)")
def coverage_gap(spark, sf_dir):
    wanted = table(spark, sf_dir, "customer").select("c_custkey")
    present = table(spark, sf_dir, "orders").filter(F.year("o_orderdate") == 1998).select(F.col("o_custkey").alias("c_custkey"))
    return quality.missing_keys(wanted, present, ["c_custkey"])


@query(f"WITH {LAYERS_SQL} SELECT m.k, m.place FROM m WHERE k NOT IN (SELECT k FROM e) AND k NOT IN (SELECT k FROM c)")
def override_only_rows(spark, sf_dir):
    e, c, m = layers(spark, sf_dir)
    return quality.missing_keys(m, e.select("k").union(c.select("k")), ["k"]).join(m.select("k", "place"), "k")


@query(f"WITH {LAYERS_SQL} SELECT k FROM (SELECT k FROM c UNION SELECT k FROM m) WHERE k NOT IN (SELECT k FROM e)")
def unaccounted(spark, sf_dir):
    e, c, m = layers(spark, sf_dir)
    return quality.missing_keys(c.select("k").union(m.select("k")), e, ["k"])


@query(
    f"""
    WITH {SOURCES_SQL} SELECT k, CASE WHEN count(CASE WHEN flag = 'R' THEN 1 END) > 1 THEN 'UNCONFIRMED' WHEN count(CASE WHEN flag = 'A' THEN 1 END) = 0 THEN 'UNCHECKED' ELSE 'VERIFIED' END AS status
    FROM s GROUP BY k
    """
)
def status_rollup(spark, sf_dir):
    rows = sources(spark, sf_dir).groupBy("k").agg(F.count_if(F.col("flag") == "R").alias("r"), F.count_if(F.col("flag") == "A").alias("a"))
    return rows.select("k", evidence.status_of(F.greatest(F.col("r") - 1, F.lit(0)), F.col("a")).alias("status"))


#: A page per customer lists the orders as dates of a call for papers; each order is a proposal about its customer's page.
LABELS = {"F": "Paper submission deadline", "O": "Notification of acceptance", "P": "Abstract registration"}
VERDICT_SQL = f"""{ORDERS_SQL}, n AS (SELECT cust, count(CASE WHEN status = 'P' THEN 1 END) AS abstracts, sum(CASE WHEN status = 'P' THEN 5 ELSE 6 END) AS tokens FROM o GROUP BY cust),
    v AS (SELECT k, place, status AS kind, CASE WHEN place = '5-LOW' THEN 'VERIFIED' WHEN place = '4-NOT SPECIFIED' THEN 'MALFORMED' WHEN c_mktsegment = 'BUILDING' THEN 'REJECTED_SOURCE' WHEN c_acctbal < 0 THEN 'UNREACHABLE'
                         WHEN status = 'P' THEN 'UNCHECKED' WHEN status = 'F' AND place = '1-URGENT' THEN 'VERIFIED' WHEN status = 'O' AND place = '1-URGENT' AND abstracts = 0 AND tokens >= 8 THEN 'VERIFIED' ELSE 'UNCONFIRMED' END AS status
          FROM o JOIN customer ON c_custkey = cust JOIN n USING (cust))"""


def _said(day):
    return F.date_format(day, "MMMM d, yyyy")


def _lines(spark, sf_dir):
    """Per customer the lines of its page, in the order of its orders."""
    label = F.coalesce(*[F.when(F.col("status") == k, v) for k, v in LABELS.items()])
    lines = F.transform(F.array_sort(F.collect_list(F.struct("k", F.concat(label, F.lit(": "), _said(F.col("day"))).alias("line")))), lambda x: x["line"])
    return editions(spark, sf_dir).groupBy("cust").agg(lines.alias("lines"), F.max(F.when(F.col("status") == "F", F.col("day"))).alias("last"))


def _proposals(spark, sf_dir):
    """Proposals of orders, and the pages of customers that have landed (those in credit)."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("cust"), "c_acctbal", F.when(F.col("c_mktsegment") == "BUILDING", "https://www.tracker.example/").otherwise("https://conf.example/").alias("host"))
    c = c.join(_lines(spark, sf_dir), "cust").withColumn("url", F.concat("host", F.col("cust").cast("string")))
    html = F.concat(F.lit("<html><!-- Paper submission deadline: May 1, 2030 --><ul><li>"), F.array_join("lines", "</li><li>"), F.lit("</li></ul><s>Abstract: May 2, 2030</s></html>"))
    pages = c.filter("c_acctbal >= 0").select("url", html.alias("html"))
    o, day, lit = editions(spark, sf_dir).join(c.select("cust", "url", "lines", "last"), "cust"), F.col("day"), F.lit
    claim = lambda value, quotes, scope=None: F.struct(value.cast("array<string>").alias("value"), quotes.cast("array<string>").alias("quotes"), (lit(None) if scope is None else scope).cast("string").alias("scope"))
    deadline = lambda *days: F.array(*[F.concat(d.cast("string"), lit(" 23:59")) for d in days])
    quote = lambda label, d: F.concat(lit(f"{label} – "), F.date_format(d, "MMMM d"), lit("th, "), F.date_format(d, "yyyy"))
    paper, far, urgent, none = LABELS["F"], F.add_months(day, 240), F.col("place") == "1-URGENT", F.array()
    # A list of two cycles with a quote for each; a value that its quote doesn't hold; a quote that is on no page; the label of another
    # field; an absence within the whole page; a note, which nothing on a page can confirm.
    given = (
        F.when(F.col("place") == "4-NOT SPECIFIED", F.create_map().cast(evidence.CLAIMS))
        .when((F.col("status") == "F") & urgent, F.create_map(lit("deadline"), claim(deadline(day, F.col("last")), F.array(lit(""), quote(paper, day), quote(paper, F.col("last"))))))
        .when((F.col("status") == "F") & (F.col("place") == "2-HIGH"), F.create_map(lit("deadline"), claim(deadline(F.date_add(day, 1)), F.array(quote(paper, day)))))
        .when(F.col("status") == "F", F.create_map(lit("deadline"), claim(deadline(far), F.array(quote(paper, far)))))
        .when((F.col("status") == "O") & urgent, F.create_map(lit("abstract_deadline"), claim(lit(None), none, F.array_join("lines", " "))))
        .when(F.col("status") == "O", F.create_map(lit("deadline"), claim(deadline(day), F.array(quote(LABELS["O"], day)))))
        .otherwise(F.create_map(lit("note"), claim(F.array(lit("two rounds")), F.array(lit("There will be two rounds of reviews")))))
    )
    action = F.when(F.col("place") == "5-LOW", "delete_manual").otherwise("upsert_manual")
    return o.select(F.col("k").alias("id"), action.alias("action"), F.col("url").alias("source_url"), given.alias("claims")), pages


def _verdicts(spark, sf_dir):
    given, pages = _proposals(spark, sf_dir)
    return evidence.gate(given, pages, ["tracker.example"])


@query(f"WITH {VERDICT_SQL} SELECT k, status, CASE WHEN status = 'VERIFIED' AND place <> '5-LOW' AND kind = 'F' THEN CAST(1 AS DOUBLE) END AS coverage FROM v")
def evidence_gate(spark, sf_dir):
    return _verdicts(spark, sf_dir).select(F.col("id").alias("k"), "status", "coverage")


@query(
    f"""
    WITH {VERDICT_SQL} SELECT v.k, CASE WHEN kind = 'P' THEN 'note' WHEN kind = 'O' AND place = '1-URGENT' THEN 'abstract_deadline' ELSE 'deadline' END AS field, status,
           CASE WHEN status = 'VERIFIED' THEN '' WHEN kind = 'P' THEN 'no form to look for' WHEN kind = 'O' AND place = '1-URGENT' THEN CASE WHEN tokens < 8 THEN 'too short' ELSE 'dated entry' END
                WHEN kind = 'O' THEN 'no label,other label' WHEN place = '2-HIGH' THEN 'no value' ELSE 'not on the page' END AS reason
    FROM v JOIN o USING (k) JOIN n USING (cust) WHERE v.status IN ('VERIFIED', 'UNCONFIRMED', 'UNCHECKED') AND v.place <> '5-LOW'
    """.replace("field, status,", "field, v.status,").replace("CASE WHEN status = 'VERIFIED' THEN ''", "CASE WHEN v.status = 'VERIFIED' THEN ''").replace("WHEN place = '2-HIGH' THEN 'no value'", "WHEN v.place = '2-HIGH' THEN 'no value'").replace("kind = 'O' AND place =", "kind = 'O' AND v.place =")
)
def evidence_fields(spark, sf_dir):
    given, pages = _proposals(spark, sf_dir)
    open_ = given.filter("action <> 'delete_manual'")
    read = evidence.with_tokens(pages.select("url", text.strip_markup(F.col("html")).alias("t")), "t", "p").select("url", F.col("p_tokens").alias("page"))
    admitted = open_.filter(quality.admissible(F.col("source_url"), ["tracker.example"]))
    return evidence.field_results(evidence.claims_of(admitted, read)).select(F.col("id").alias("k"), "field", "status", "reason")


@query(
    f"""
    WITH {VERDICT_SQL} SELECT cust, CASE WHEN tokens < 8 THEN 'too short' WHEN abstracts = 0 THEN 'no entry' ELSE 'dated entry' END AS reason, tokens >= 8 AND abstracts = 0 AS absent FROM n
    """
)
def absence_check(spark, sf_dir):
    """Whether a customer's page, cited whole, holds no abstract date."""
    rows = evidence.with_tokens(_lines(spark, sf_dir).select("cust", F.array_join("lines", " ").alias("t"), F.lit("abstract_deadline").alias("field")), "t", "p")
    return evidence.absences(rows, "p_tokens", "p_tokens", "field").select("cust", F.col("absence_reason").alias("reason"), "absent")


@query(f"WITH {VERDICT_SQL} SELECT status, count(*) AS n, (SELECT count(*) FROM v) AS total, (SELECT count(*) FROM v WHERE status <> 'UNCHECKED') AS examined FROM v GROUP BY status")
def effort_accounting(spark, sf_dir):
    return quality.effort(_verdicts(spark, sf_dir), "status", "UNCHECKED")


@query(f"WITH {VERDICT_SQL} SELECT o.k, coalesce(v.status = 'VERIFIED', FALSE) AS accepted FROM o LEFT JOIN (SELECT * FROM v WHERE kind <> 'P') v ON v.k = o.k")
def proposal_verdict_join(spark, sf_dir):
    """Proposals with a good verdict; those that the gate left unchecked have no verdict here."""
    given = editions(spark, sf_dir).select(F.col("k").alias("id"), "status")
    verdicts = _verdicts(spark, sf_dir).join(given.filter("status <> 'P'").select("id"), "id", "left_semi")
    return proposals.judged(given, verdicts, "id").select(F.col("id").alias("k"), "accepted")


@query(f"""WITH {VERDICT_SQL} SELECT '{{"id":' || k || ',"status":"' || CASE WHEN status = 'VERIFIED' THEN 'accepted' ELSE 'rejected' END || '","gate":"' || status || '","detail":{{"n_grounded":' || CASE WHEN status = 'VERIFIED' AND place <> '5-LOW' THEN 1 ELSE 0 END || ',"n_refuted":' || CASE WHEN status = 'UNCONFIRMED' THEN 1 ELSE 0 END || '}}}}' AS value FROM v""")
def verdict_sink(spark, sf_dir):
    return records.verdict_json(_verdicts(spark, sf_dir).drop("coverage"))


@query(
    f"""
    WITH {LAYERS_SQL}, p AS (SELECT k, 'fixed' AS status, 'hall ' || link AS place, place = '1-URGENT' AS del, CASE WHEN status = 'O' THEN ['status'] ELSE ['place', 'status'] END AS sets FROM o WHERE day(day) BETWEEN 3 AND 12),
    q AS (SELECT * FROM p WHERE NOT del),
    j AS (SELECT coalesce(m.k, q.k) AS k, m.k IS NOT NULL AS hm, q.k IS NOT NULL AS hq, coalesce(q.sets, []) AS qs, coalesce(m.set_fields, []) AS mset, m.status AS ms, m.place AS mp,
                 CASE WHEN list_contains(coalesce(q.sets, []), 'status') THEN q.status ELSE m.status END AS status, CASE WHEN list_contains(coalesce(q.sets, []), 'place') THEN q.place ELSE m.place END AS place
          FROM m FULL JOIN q ON m.k = q.k)
    SELECT k, status, place, array_to_string(list_sort(list_distinct(list_concat(mset, qs))), ',') AS sets,
           CASE WHEN NOT hq THEN 'kept' WHEN NOT hm THEN 'added' WHEN list_has_all(mset, qs) AND status IS NOT DISTINCT FROM ms AND place IS NOT DISTINCT FROM mp THEN 'unchanged' ELSE 'changed' END AS change
    FROM j
    """
)
def proposal_upsert(spark, sf_dir):
    _, _, m = layers(spark, sf_dir)
    o = editions(spark, sf_dir).filter(F.dayofmonth("day").between(3, 12))
    sets = F.when(F.col("status") == "O", F.array(F.lit("status"))).otherwise(F.array(F.lit("place"), F.lit("status")))
    p = o.select("k", F.lit("fixed").alias("status"), F.concat(F.lit("hall "), "link").alias("place"), sets.alias("set_fields"), (F.col("place") == "1-URGENT").alias("delete"))
    return proposals.upsert(m, p, ["k"], ["status", "place"]).select("k", "status", "place", F.array_join("set_fields", ",").alias("sets"), "change")


@query(
    f"""
    WITH {ORDERS_SQL}, p AS (SELECT k, place, status, link, CAST(year(day) AS INTEGER) AS year, day, CASE WHEN status = 'P' THEN 'delete_manual' WHEN month(day) = 12 THEN 'invent' WHEN month(day) = 11 THEN 'create_record' ELSE 'upsert_manual' END AS action FROM o)
    SELECT k, concat_ws(',', CASE WHEN action = 'invent' THEN 'action' END, CASE WHEN place = '5-LOW' THEN 'title' END, CASE WHEN year NOT BETWEEN 1996 AND 1999 THEN 'year' END, CASE WHEN link = '3' THEN 'id' END,
             CASE WHEN status = 'P' AND link = '4' THEN 'not obsolete' END, CASE WHEN status <> 'P' AND link = '5' THEN 'source' END, CASE WHEN status <> 'P' AND link = '6' THEN 'no reason' END,
             CASE WHEN status <> 'P' AND place = '4-NOT SPECIFIED' THEN 'no fields' END, CASE WHEN action = 'create_record' AND (place = '4-NOT SPECIFIED' OR place = '3-MEDIUM') THEN 'no deadline' END,
             CASE WHEN status <> 'P' AND place <> '4-NOT SPECIFIED' AND day(day) = 1 THEN 'deadline: no evidence' END, CASE WHEN status <> 'P' AND place <> '4-NOT SPECIFIED' AND day(day) = 2 THEN 'deadline: quote' END,
             CASE WHEN status <> 'P' AND place = '2-HIGH' THEN 'deadline: bad date' END,
             CASE WHEN status = 'O' AND place <> '4-NOT SPECIFIED' THEN 'start: derived field' END, CASE WHEN status = 'O' AND place <> '4-NOT SPECIFIED' THEN 'start: no scope' END,
             CASE WHEN status = 'F' AND place <> '4-NOT SPECIFIED' THEN 'timezone: zone deletion' END) AS errors FROM p
    """
)
def proposal_validation(spark, sf_dir):
    """Rules on the action, the key, and each field of the map."""
    o, lit, day, link = editions(spark, sf_dir), F.lit, F.col("day"), F.col("link")
    claim = lambda value, quotes, scope: F.struct(value.cast("array<string>").alias("value"), quotes.cast("array<string>").alias("quotes"), scope.cast("string").alias("scope"))
    action = F.when(F.col("status") == "P", "delete_manual").when(F.month(day) == 12, "invent").when(F.month(day) == 11, "create_record").otherwise("upsert_manual")
    value = F.when(F.col("place") == "3-MEDIUM", "tba").when(F.col("place") == "2-HIGH", day.cast("string")).otherwise(F.concat(day.cast("string"), lit(" 23:59")))
    quotes = F.when(F.dayofmonth(day) == 1, F.array().cast("array<string>")).when(F.dayofmonth(day) == 2, F.array(lit("long enough"), lit("  short  "))).otherwise(F.array(lit("long enough")))
    gone = claim(lit(None), lit(None), F.when(F.col("status") == "F", "all that the page says"))
    other = F.when(F.col("status") == "F", "timezone").otherwise("start")
    fields = F.when((F.col("status") == "P") | (F.col("place") == "4-NOT SPECIFIED"), lit(None)).otherwise(F.create_map(lit("deadline"), claim(F.array(value), quotes, lit(None)), other, gone))
    given = o.select(
        "k", F.when(link == "3", "x").otherwise(F.concat_ws(":", action, "place", F.year(day).cast("string"))).alias("id"), action.alias("action"), F.col("place").alias("title"), F.year(day).alias("year"),
        F.when(link == "5", "ftp://x").otherwise("https://x").alias("source_url"), F.when(link == "6", " ").otherwise("moved").alias("reason"), F.when(link != "4", "upstream_agrees").alias("obsolete_because"), fields.alias("claims"),
    )
    titles = o.filter("place <> '5-LOW'").select(F.col("place").alias("title"))
    return proposals.proposal_errors(given, titles, TODAY).select("k", F.array_join("errors", ",").alias("errors"))


@query(
    f"""
    WITH {ORDERS_SQL}, m AS (SELECT *, CAST(year(day) AS INTEGER) AS year, CAST(day AS VARCHAR) AS d FROM o WHERE day(day) <= 20), p AS (SELECT *, CAST(year(day) AS INTEGER) AS year, CAST(day AS VARCHAR) AS d FROM o WHERE day(day) >= 10)
    SELECT coalesce(m.k, p.k) AS k, CASE WHEN p.k IS NULL THEN 'kept' WHEN m.k IS NULL THEN 'added' WHEN p.status = 'F' THEN 'unchanged' ELSE 'changed' END AS change,
           CASE WHEN m.k IS NOT NULL AND (p.k IS NULL OR p.status = 'F') THEN m.d || ' 23:59' WHEN p.status = 'F' THEN p.d || 'T23:59:00' ELSE p.d || ' soon' END AS deadline,
           concat_ws(',', CASE WHEN coalesce(m.place, p.place) = '5-LOW' THEN 'title' END, CASE WHEN coalesce(m.year, p.year) NOT BETWEEN 1996 AND 1999 THEN 'year' END,
             CASE WHEN p.k IS NOT NULL AND NOT (m.k IS NOT NULL AND p.status = 'F') THEN 'bad deadline' END) AS errors
    FROM m FULL JOIN p ON m.k = p.k
    """
)
def canonical_upsert(spark, sf_dir):
    """Proposals that write the same date or zone in another way change nothing; what they would leave is validated."""
    o, lit = editions(spark, sf_dir), F.lit
    keys = [F.col("k"), F.col("place").alias("title"), F.year("day").alias("year")]
    day, sets = F.col("day").cast("string"), F.array(lit("deadline"), lit("timezone"))
    m = o.filter(F.dayofmonth("day") <= 20).select(*keys, F.array(F.concat(day, lit(" 23:59"))).alias("deadline"), lit("AoE").alias("timezone"), sets.alias("set_fields"))
    p = o.filter(F.dayofmonth("day") >= 10).select(*keys, F.array(F.concat(day, F.when(F.col("status") == "F", "T23:59:00").otherwise(" soon"))).alias("deadline"), lit("UTC-12").alias("timezone"), sets.alias("set_fields"), lit(False).alias("delete"))
    out = proposals.upsert(m, p, ["k", "title", "year"], ["deadline", "timezone"], {"deadline": "stamps", "timezone": "zone"})
    known = o.filter("place <> '5-LOW'").select(F.col("place").alias("title"))
    nothing = lit(None).cast("string")
    out = proposals.checked(out.withColumns({"abstracts": F.array(nothing), "link": nothing}), "title", "year", "deadline", "abstracts", "timezone", "link", known, TODAY)
    return out.select("k", "change", F.array_join("deadline", ",").alias("deadline"), F.array_join("errors", ",").alias("errors"))


@query(
    f"WITH {ORDERS_SQL} SELECT k, left(sha256(status || '|' || place || '|' || link), 16) AS id, CASE WHEN k % 2 = 0 THEN place WHEN k % 3 = 0 THEN link ELSE status END AS quote FROM o"
)
def stable_ids(spark, sf_dir):
    blank = F.lit(" ")
    quotes = F.array(blank, F.when(F.col("k") % 2 == 0, F.col("place")).otherwise(blank), F.when(F.col("k") % 3 == 0, F.col("link")))
    return editions(spark, sf_dir).select("k", proposals.stable_id(F.col("status"), F.col("place"), F.col("link")).alias("id"), proposals.first_quote(quotes, F.array(F.col("status"))).alias("quote"))


@query(
    """
    WITH n AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS r FROM customer)
    SELECT c_custkey, c_nationkey, CAST((r - 1) // 9 + 1 AS BIGINT) AS page, CAST(((r - 1) // 9) // 5 + 1 AS BIGINT) AS page_range FROM n
    """
)
def paginate(spark, sf_dir):
    return report.paginate(table(spark, sf_dir, "customer"), ["c_nationkey"], [F.desc("c_acctbal"), F.col("c_custkey")]).select("c_custkey", "c_nationkey", "page", "page_range")


@query('SELECT c_custkey, CAST(ntile(2) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS INTEGER) AS "column" FROM customer')
def two_columns(spark, sf_dir):
    return report.two_columns(table(spark, sf_dir, "customer"), ["c_nationkey"], [F.col("c_custkey")]).select("c_custkey", "column")


@query(
    """
    WITH e AS (SELECT event_id, user_id, date_trunc('week', ts) AS week, ts FROM events WHERE event_type IN ('click', 'view', 'purchase'))
    SELECT event_id, row_number() OVER w = 1 AS is_first, lag(week) OVER w IS DISTINCT FROM week AS is_change, count(*) OVER (PARTITION BY user_id, week) AS n_in_week
    FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """
)
def week_change(spark, sf_dir):
    from pyspark.sql import Window

    rows = table(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "view", "purchase")).withColumn("week", F.date_trunc("week", F.to_date("ts")))
    rows = rows.withColumn("n_in_week", F.count(F.lit(1)).over(Window.partitionBy("user_id", "week")))
    return report.changes(rows, ["user_id"], [F.col("ts"), F.col("event_id")], "week").select("event_id", "is_first", "is_change", "n_in_week")


@query(
    """
    WITH t AS (SELECT DISTINCT CAST(week(ts) AS BIGINT) AS w, event_type FROM events), h AS (SELECT n_nationkey, CAST(n_nationkey % 6 AS BIGINT) AS out_week FROM nation)
    SELECT n_nationkey, out_week, coalesce((SELECT string_agg(DISTINCT event_type, ',' ORDER BY event_type) FROM t WHERE w <= out_week), '') AS topics FROM h
    """
)
def topics_upto_week(spark, sf_dir):
    items = table(spark, sf_dir, "events").select(F.weekofyear("ts").cast("bigint").alias("week"), "event_type")
    due = table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey") % 6).cast("bigint").alias("out_week"))
    return report.topics_until(items, due, "week", "event_type", "out_week", ["n_nationkey"])


@query("SELECT doc_id, lang FROM documents WHERE lang <> 'en' ORDER BY doc_id DESC LIMIT 8")
def latest_n_news(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("lang <> 'en'").orderBy(F.desc("doc_id")).limit(8).select("doc_id", "lang")


@query("SELECT p_partkey, CASE WHEN p_size <= 5 THEN 'featured' WHEN p_type = 'PROMO' THEN 'award' ELSE '' END AS section FROM part WHERE p_size <= 5 OR p_type IN ('PROMO', 'ECONOMY')")
def featured_filter(spark, sf_dir):
    section = F.when(F.col("p_size") <= 5, "featured").when(F.contains("p_type", F.lit("PROMO")), "award").otherwise("")
    return table(spark, sf_dir, "part").filter((F.col("p_size") <= 5) | F.col("p_type").isin("PROMO", "ECONOMY")).select("p_partkey", section.alias("section"))


GROUPS = {"click": "browse", "view": "browse", "purchase": "deal", "signup": "deal", "other": "other"}


@query(
    """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'browse' WHEN 'view' THEN 'browse' WHEN 'purchase' THEN 'deal' WHEN 'signup' THEN 'deal' ELSE 'other' END AS kind,
           CASE WHEN props LIKE '{"k": 1%' THEN 'one' WHEN props LIKE '{"k": 2%' THEN 'two' ELSE 'many' END AS badge
    FROM events WHERE event_type IN ('click', 'purchase', 'error')
    """
)
def type_group_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "events").filter(F.col("event_type").isin("click", "purchase", "error"))
    return rows.select("event_id", report.lookup(F.col("event_type"), GROUPS, "other").alias("kind"), report.badge(F.col("props"), [('{"k": 1', "one"), ('{"k": 2', "two")], "many").alias("badge"))


@query(
    f"""
    WITH {SOURCES_SQL} SELECT k, count(*) AS n, array_to_string(list(DISTINCT flag ORDER BY flag), ',') AS flags, arg_min(part, pos) AS cover,
           coalesce(string_agg(CAST(part AS VARCHAR), ',' ORDER BY pos) FILTER (WHERE pos > 1), '') AS rest, bool_and(line = 'F') AS all_f, bool_or(line = 'F') AS any_f FROM s GROUP BY k
    """
)
def collected(spark, sf_dir):
    parts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "part"))), lambda x: x["part"])
    rows = sources(spark, sf_dir).groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("flag")), ",").alias("flags"), parts.alias("parts"), F.bool_and(F.col("line") == "F").alias("all_f"), F.bool_or(F.col("line") == "F").alias("any_f")
    )
    cover, rest = report.cover_and_rest(F.col("parts"))
    return rows.select("k", "n", "flags", cover.alias("cover"), F.array_join(rest, ",").alias("rest"), "all_f", "any_f")


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS r FROM events) WHERE r = 1")
def keep_first(spark, sf_dir):
    return matching.keep_first(table(spark, sf_dir, "events"), ["user_id", "event_type"], "event_id").select("event_id", "user_id", "event_type")


@query("SELECT user_id, string_agg(concat('- id: ', chr(39), event_id, chr(39), chr(10), '  type: ', chr(39), event_type, chr(39)), chr(10) || chr(10) ORDER BY event_id) AS content FROM events GROUP BY user_id")
def record_files(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    body = records.record_text([("id", F.col("event_id")), ("type", F.col("event_type")), ("none", F.lit(None).cast("string"))])
    return records.assembled(rows.withColumn("body", body), ["user_id"], "event_id", "body")


@query("SELECT '{\"k\":' || n_nationkey || ',\"name\":\"' || n_name || '\",\"none\":null}' AS value FROM nation")
def override_json(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"), F.lit(None).cast("string").alias("none"))
    return records.json_lines(n, keep_nulls=True)


@query(
    """
    SELECT s_suppkey AS key, s_name AS name, 'supplier' AS source, 2 AS priority, CAST(NULL AS VARCHAR) AS segment FROM supplier
    UNION ALL SELECT c_custkey, c_name, 'customer', 1, c_mktsegment FROM customer
    """
)
def tagged_union(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return records.tagged_union([("supplier", 2, s), ("customer", 1, c)]).select("key", "name", "source", "priority", "segment")


@query(
    f"""
    WITH {SOURCES_SQL}, t AS (SELECT k, year(ship) AS year, pos, CAST(ship AS VARCHAR) AS d, CASE WHEN line = 'F' THEN CAST(ship AS VARCHAR) END AS a, CASE flag WHEN 'R' THEN 'camera-ready' ELSE 'paper' END AS comment FROM s)
    SELECT k, CAST(year AS INTEGER) AS year, string_agg(d, ',' ORDER BY pos) AS deadlines, string_agg(coalesce(a, '-'), ',' ORDER BY pos) AS abstracts FROM t
    WHERE year BETWEEN 1996 AND 1999 AND (comment = 'paper' OR a IS NOT NULL) GROUP BY k, year
    """
)
def several_editions(spark, sf_dir):
    s = sources(spark, sf_dir).withColumn("year", F.year("ship"))
    step = F.struct("pos", F.col("ship").cast("string").alias("deadline"), F.when(F.col("line") == "F", F.col("ship").cast("string")).alias("abstract"), F.when(F.col("flag") == "R", "camera-ready").otherwise("paper").alias("comment"))
    feed = s.groupBy("k", "year").agg(F.array_sort(F.collect_list(step)).alias("timeline")).groupBy("k").agg(F.collect_list(F.struct("year", "timeline")).alias("entries"))
    rows = records.several_editions(feed, "k", "entries", 1996, 1999, records.NO_CYCLE)
    return rows.select("k", "year", F.array_join("deadlines", ",").alias("deadlines"), F.array_join("abstracts", ",", "-").alias("abstracts"))


@query(
    """
    WITH h AS (SELECT n_nationkey, count(*) FILTER (WHERE p_name = CASE n_nationkey % 3 WHEN 0 THEN 'cold widget' WHEN 1 THEN 'no such' ELSE 'small widget' END AND p_size = n_nationkey + 1 AND p_brand LIKE '%#1%') AS hits FROM nation CROSS JOIN part GROUP BY n_nationkey)
    SELECT n_nationkey, hits = 1 AS alone FROM h
    """
)
def single_edition(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    feed = part.select(F.concat_ws(":", "p_name", "p_size").alias("entry"), F.col("p_brand").alias("description"), "p_partkey")
    n = F.col("n_nationkey")
    name = F.when(n % 3 == 0, "cold widget").when(n % 3 == 1, "no such").otherwise("small widget")
    wanted = table(spark, sf_dir, "nation").select("n_nationkey", F.concat_ws(":", name, n + 1).alias("entry"), F.lit("#1").alias("description_contains"))
    found, lost = records.single_edition(feed, "n_nationkey", "entry", wanted)
    return found.select("n_nationkey", F.lit(True).alias("alone")).unionByName(lost.select("n_nationkey", F.lit(False).alias("alone")))


@query(
    """
    WITH l AS (SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN '# note' WHEN 3 THEN '  ' ELSE role END AS line FROM conversations),
    b AS (SELECT *, sum(CASE WHEN trim(line) = '' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS block FROM l),
    c AS (SELECT *, sum(CASE WHEN line LIKE '#%' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, block ORDER BY turn) AS comments FROM b)
    SELECT conv_id, turn, CAST(comments AS BIGINT) AS comments FROM c WHERE trim(line) <> '' AND line NOT LIKE '#%'
    """
)
def comment_adjacency(spark, sf_dir):
    t = F.col("turn") % 4
    rows = table(spark, sf_dir, "conversations").withColumn("line", F.when(t == 0, "# note").when(t == 3, "  ").otherwise(F.col("role")))
    return report.adjacent_comments(rows, ["conv_id"], "turn", "line").select("conv_id", "turn", "comments")


@query(
    r"""
    SELECT page_id, CASE WHEN regexp_matches(regexp_extract(url, '^https?://[^/]+(/.*)', 1), '^/(en|fr)/\d+(\?|$)') THEN 'allowed' WHEN regexp_matches(url, 'utm_') THEN 'litter' ELSE 'changed' END AS kind FROM pages
    """
)
def path_allowlist(spark, sf_dir):
    path = F.regexp_extract("url", r"^https?://[^/]+(/.*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", report.changed_paths(path, r"^/(en|fr)/\d+(\?|$)", "utm_").alias("kind"))


@query(
    f"WITH {ORDERS_SQL} SELECT k AS key, 'warning' AS severity, 'moved ' || status AS message FROM o WHERE status = 'F' UNION ALL SELECT k, 'degraded', 'late' FROM o WHERE place = '1-URGENT' AND day < {TODAY_SQL}"
)
def health_accounting(spark, sf_dir):
    o = editions(spark, sf_dir)
    moved = quality.health(o, F.lit("warning"), "k", F.when(F.col("status") == "F", F.concat(F.lit("moved "), "status")))
    late = quality.health(o, F.lit("degraded"), "k", F.when((F.col("place") == "1-URGENT") & (F.col("day") < F.lit(TODAY)), "late"))
    return moved.unionByName(late).select("key", "severity", "message")


@query(
    f"WITH {ORDERS_SQL} SELECT cust AS key, CAST(year(day) AS INTEGER) AS year, count(*) AS n, 'not_checked' AS status FROM o WHERE status = 'P' GROUP BY cust, year(day)"
)
def audit_seed(spark, sf_dir):
    rows = editions(spark, sf_dir).filter("status = 'P'").groupBy(F.col("cust").alias("key"), F.year("day").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return rows.withColumn("status", F.lit("not_checked"))


@query("SELECT p_partkey FROM part WHERE (contains(lower(p_name), 'bolt') OR contains(lower(p_brand), 'bolt') OR contains(lower(p_type), 'bolt')) AND contains(p_type, 'PROMO')")
def publication_search(spark, sf_dir):
    return report.publication_search(table(spark, sf_dir, "part"), "p_name", "p_brand", "p_type", "p_type", "BOLT", "PROMO").select("p_partkey")


@query(
    """
    SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'exam' WHEN props IS NULL OR trim(props) = '' THEN '' WHEN contains(props, '1') THEN 'hands-on' WHEN contains(props, '2') THEN 'out' ELSE 'other' END AS badge FROM events
    """
)
def note_badges(spark, sf_dir):
    badge = report.note_badge(F.col("props"), F.col("event_type"), [("1", "hands-on"), ("2", "out")], {"purchase": "exam"}, "other")
    return table(spark, sf_dir, "events").select("event_id", badge.alias("badge"))


@query("SELECT p_partkey, 'year' AS via FROM part WHERE p_size = 7 UNION ALL SELECT p_partkey, 'text' FROM part WHERE contains(lower(p_name), 'cold')")
def year_tabs(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    chosen, found = report.tabs(p, ["p_name"], "", "p_size", "7"), report.tabs(p, ["p_name"], "Cold", "p_size", "7")
    return chosen.select("p_partkey", F.lit("year").alias("via")).unionByName(found.select("p_partkey", F.lit("text").alias("via")))


@query("SELECT doc_id, source FROM documents WHERE doc_id < 2")
def home_news(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter("doc_id < 2").select("doc_id", "source")


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n, min(o_orderkey) AS first_seen, count(DISTINCT o_custkey) AS speakers FROM orders GROUP BY 1")
def readings_by_year(spark, sf_dir):
    """Readings per distinct year by one aggregation, without a join to the list of years."""
    return table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_seen"), F.count_distinct("o_custkey").alias("speakers"))


@query("SELECT key, row_number() OVER (ORDER BY CAST(key AS BIGINT)) AS place FROM (SELECT CAST(o_orderkey AS VARCHAR) AS key FROM orders)")
def numeric_keys(spark, sf_dir):
    """Keys that are texts in the order of their numbers, numbered over all partitions."""
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("key"))
    return report.numbered_over_ranges(keys, [F.col("key").cast("bigint"), F.col("key")], "place").select("key", "place")


@query(
    """
    SELECT p_partkey, wanted FROM part, (SELECT unnest(['all', 'PROMO', 'ECONOMY']) AS wanted)
    WHERE wanted = 'all' OR (p_size > 5 AND contains(p_type, wanted))
    """
)
def section_filter(spark, sf_dir):
    """The rows of each section: featured ones stand in "all" alone."""
    p = table(spark, sf_dir, "part").withColumn("highlight", F.when(F.col("p_size") <= 5, 1))
    parts = [p.filter(report.section(F.col("highlight"), F.col("p_type"), w)).select("p_partkey", F.lit(w).alias("wanted")) for w in ("all", "PROMO", "ECONOMY")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    f"""
    WITH {WATCH_SQL}, a AS (SELECT 'o' || k AS title, year FROM r WHERE len(reasons) > 0 UNION ALL SELECT 'c' || c_custkey, 1999 FROM g)
    SELECT '{{"title":"' || title || '","year":' || year || ',"cause":"not_checked","attempted":[],"note":"{quality.SEEDED}"}}' AS value FROM a
    """
)
def audit_skeleton(spark, sf_dir):
    """The watchlist as the skeleton of an audit, in its file's form."""
    return records.json_lines(quality.audit_seed(_watched(spark, sf_dir), "title", "year"))


@query(
    f"""
    WITH {ORDERS_SQL} SELECT k, CASE WHEN status = 'F' THEN CAST(0.857 AS DOUBLE) END AS coverage, CASE WHEN status = 'F' THEN '' ELSE 'no label,other label' END AS reason FROM o
    """
)
def near_quotes(spark, sf_dir):
    """Quotes with one word that the page doesn't have: six tokens of seven in order are cover enough."""
    lines = _lines(spark, sf_dir).select(F.col("cust").alias("_cust"), F.array_join("lines", "\n").alias("_page"))
    pages = evidence.with_tokens(lines, "_page", "p").select("_cust", F.col("p_tokens").alias("page"))
    label = F.coalesce(*[F.when(F.col("status") == k, v) for k, v in LABELS.items()])
    quotes = editions(spark, sf_dir).select("k", "cust", F.lit("deadline").alias("field"), F.concat(F.lit("Our "), label, F.lit(": "), _said(F.col("day"))).alias("quote"), evidence.value_forms(F.lit("deadline"), F.col("day").cast("string")).alias("forms"))
    rows = evidence.with_tokens(quotes, "quote", "q").join(pages, F.col("cust") == F.col("_cust"))
    out = evidence.grounded(rows, "page", "q", "forms", "field")
    return out.select("k", "coverage", F.array_join("reasons", ",").alias("reason"))


@query("SELECT c_custkey, split_part(c_name, '#', 1) AS name, split_part(c_name, '#', 2) || c_mktsegment AS affiliation FROM customer WHERE c_acctbal > 0 UNION ALL SELECT c_custkey, c_name, '' FROM customer WHERE c_acctbal <= 0")
def name_and_place(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    said = F.when(F.col("c_acctbal") > 0, F.concat(F.split_part("c_name", F.lit("#"), F.lit(1)), F.lit(" ("), F.split_part("c_name", F.lit("#"), F.lit(2)), "c_mktsegment", F.lit(")"))).otherwise(F.col("c_name"))
    name, place = text.name_and_place(said)
    return c.select("c_custkey", name.alias("name"), place.alias("affiliation"))


@query(
    f"""
    WITH {SOURCES_SQL}, l AS (SELECT k, list(flag ORDER BY pos) FILTER (WHERE line = 'F') AS f FROM s GROUP BY k)
    SELECT k, CASE WHEN len(f) = 1 THEN f[1] WHEN len(f) > 1 THEN '[' || array_to_string(f, ', ') || ']' END AS written, coalesce(len(f), 0) AS n FROM l
    """
)
def scalar_or_list(spark, sf_dir):
    """A list read with its nulls left out and written as a scalar where it holds one."""
    flags = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.when(F.col("line") == "F", F.col("flag")).alias("flag")))), lambda x: x["flag"])
    rows = sources(spark, sf_dir).groupBy("k").agg(flags.alias("flags")).select("k", text.as_array(F.col("flags"), "array").alias("flags"))
    return rows.select("k", text.scalarised(F.col("flags")).alias("written"), F.size("flags").cast("bigint").alias("n"))


@query(
    f"""
    WITH {SOURCES_SQL}, r AS (SELECT k, pos, 'part ' || part AS c, row_number() OVER (PARTITION BY k ORDER BY pos DESC) AS age FROM s)
    SELECT k, string_agg(CASE WHEN age = 1 THEN c ELSE 'Earlier: ' || c END, '|' ORDER BY age) AS cited FROM r WHERE age <= 4 GROUP BY k
    """
)
def citations(spark, sf_dir):
    """The newest citation and the three before it."""
    all_ = F.transform(F.sort_array(F.collect_list(F.struct("pos", F.concat(F.lit("part "), "part").alias("c"))), False), lambda x: x["c"])
    rows = sources(spark, sf_dir).groupBy("k").agg(all_.alias("cs"))
    cover, rest = report.cover_and_rest(F.col("cs"))
    return rows.select("k", F.array_join(proposals.citations(cover, rest), "|").alias("cited"))


@query("SELECT p_partkey, CASE WHEN p_type NOT IN ('PROMO', 'ECONOMY') THEN p_type END AS venue FROM part")
def conditional_fields(spark, sf_dir):
    said = F.when(F.col("p_type") == "PROMO", "To appear").when(F.col("p_type") == "ECONOMY", "  ").otherwise(F.concat(F.lit(" "), "p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", text.shown(said).alias("venue"))


@query(
    """
    SELECT o_orderkey AS k, '<item><title>' || o_orderpriority || ' &amp; ' || o_orderstatus || '</title><description>one two ' || o_custkey || '...</description><pubDate>' || strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S')
           || ' +0000</pubDate><link>https://x.example/' || o_orderkey || '</link><guid isPermaLink="true">https://x.example/' || o_orderkey || '</guid></item>' AS item FROM orders
    """
)
def feed(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.concat("o_orderpriority", F.lit(" & "), "o_orderstatus").alias("title"), F.concat(F.lit("one  two "), "o_custkey", F.lit(" four")).alias("body"), F.col("o_orderdate").alias("at"), F.concat(F.lit("https://x.example/"), "o_orderkey").alias("link"))
    return records.feed_items(o, "title", "body", "at", "link", 3).select("k", "item")


@query("SELECT p_partkey, contains(p_type, 'PROMO') AND p_size > 10 AS awarded FROM part WHERE p_size > 10 OR p_size <= 5")
def award_badges(spark, sf_dir):
    """A badge by what a nested field says, for the records that have one."""
    p = table(spark, sf_dir, "part").filter((F.col("p_size") > 10) | (F.col("p_size") <= 5))
    link = F.struct(F.when(F.col("p_size") > 10, F.struct(F.concat(F.lit("Best paper Award: "), "p_type").alias("display"))).alias("link2"))
    rows = p.select("p_partkey", link.alias("paper"))
    return rows.select("p_partkey", report.awarded(F.col("paper.link2.display"), "PROMO").alias("awarded"))
