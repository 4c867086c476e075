"""Queries on dates, zones, names, search and page text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import clusters, enumerations, evidence, matching, pairing, quality
from tidemark.plans.base import ORDERS_SQL, SOURCES_SQL, TODAY, TODAY_SQL, editions, query, sources, table

#: Zones by the order's priority and status, each with its offset in SQL; names come with what DuckDB's own zone table says.
ZONES = (
    ("AoE", "-12:00"), ("PST", "-08:00"), ("PDT", "-07:00"), ("UTC+9", "+09:00"), ("UTC-05:30", "-05:30"), ("UTC", "+00:00"), ("UTC+18:30", "-12:00"), ("Mars/Base", "-12:00"), (None, "-12:00"), (" utc-12 ", "-12:00"), ("UTC+0", "+00:00"), ("utc+5:45", "+05:45"),
    *((z, z) for z in ("Asia/Seoul", "Europe/Paris", "Asia/Tokyo", "America/Chicago", "America/Los_Angeles", "Europe/London", "Australia/Sydney", "Asia/Kolkata", "America/Bogota", "Africa/Johannesburg", "Pacific/Auckland", "America/New_York")),
)
ZONE_SQL = f"[{', '.join('NULL' if z is None else repr(z) for z, _ in ZONES)}][1 + CAST(k % {len(ZONES)} AS INTEGER)]"
RESOLVED_SQL = f"[{', '.join(repr(r) for _, r in ZONES)}][1 + CAST(k % {len(ZONES)} AS INTEGER)]"


def _zone():
    return F.get(F.array(*[F.lit(z).cast("string") for z, _ in ZONES]), (F.col("k") % len(ZONES)).cast("int"))


@query(
    f"""
    WITH {ORDERS_SQL}, z AS (SELECT k, CAST(day AS TIMESTAMP) + INTERVAL 23 HOUR + INTERVAL 59 MINUTE AS t0, trim(coalesce({ZONE_SQL}, '')) AS zone, {RESOLVED_SQL} AS resolved FROM o),
    u AS (SELECT *, CASE WHEN resolved LIKE '%/%' THEN timezone('UTC', timezone(resolved, t0))
                         ELSE t0 - to_minutes(CASE WHEN resolved LIKE '-%' THEN -1 ELSE 1 END * (60 * CAST(resolved[2:3] AS INTEGER) + CAST(resolved[5:6] AS INTEGER))) END AS utc FROM z)
    SELECT k, resolved, strftime(utc, '%Y-%m-%d %H:%M') AS utc, strftime(utc + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M') AS shown,
           CASE zone WHEN 'AoE' THEN 'UTC-12' WHEN 'UTC' THEN 'UTC+0' ELSE zone END AS canonical, zone <> 'Mars/Base' AS known
    FROM u
    """
)
def zone_normalise(spark, sf_dir):
    rows = editions(spark, sf_dir).select("k", _zone().alias("zone"), F.concat(F.col("day").cast("string"), F.lit("T23:59:00")).alias("stamp"))
    rows = rows.select("k", "zone", dates.instant(F.col("stamp"), F.col("zone")).alias("at"))
    return rows.select(
        "k", dates.zone_id(F.col("zone")).alias("resolved"), F.date_format("at", "yyyy-MM-dd HH:mm").alias("utc"), dates.displayed(F.col("at")).alias("shown"), dates.canonical_zone(F.col("zone")).alias("canonical"), dates.zone_known(F.col("zone")).alias("known")
    )


FEED = ["AoE", "PT", "UTC", "UTC-8", "Etc/GMT+8", "Etc/UTC", "CET", ""]


@query(
    f"""
    WITH {ORDERS_SQL}, f AS (SELECT k, CASE k % 8 WHEN 0 THEN 'AoE' WHEN 1 THEN 'PT' WHEN 2 THEN 'UTC' WHEN 3 THEN 'UTC-8' WHEN 4 THEN 'Etc/GMT+8' WHEN 5 THEN 'Etc/UTC' WHEN 6 THEN 'CET' ELSE '' END AS z FROM o)
    SELECT k, CASE z WHEN 'AoE' THEN 'AoE' WHEN 'PT' THEN 'America/Los_Angeles' WHEN 'UTC' THEN 'UTC+0' WHEN 'UTC-8' THEN 'UTC-8' END AS fixed,
           CASE z WHEN '' THEN 'AoE' WHEN 'Etc/GMT+8' THEN 'UTC-8' WHEN 'Etc/UTC' THEN 'UTC+0' WHEN 'UTC' THEN 'UTC+0' ELSE z END AS named
    FROM f
    """
)
def feed_zones(spark, sf_dir):
    z = F.get(F.array(*map(F.lit, FEED)), (F.col("k") % len(FEED)).cast("int"))
    return editions(spark, sf_dir).select("k", dates.zone_of_fixed_feed(z).alias("fixed"), dates.zone_of_named_feed(z).alias("named"))


@query(
    f"""
    WITH {ORDERS_SQL}, r AS (SELECT k, day AS a, CAST(day + INTERVAL (k % 45) DAY AS DATE) AS b, place FROM o),
    t AS (SELECT *, CASE WHEN place = '1-URGENT' THEN make_date(year(a), month(a), least(day(b), 28)) ELSE make_date(year(a), month(b), day(b)) END AS said FROM r)
    SELECT k, CASE WHEN place <> '5-LOW' THEN a END AS start,
           CASE place WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN a ELSE CASE WHEN said < a THEN make_date(year(a) + 1, month(said), day(said)) ELSE said END END AS "end"
    FROM t
    """
)
def date_range_parse(spark, sf_dir):
    """Ranges within a month by days alone (an end before its start is in the next year), across months and years, single days, and none."""
    rows = editions(spark, sf_dir).withColumn("b", F.date_add("day", (F.col("k") % 45).cast("int")))
    a, b, year, say, lit = F.col("day"), F.col("b"), F.date_format("day", "yyyy"), F.date_format, F.lit
    said = (
        F.when(F.col("place") == "1-URGENT", F.concat(say(a, "MMMM d"), lit("-"), F.least(F.dayofmonth(b), lit(28)).cast("string"), lit(", "), year))
        .when(F.col("place") == "2-HIGH", F.concat(say(a, "MMMM d"), lit(" – "), say(b, "MMMM d"), lit(", "), year))
        .when(F.col("place") == "3-MEDIUM", F.concat(say(a, "MMM. d"), lit(" — "), say(b, "MMM d"), lit(" "), year, lit(".")))
        .when(F.col("place") == "4-NOT SPECIFIED", F.concat(lit("  "), F.upper(say(a, "MMM")), lit(" "), say(a, "d"), lit(",  "), year))
        .otherwise(F.concat(lit("early "), year))
    )
    return rows.select("k", dates.date_range(said).alias("r")).select("k", F.col("r.start").alias("start"), F.col("r.end").alias("end"))


@query(
    f"""
    WITH {ORDERS_SQL}
    SELECT k, CASE WHEN k % 6 < 3 THEN strftime(day, '%Y-%m-%d') || CASE k % 6 WHEN 0 THEN ' 09:05' ELSE ' 23:59' END END AS norm,
           CASE WHEN k % 6 < 4 THEN day END AS leading,
           CASE k % 6 WHEN 0 THEN strftime(day, '%Y-%m-%d') || ' 09:05' WHEN 1 THEN strftime(day, '%Y-%m-%d') || ' 23:59' WHEN 2 THEN strftime(day, '%Y-%m-%d') || ' 23:59'
                WHEN 3 THEN strftime(day, '%Y-%m-%d') WHEN 4 THEN 'tbd' ELSE '2024-02-30' END AS kept
    FROM o
    """
)
def norm_datetime(spark, sf_dir):
    day, k = F.date_format("day", "yyyy-MM-dd"), F.col("k") % 6
    raw = F.when(k == 0, F.concat(day, F.lit(" 9:05"))).when(k == 1, F.concat(day, F.lit("T23:59:59"))).when(k == 2, F.concat(day, F.lit(" 23:59"))).when(k == 3, day).when(k == 4, "tbd").otherwise("2024-02-30")
    return editions(spark, sf_dir).select("k", dates.norm_stamp(raw).alias("norm"), dates.leading_date(raw).alias("leading"), dates.kept_stamp(raw).alias("kept"))


@query(
    f"""
    WITH {ORDERS_SQL}
    SELECT k, CASE WHEN k % 3 = 0 THEN CAST(day - INTERVAL 7 DAY AS DATE) END AS abstract, date_trunc('week', day) = date_trunc('week', {TODAY_SQL}) AS this_week,
           CASE WHEN place IN ('1-URGENT', '2-HIGH') THEN place END AS known
    FROM o
    """
)
def derived_dates(spark, sf_dir):
    o = editions(spark, sf_dir)
    note = F.when(F.col("k") % 3 == 0, "Abstract is due 1 week before").otherwise("one week")
    paper = F.col("day").cast("timestamp")
    shown = F.when(F.col("place").isin("1-URGENT", "2-HIGH"), F.concat(F.lit("  "), "place")).when(F.col("k") % 2 == 0, " tba ").otherwise("")
    return o.select("k", F.to_date(dates.derived_abstract(paper, note)).alias("abstract"), dates.in_week_of(F.col("day"), TODAY).alias("this_week"), text.known(shown).alias("known"))


ALIASES = [("cold", "C"), ("large bolt", "LB"), ("bolt", "B"), ("widget", "W"), ("small", "S")]


@query(
    """
    SELECT p_partkey, CASE WHEN contains(t, ' cold ') THEN 'C' WHEN contains(t, ' large bolt ') THEN 'LB' WHEN contains(t, ' bolt ') THEN 'B' WHEN contains(t, ' widget ') THEN 'W' WHEN contains(t, ' small ') THEN 'S' END AS target
    FROM (SELECT p_partkey, ' ' || lower(p_name) || ' ' AS t FROM part)
    """
)
def alias_match(spark, sf_dir):
    return matching.alias_match(table(spark, sf_dir, "part"), "p_partkey", "p_name", ALIASES).select("p_partkey", "target")


@query("SELECT p_partkey, p_name FROM part WHERE (contains(lower(p_name), 'l') AND contains(lower(p_name), 'bolt')) OR (contains(lower(p_type), 'l') AND contains(lower(p_type), 'bolt')) ORDER BY p_partkey LIMIT 10")
def literal_search(spark, sf_dir):
    return matching.search(table(spark, sf_dir, "part"), ["p_name", "p_type"], "L bolt", "p_partkey").select("p_partkey", "p_name")


@query("SELECT p_partkey, p_name FROM part WHERE (regexp_matches(p_name, 's.*l.*w.*g', 'is') OR regexp_matches(p_brand, 's.*l.*w.*g', 'is')) AND NOT regexp_matches(p_brand, '#1') AND NOT regexp_matches(p_name, '#1') ORDER BY p_partkey LIMIT 10")
def fuzzy_search(spark, sf_dir):
    return matching.search(table(spark, sf_dir, "part"), ["p_name", "p_brand"], "slwg", "p_partkey", fuzzy=True, exclude=["#1"]).select("p_partkey", "p_name")


TRACKS = ((r"\beco", "Economy"), (r"promo", "Promo"), (r"widget", "Widget"))


@query(
    """
    SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'cycle 12' WHEN 1 THEN 'cycle 2' WHEN 2 THEN 'cycle 1' ELSE 'size ' || p_size END AS cycle,
           CASE WHEN contains(lower(p_type), 'eco') THEN 'Economy' WHEN contains(lower(p_type), 'promo') THEN 'Promo' WHEN contains(p_name, 'widget') THEN 'Widget' ELSE '' END AS track
    FROM part
    """
)
def cycle_and_track(spark, sf_dir):
    k = F.col("p_partkey") % 4
    said = F.when(k == 0, "Review Cycle 12").when(k == 1, "the 2nd cycle").when(k == 2, "First Cycle").otherwise("recycle")
    return table(spark, sf_dir, "part").select("p_partkey", clusters.cycle_of(F.col("p_name"), said, own=F.concat(F.lit("size "), "p_size")).alias("cycle"), clusters.track_of(F.concat_ws(" ", "p_type", "p_name"), TRACKS).alias("track"))


STRIP_SQL = """regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', ' ', 'gs'), '<script\\b.*?</script>', ' ', 'gis'), '<style\\b.*?</style>', ' ', 'gis'), '<svg\\b.*?</svg>', ' ', 'gis'),
    '<noscript\\b.*?</noscript>', ' ', 'gis'), '<template\\b.*?</template>', ' ', 'gis'), '<s\\b[^>]*>.*?</s>', ' ', 'gis'), '<del\\b[^>]*>.*?</del>', ' ', 'gis'), '<strike\\b[^>]*>.*?</strike>', ' ', 'gis'),
    '<(br|hr)\\s*/?>', chr(10), 'gi'), '</(p|div|li|tr|td|th|h[1-6]|section|article|table|dd|dt)\\s*>', chr(10), 'gi'),
    '</?(b|i|em|strong|span|u|a|sup|sub|small|mark|code|abbr|time|font)\\b[^>]*>', '', 'gi'), '<[^>]+>', ' ', 'g')""".replace("\\\\", "\\")


@query(f"WITH t AS (SELECT page_id, {STRIP_SQL} AS text FROM pages) SELECT page_id, length(text) AS n_chars, md5(text) AS digest FROM t")
def html_to_text(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", text.strip_markup(F.col("html")).alias("text"))
    return rows.select("page_id", F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


@query()
def normalise_tokens(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", text.flat(text.normalise(text.unescape_html(text.strip_markup(F.col("html"))))).alias("flat"))
    return rows.select("page_id", F.size(text.tokens(F.col("flat"))).cast("bigint").alias("n_tokens"), F.md5("flat").alias("digest"))


@query("SELECT c_custkey, replace(replace(replace(replace(replace('<' || c_name || '> & \"' || c_mktsegment || '\"''', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;') AS safe, 'No ' || c_custkey || ' in ' || c_mktsegment || ' {x}' AS filled, left('segment of the customer is ' || c_mktsegment, 30) || '…' AS short, right(c_name, 4) AS last FROM customer")
def text_forms(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    raw = F.concat(F.lit("<"), "c_name", F.lit('> & "'), "c_mktsegment", F.lit("\"'"))
    filled = text.fill_template("No {key} in {segment} {x}", {"key": F.col("c_custkey"), "segment": F.col("c_mktsegment")})
    short = text.shortened(F.concat(F.lit("segment of the customer is "), "c_mktsegment"), 30)
    return c.select("c_custkey", text.escape_html(raw).alias("safe"), filled.alias("filled"), short.alias("short"), F.right("c_name", F.lit(4)).alias("last"))


@query(
    "SELECT page_id, NOT (host = 'm.tionsh.example.net' OR host LIKE '%.example.org') AND NOT contains(url, 'page=2') AS ok FROM (SELECT page_id, url, lower(regexp_extract(url, '^https?://([^/?]+)', 1)) AS host FROM pages)"
)
def source_admissible(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", quality.admissible(F.col("url"), ["m.tionsh.example.net", "example.org"], "page=2").alias("ok"))


@query()
def quote_grounding(spark, sf_dir):
    """Benchmark passages as quotes without a value, and the documents that hold them from the quote's first three tokens on."""
    quotes = evidence.with_tokens(table(spark, sf_dir, "benchmark"), "text", "q").filter(F.size("q_tokens") >= evidence.LEAST_TOKENS)
    quotes = quotes.select("item_id", F.col("q_tokens").alias("quote"), F.array_join(F.slice("q_tokens", 1, 3), " ").alias("head"))
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    pages = evidence.with_tokens(documents, "text", "p").select("doc_id", F.col("p_tokens").alias("page"))
    # The runs of three tokens of a page meet the heads without the page; only documents that hold a head are looked at whole.
    starts = F.when(F.size("page") >= 3, F.sequence(F.lit(1), F.size("page") - 2))
    runs = F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice("page", i, 3), " ")))
    held = pages.select("doc_id", F.explode_outer(runs).alias("head")).join(quotes, "head").select("doc_id", "item_id", "head", "quote").distinct()
    rows = evidence.with_tokens(documents.join(held, "doc_id"), "text", "p")
    found = evidence.first_window(F.col("p_tokens"), F.col("quote"), evidence.places(F.col("p_tokens"), F.col("head")), evidence.window_size(F.size("quote")))
    # What found nothing goes after the aggregation: Spark would push a condition on it below the tokens and compute them at each place.
    by = rows.select("item_id", "doc_id", found.alias("hit")).groupBy("item_id", "doc_id").agg(F.round(F.min_by("hit.coverage", "hit.low"), 3).alias("coverage"))
    return by.filter("coverage IS NOT NULL")


@query(
    f"""
    WITH RECURSIVE {SOURCES_SQL}, f AS (SELECT k, list(flag ORDER BY pos) AS a FROM s GROUP BY k), p AS (SELECT x.k, x.a, y.a AS b FROM f x JOIN f y ON y.k = x.k + 1),
    r AS (SELECT k, a, b, 1 AS i, 1 AS j, [CAST(0 AS BIGINT)] AS cur, list_transform(range(len(b) + 1), lambda x: CAST(0 AS BIGINT)) AS before FROM p
          UNION ALL
          SELECT k, a, b, CASE WHEN j < len(b) THEN i ELSE i + 1 END, CASE WHEN j < len(b) THEN j + 1 ELSE 1 END,
                 CASE WHEN j < len(b) THEN list_append(cur, v) ELSE [CAST(0 AS BIGINT)] END, CASE WHEN j < len(b) THEN before ELSE list_append(cur, v) END
          FROM (SELECT *, CASE WHEN a[i] = b[j] THEN before[j] + 1 ELSE greatest(cur[j], before[j + 1]) END AS v FROM r WHERE i <= len(a)))
    SELECT k, before[len(b) + 1] AS common, len(a) AS n FROM r WHERE i > len(a)
    """
)
def lcs_coverage(spark, sf_dir):
    """Common subsequence of each order's flags with those of the next order, without a Python function."""
    s = sources(spark, sf_dir).groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "flag"))), lambda x: x["flag"]).alias("flags"))
    other = s.select((F.col("k") - 1).alias("k"), F.col("flags").alias("after"))
    return s.join(other, "k").select("k", text.lcs_length(F.col("flags"), F.col("after")).cast("bigint").alias("common"), F.size("flags").cast("bigint").alias("n"))


@query(
    f"""
    WITH {ORDERS_SQL}, d AS (SELECT k, day, lower(strftime(day, '%B')) AS name, CASE WHEN month(day) = 9 THEN 'sept' ELSE lower(strftime(day, '%b')) END AS short, CAST(month(day) AS VARCHAR) AS m, strftime(day, '%m') AS mm, CAST(year(day) AS VARCHAR) AS y,
                                    strftime(day, '%y') AS yy, unnest([CAST(day(day) AS VARCHAR), strftime(day, '%d')]) AS x FROM o),
    f AS (SELECT k, unnest([name || ' ' || x || ' ' || y, x || ' ' || name || ' ' || y, short || ' ' || x || ' ' || y, x || ' ' || short || ' ' || y, y || ' ' || mm || ' ' || strftime(day, '%d')]
                    || CASE WHEN day(day) > 12 THEN [m || ' ' || x || ' ' || y, mm || ' ' || x || ' ' || y, x || ' ' || m || ' ' || y, m || ' ' || x || ' ' || yy] ELSE [] END) AS form FROM d)
    SELECT k, string_agg(DISTINCT form, '|' ORDER BY form) AS forms FROM f GROUP BY k
    """
)
def date_surface_forms(spark, sf_dir):
    return editions(spark, sf_dir).select("k", F.array_join(dates.date_forms(F.col("day")), "|").alias("forms"))


#: Pages with dates in a table, in lists with and without separators, and in flowing text, by their number; d0 to d22 are days.
DATED_SQL = """d AS (SELECT page_id, page_id % 6 AS layout, DATE '2026-01-01' + CAST(page_id % 300 AS INTEGER) AS d0 FROM pages)"""


def _dated_pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "html", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 300).cast("int")).alias("d0"))
    day = lambda n: F.date_format(F.date_add("d0", n), "MMMM d, yyyy")
    head = "<h2>Dates</h2><table><tr><th>Event<th>Date<th>Track</tr><tr><td>Paper submission deadline<td>"
    layouts = [
        (head, 0, "<td>main</tr><tr><td>Notification<td>", 9, "<td>late</tr></table>"),
        ("<ul><li>", 0, ": Paper submission deadline</li><li><b>Abstract</b>: <s>", 0, "</s> ", 5, "</li></ul>"),
        ("<ol><li>", 0, " camera ready<li>", 3, " papers due</ol>"),
        ("<ol><li>", 0, " camera ready<li>papers due ", 3, "</ol>"),
        ("<p>The papers due date of this year is ", 0, ".</p><p>Conference dates: ", 20, " to ", 22, ".</p>"),
        ("<p>The abstract, as we have said so often in the past years, is due on ", 0, "</p>"),
    ]
    said = F.lit("")
    for i, parts in enumerate(layouts):
        said = F.when(F.col("page_id") % len(layouts) == i, F.concat(*[day(x) if isinstance(x, int) else F.lit(x) for x in parts])).otherwise(said)
    return p.select("page_id", "d0", F.replace("html", F.lit("</article>"), F.concat(said, F.lit("</article>"))).alias("html"))


@query(
    f"""
    WITH {DATED_SQL}, r(layout, rule, field, scope, n, until, outcome, reason) AS (VALUES
        (0, 'A', 'deadline', 'track=main', 0, NULL, 'paired', ''), (0, 'A', 'other', 'track=late', 9, NULL, 'paired', ''),
        (1, 'B', 'deadline', '', 0, NULL, 'paired', ''), (1, 'B', 'abstract_deadline', '', 5, NULL, 'paired', ''), (1, '', 'abstract_deadline', '', 0, NULL, 'superseded', ''),
        (2, 'C', 'other', '', 0, NULL, 'paired', ''), (2, 'C', 'deadline', '', 3, NULL, 'paired', ''), (3, 'C', 'other', '', 0, NULL, 'refused', 'no order'), (3, 'C', 'deadline', '', 3, NULL, 'refused', 'no order'),
        (4, 'D', 'deadline', '', 0, NULL, 'paired', ''), (4, 'D', 'date', '', 20, 22, 'paired', ''), (5, 'D', 'abstract_deadline', '', 0, NULL, 'refused', 'too far'))
    SELECT page_id, rule, field, scope, d0 + n AS day, d0 + until AS until, outcome, reason FROM d JOIN r USING (layout)
    """
)
def date_pairing(spark, sf_dir):
    """Labels and dates of pages, paired or refused by the structure around them."""
    return pairing.paired(_dated_pages(spark, sf_dir)).select("page_id", "rule", "field", "scope", "day", "until", "outcome", "reason")


@query(
    f"""
    WITH {DATED_SQL}, f(field, good) AS (VALUES ('deadline', 1), ('abstract_deadline', -1))
    SELECT page_id, field, d0 AS day, CASE WHEN field = 'deadline' AND layout IN (1, 4) THEN 'VERIFIED' WHEN field = 'abstract_deadline' AND layout = 1 THEN 'REFUTED' ELSE 'UNCONFIRMED' END AS status FROM d, f
    """
)
def pairing_verdicts(spark, sf_dir):
    """Claims on the fields of a page against its pairs: struck dates refute."""
    pages = _dated_pages(spark, sf_dir)
    claims = pages.select("page_id", F.explode(F.array(F.lit("deadline"), F.lit("abstract_deadline"))).alias("field"), F.col("d0").alias("day"), F.lit(None).cast("string").alias("scope"))
    return pairing.proposal_pairing(claims, pairing.paired(pages)).drop("scope")


#: Lists of milestones after a page's own text, by the page's number, and why each doesn't show that there is no abstract deadline.
LISTED_SQL = """d AS (SELECT page_id, page_id % 7 AS layout, DATE '2026-01-01' + CAST(page_id % 300 AS INTEGER) AS d0 FROM pages)"""
NO_ABSTRACT = ("", "few milestones", "listed", "near a date", "no anchor", "out of range", "no list")


def _listed_pages(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "html", F.date_add(F.lit("2026-01-01").cast("date"), (F.col("page_id") % 300).cast("int")).alias("d0"))
    paper, told, ready, abstract = ((f"<li>{x}: ", n, "</li>") for x, n in (("Paper submission", 0), ("Notification", 40), ("Camera ready", 70), ("Abstract", -7)))
    layouts = [
        ("<ul>", *paper, *told, *ready, "</ul>"), ("<ul>", *paper, *told, "<li>Opening: ", 70, "</li></ul>"), ("<ol>", *abstract, *paper, *told, *ready, "</ol>"), ("<ul>", *paper, *told, *ready, "</ul><p>An abstract is needed too.</p>"),
        ("<ul><li>Papers: ", 0, "</li>", *told, *ready, "</ul>"), ("<ul>", *paper, *told, "<li>Poster: ", 400, "</li></ul>"), ("<ul>", *paper, *told, "</ul>"),
    ]
    day = lambda n: F.date_format(F.date_add("d0", n), "MMMM d, yyyy")
    said = F.lit("")
    for i, parts in enumerate(layouts):
        said = F.when(F.col("page_id") % len(layouts) == i, F.concat(*[day(x) if isinstance(x, int) else F.lit(x) for x in parts])).otherwise(said)
    return p.select("page_id", "d0", F.replace("html", F.lit("</article>"), F.concat(said, F.lit("</article>"))).alias("html"))


@query(
    f"""
    WITH {LISTED_SQL}, r AS (SELECT page_id, d0, [{', '.join(map(repr, NO_ABSTRACT))}][1 + CAST(layout AS INTEGER)] AS reason FROM d)
    SELECT page_id, d0 AS deadline, reason = '' AS supported, reason FROM r
    """
)
def structural_absence(spark, sf_dir):
    """Whether a page's list of milestones shows that it has no abstract deadline."""
    pages = _listed_pages(spark, sf_dir)
    claims = pages.select("page_id", F.lit("abstract_deadline").alias("field"), F.col("d0").alias("deadline"), F.date_add("d0", 120).alias("ends"))
    return enumerations.structural_absence(claims, pages).select("page_id", "deadline", "supported", "reason")


@query(
    r"""
    WITH t AS (SELECT doc_id, trim(regexp_replace(lower(regexp_replace(coalesce(text, ''), '[^\x00-\x7F]+', ' ', 'g')), '\s+', ' ', 'g')) AS plain FROM documents),
    f AS (SELECT doc_id, trim(regexp_replace(regexp_replace(plain, '(\d)(st|nd|rd|th)\b', '\1', 'g'), '[^a-z0-9]+', ' ', 'g')) AS flat FROM t)
    SELECT doc_id, md5(flat) AS digest, len(regexp_extract_all(flat, '[a-z]+|\d+')) AS n_tokens FROM f
    """
)
def plain_tokens(spark, sf_dir):
    """Normal form, flat form and tokens of the part of a text that folding leaves alone."""
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), r"[^\x00-\x7F]+", " ")
    rows = table(spark, sf_dir, "documents").select("doc_id", text.flat(text.normalise(plain)).alias("flat"))
    return rows.select("doc_id", F.md5("flat").alias("digest"), F.size(text.tokens(F.col("flat"))).cast("bigint").alias("n_tokens"))
