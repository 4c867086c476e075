"""Queries on lookups, loaders and sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import dates, text
from tidemark.operators import evidence, matching, merge, proposals
from tidemark.plans.base import LAYERS_SQL, ORDERS_SQL, editions, layers, query, table
from tidemark.plans.reports import VERDICT_SQL, _lines
from tidemark.plans.texts import ZONE_SQL, _zone
from tidemark.sources import landing, records, versions


@query(
    """
    WITH w AS (SELECT page_id, url, lower(regexp_extract(url, '^https?://([^/?#]+)', 1)) AS host FROM pages),
    l AS (SELECT sha1(url) AS name, 'p' || page_id AS body FROM w WHERE url LIKE 'https:%' UNION ALL SELECT host, 'h' || min(page_id) FROM w WHERE host LIKE '%.net' GROUP BY 1)
    SELECT page_id, coalesce(min(a.body), min(b.body)) AS page FROM w LEFT JOIN l a ON a.name = sha1(w.url) LEFT JOIN l b ON b.name = w.host GROUP BY page_id
    """
)
def landed_page(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.lower(F.try_parse_url("url", F.lit("HOST"))).alias("host"))
    exact = p.filter("url LIKE 'https:%'").select(F.sha1("url").alias("name"), F.concat(F.lit("p"), "page_id").alias("body"))
    other = p.filter("host LIKE '%.net'").groupBy(F.col("host").alias("name")).agg(F.concat(F.lit("h"), F.min("page_id")).alias("body"))
    return evidence.landed_page(p, exact.unionByName(other), "url", "name", "body").groupBy("page_id").agg(F.min("page").alias("page"))


@query(
    f"""
    WITH {ORDERS_SQL}, z AS (SELECT k, trim(coalesce({ZONE_SQL}, '')) AS c FROM o)
    SELECT k, CASE WHEN c = 'AoE' THEN 'aoe|anywhere on earth|utc-12|gmt-12' WHEN c IN ('UTC', 'UTC+0') THEN 'utc|gmt|utc+0|zulu' WHEN c = 'America/Los_Angeles' THEN 'pst|pdt|pacific time|america/los_angeles' ELSE lower(c) END AS forms FROM z
    """
)
def zone_surface_forms(spark, sf_dir):
    return editions(spark, sf_dir).select("k", F.array_join(evidence.zone_forms(dates.canonical_zone(_zone())), "|").alias("forms"))


@query(
    f"""
    WITH {ORDERS_SQL}, r AS (SELECT k, place AS title, CASE WHEN k % 10 <> 0 THEN CAST(year(day) AS INTEGER) END AS year FROM o WHERE status <> 'P')
    SELECT k, CASE WHEN title = '5-LOW' THEN 'unknown title' WHEN year IS NULL THEN 'no year' WHEN row_number() OVER (PARTITION BY title, year ORDER BY k) > 1 THEN 'repeated' END AS reason FROM r
    """
)
def override_loader(spark, sf_dir):
    o = editions(spark, sf_dir)
    given = o.filter("status <> 'P'").select("k", F.col("place").alias("title"), F.when(F.col("k") % 10 != 0, F.year("day")).alias("year"))
    return records.checked_overrides(given, o.filter("place <> '5-LOW'").select(F.col("place").alias("title")), "title", "year", "k").select("k", "reason")


@query("SELECT n_regionkey, '[' || string_agg('{\"n_nationkey\":' || n_nationkey || ',\"n_name\":\"' || n_name || '\"}', ',' ORDER BY n_nationkey) || ']' AS content FROM nation GROUP BY n_regionkey")
def search_index(spark, sf_dir):
    return records.search_index(table(spark, sf_dir, "nation"), ["n_regionkey"], "n_nationkey", ["n_nationkey", "n_name"])


@query(
    f"""
    WITH {ORDERS_SQL}, r AS (SELECT k, day AS a, CASE k % 3 WHEN 0 THEN day WHEN 1 THEN CAST(day + INTERVAL 40 DAY AS DATE) END AS b FROM o)
    SELECT k, coalesce(a <> b, FALSE) AS moved, b AS start FROM r
    """
)
def date_change_warning(spark, sf_dir):
    say = lambda d: F.date_format(d, "MMM d, yyyy")
    o = editions(spark, sf_dir).withColumn("old", say("day")).withColumn("new", F.when(F.col("k") % 3 == 0, say("day")).when(F.col("k") % 3 == 1, say(F.date_add("day", 40))).otherwise("soon"))
    o = o.select("k", "old", "new", dates.date_range(F.col("old")).alias("a"), dates.date_range(F.col("new")).alias("b"))
    kept = merge.kept_range(F.col("a"), F.col("b"), F.col("old") == F.col("new"))
    return o.select("k", merge.date_change(F.col("a"), F.col("b")).alias("moved"), kept["start"].alias("start"))


@query(
    f"""
    WITH {LAYERS_SQL} SELECT 'union' AS kind, count(*) AS n FROM (SELECT k FROM e UNION SELECT k FROM c UNION SELECT k FROM m)
    UNION ALL SELECT 'difference', count(*) FROM (SELECT k FROM m EXCEPT SELECT k FROM e) UNION ALL SELECT 'bag', count(*) FROM (SELECT k FROM m UNION ALL SELECT k FROM e)
    """
)
def set_operations(spark, sf_dir):
    e, c, m = (d.select("k") for d in layers(spark, sf_dir))
    parts = {"union": e.union(c).union(m).distinct(), "difference": m.exceptAll(e).distinct(), "bag": m.unionByName(e)}
    out = None
    for kind, df in parts.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query(
    f"""
    WITH {ORDERS_SQL}, f AS (SELECT k, CAST(year(day) AS INTEGER) AS stored, CAST(year(CAST(day + INTERVAL 30 DAY AS DATE)) AS INTEGER) AS year, place FROM o)
    SELECT year, place, count(*) AS n, count(CASE WHEN stored <> year THEN 1 END) AS refiled FROM f GROUP BY year, place
    """
)
def refiled(spark, sf_dir):
    o = editions(spark, sf_dir).select(F.year("day").alias("stored"), F.year(F.date_add("day", 30)).alias("year"), "place")
    return o.groupBy("year", "place").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("stored") != F.col("year")).alias("refiled"))


#: Orders by year as a table's first run has them, and as a second one does: moved to another year, left out, or without a year.
RUNS_SQL = f"""{ORDERS_SQL}, a AS (SELECT k, place, CAST(year(day) AS INTEGER) AS year FROM o),
    b AS (SELECT k, place, CAST(CASE WHEN year(day) = 1993 AND month(day) = 12 THEN 1994 WHEN year(day) = 1996 AND status = 'O' THEN NULL ELSE year(day) END AS INTEGER) AS year
          FROM o WHERE year(day) <> 1992 AND NOT (year(day) = 1997 AND place = '5-LOW'))"""


def _two_runs(spark, sf_dir) -> str:
    """The folder of a table that both runs, and a third one without a difference, have written."""
    o, year, path = editions(spark, sf_dir), F.year("day"), versions.scratch(spark)
    second = F.when((year == 1993) & (F.month("day") == 12), 1994).when((year == 1996) & (F.col("status") == "O"), None).otherwise(year)
    before = o.select("k", "place", year.alias("year"))
    after = o.filter((year != 1992) & ~((year == 1997) & (F.col("place") == "5-LOW"))).select("k", "place", second.cast("int").alias("year"))
    for run in (before, after, after):
        versions.write_version(run, path, ["year"])
    return path


@query(f"WITH {RUNS_SQL} SELECT k, place, year FROM b")
def versioned_table(spark, sf_dir):
    """A table after two runs that move, leave out and null records."""
    return versions.read_version(spark, _two_runs(spark, sf_dir))


@query(
    f"""
    WITH {RUNS_SQL}, y AS (SELECT DISTINCT year FROM (SELECT year FROM a UNION ALL SELECT year FROM b)),
    n AS (SELECT y.year, (SELECT count(*) FROM a WHERE a.year IS NOT DISTINCT FROM y.year) AS before, (SELECT count(*) FROM b WHERE b.year IS NOT DISTINCT FROM y.year) AS n,
                 (SELECT count(*) FROM a WHERE a.year IS NOT DISTINCT FROM y.year AND EXISTS (SELECT 1 FROM b WHERE b.k = a.k AND b.year IS NOT DISTINCT FROM a.year)) AS same FROM y)
    SELECT year, n, CASE WHEN before = 0 THEN 'created' WHEN n = 0 THEN 'removed' WHEN n = same AND before = same THEN 'kept' ELSE 'updated' END AS state FROM n
    """
)
def version_changes(spark, sf_dir):
    """What the second run has done to each partition."""
    return versions.changes(spark, _two_runs(spark, sf_dir))


def _landed(spark, sf_dir):
    """Orders landed twice by year, the second time with one file that breaks off: the records of that scan, and the table in versions."""
    folder, store = versions.scratch(spark), versions.scratch(spark)
    o = editions(spark, sf_dir).select("k", "place", F.year("day").alias("year"))
    lines = lambda c: o.select(F.to_json(F.struct("k", c.alias("place"))).alias("value"), "year")
    lines(F.col("place")).repartition("year").write.partitionBy("year").text(f"{folder}/1")
    read = lambda n: landing.scanned_files(spark, f"{folder}/{n}", "k bigint, place string", ["k"])
    landing.refreshed(read(1), store, ["year"])
    changed = lines(F.concat("place", F.lit("!"))).filter("year <> 1992")
    half = F.when((F.col("year") == 1995) & (F.get_json_object("value", "$.k").cast("bigint") % 100 == 7), F.left("value", F.lit(6))).otherwise(F.col("value"))
    changed.withColumn("value", half).repartition("year").write.partitionBy("year").text(f"{folder}/2")
    found = read(2)
    landing.refreshed(found, store, ["year"])
    return found, store


@query(f"WITH {ORDERS_SQL} SELECT k, CASE WHEN year(day) = 1995 THEN place ELSE place || '!' END AS place, CAST(year(day) AS INTEGER) AS year FROM o WHERE year(day) <> 1992")
def landed_table(spark, sf_dir):
    """A refresh from landed files: the partition of the broken one keeps what was there."""
    return versions.read_version(spark, _landed(spark, sf_dir)[1])


@query(f"WITH {ORDERS_SQL} SELECT 1995 AS year, count(*) AS n_bad, 'unreadable record' AS reason FROM o WHERE year(day) = 1995 AND k % 100 = 7 HAVING count(*) > 0")
def landed_broken(spark, sf_dir):
    """The files that are set aside."""
    return landing.broken_files(_landed(spark, sf_dir)[0]).select("year", "n_bad", "reason")


@query("SELECT 'orders' AS name, TRUE AS ok, count(*) AS n FROM orders UNION ALL SELECT 'pages', TRUE, count(*) FROM pages UNION ALL SELECT 'nowhere', FALSE, 0")
def scan_report(spark, sf_dir):
    """Sources of which one can't be read: the others are used, and the failure is told."""
    good, failed = records.read_available(spark, {name: f"{sf_dir}/{name}.parquet" for name in ("orders", "pages", "nowhere")})
    return records.scanned(good, failed, spark)


@query(f"WITH {ORDERS_SQL} SELECT k, 'Jan ' || (year(day) - 1) || ' / ' || year(day) || ' ' || place AS said FROM o")
def template_years(spark, sf_dir):
    return editions(spark, sf_dir).select("k", records.expand_year(F.concat(F.lit("Jan %Y / %y "), "place"), F.year("day")).alias("said"))


@query(
    """
    SELECT c_custkey, nth, '- title: ' || c_name || chr(10) || '  part: ' || nth || chr(10) AS block FROM customer, (SELECT unnest([0, 1, 2]) AS nth) WHERE nth < CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 3 ELSE 2 END
    """
)
def list_blocks(spark, sf_dir):
    """Raw blocks of list files: what stands before the first is left out, line ends are kept."""
    c = table(spark, sf_dir, "customer")
    n = F.when(F.col("c_mktsegment") == "BUILDING", 1).when(F.col("c_mktsegment") == "MACHINERY", 3).otherwise(2)
    part = lambda i: F.concat(F.lit("- title: "), "c_name", F.lit("\n  part: "), i.cast("string"), F.lit("\n"))
    said = F.concat(F.lit("# a head - with a dash\n"), F.array_join(F.transform(F.sequence(F.lit(0), n - 1), part), ""))
    return records.blocks(c.withColumn("said", said), "c_custkey", "said").select("c_custkey", "nth", "block")


@query(
    """
    SELECT n_nationkey, CASE WHEN n_nationkey < 10 THEN 'b' WHEN n_nationkey < 20 THEN 'a,b' ELSE '' END AS priority FROM nation
    """
)
def config_defaults(spark, sf_dir):
    """A dimension's own priority or the default one, less the sources that it doesn't map."""
    n, key = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    own = F.when(key < 10, F.array(F.lit("b"), F.lit("c")))
    maps = F.when(key < 10, F.create_map(F.lit("b"), F.lit("1"))).when(key < 20, F.create_map(F.lit("b"), F.lit("1"), F.lit("a"), F.lit("2"))).otherwise(F.create_map(F.lit("x"), F.lit("3")))
    rows = records.with_defaults(n.select("n_nationkey", own.alias("priority"), maps.alias("sources")), ["a", "b"])
    return rows.select("n_nationkey", F.array_join("priority", ",").alias("priority"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_documents(spark, sf_dir):
    rows = records.parsed_documents(table(spark, sf_dir, "events"), "props", "k bigint")
    return rows.select("event_id", F.col("document.k").alias("k"))


@query("SELECT event_id, kind FROM events JOIN (VALUES ('click', 'browse'), ('view', 'browse'), ('purchase', 'deal')) AS t(event_type, kind) USING (event_type)")
def inline_table(spark, sf_dir):
    kinds = spark.createDataFrame([("click", "browse"), ("view", "browse"), ("purchase", "deal")], "event_type string, kind string")
    return table(spark, sf_dir, "events").join(kinds, "event_type").select("event_id", "kind")


@query(
    f"""
    WITH {VERDICT_SQL}, d AS (SELECT cust, count(DISTINCT day) AS n FROM o GROUP BY cust) SELECT cust, n AS n_dates FROM d
    """
)
def date_counts(spark, sf_dir):
    """Different dates in the text of a customer's page; one line each, so that no line's numbers are near another's month."""
    lines = F.array_join(F.transform("lines", lambda x: F.concat(F.lit("call of papers "), x, F.lit(" for all of us"))), " ")
    rows = evidence.with_tokens(_lines(spark, sf_dir).select("cust", lines.alias("t")), "t", "p")
    return rows.select("cust", evidence.n_dates(F.col("p_flat")).cast("bigint").alias("n_dates"))


@query("SELECT p_partkey, strpos(' ' || lower(p_name) || ' ', ' bolt ') AS word, strpos(lower(p_name), 'old bo') AS phrase FROM part")
def label_positions(spark, sf_dir):
    at = lambda label: evidence.label_at(F.lower("p_name"), F.lit(label)).cast("bigint")
    return table(spark, sf_dir, "part").select("p_partkey", at("bolt").alias("word"), at("old bo").alias("phrase"))


@query(f"WITH {LAYERS_SQL}, p AS (SELECT k FROM o WHERE day(day) <= 5) SELECT 'all' AS which, count(*) <= 8 AS fits FROM p UNION ALL SELECT 'few', count(*) <= 8 FROM (SELECT k FROM p ORDER BY k LIMIT 8)")
def change_cap(spark, sf_dir):
    """Whether a run's changes are few enough to be made at all."""
    _, _, m = layers(spark, sf_dir)
    rows = m.select("k", F.lit("added").alias("change"))
    said = [("all", proposals.within_cap(rows)), ("few", proposals.within_cap(rows.orderBy("k").limit(8)))]
    return spark.createDataFrame(said, "which string, fits boolean")


@query(
    """
    SELECT p_partkey, array_to_string(split(p_name, ' ')[1:1], ' ') || CASE WHEN len(split(p_name, ' ')) > 1 THEN '...' ELSE '' END AS short, upper(p_type[1:1]) || lower(p_type[2:]) AS title, '/x/' || p_partkey AS url,
           array_to_string(list_reverse(list_sort(list_distinct(list_append(split(p_name, ' '), 'zz')))), ',') AS words, CAST(p_size // 2 AS INTEGER) AS half, p_brand[7:] AS tail FROM part
    """
)
def template_filters(spark, sf_dir):
    """What the site's templates do to texts and lists."""
    words = F.sort_array(F.array_distinct(F.array_append(F.split("p_name", " "), F.lit("zz"))), False)
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.truncated_words(F.col("p_name"), 1).alias("short"), text.capitalised(F.col("p_type")).alias("title"), F.concat(F.lit("/x/"), "p_partkey").alias("url"),
        F.array_join(words, ",").alias("words"), F.floor(F.col("p_size") / 2).cast("int").alias("half"), F.substr("p_brand", F.lit(7)).alias("tail"),
    )


@query(
    """
    SELECT p_partkey, CASE WHEN contains(t, ' cold ') THEN 'C' WHEN contains(t, ' large bolt ') THEN 'LB' WHEN contains(t, ' bolt ') THEN 'B' WHEN contains(t, ' widget ') THEN 'W' WHEN contains(t, ' small ') THEN 'S' END AS target
    FROM (SELECT p_partkey, ' ' || lower(p_name) || ' ' AS t FROM part)
    """
)
def alias_join(spark, sf_dir):
    """The alias match for lists too long to be sent along: an equality join on runs of words."""
    aliases = [("cold", "C"), ("large bolt", "LB"), ("bolt", "B"), ("widget", "W"), ("small", "S")]
    return matching.alias_match(table(spark, sf_dir, "part"), "p_partkey", "p_name", aliases, most=0).select("p_partkey", "target")
