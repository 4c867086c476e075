"""Rules that the queries on the tables don't reach."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from tidemark.functions import dates, text
from tidemark.operators import clusters, evidence, matching, merge, proposals, quality, report
from tidemark.sources import records


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_gap_boundary_and_null_times(spark):
    rows = [(1, datetime(2026, 1, 1)), (2, datetime(2026, 1, 15)), (3, datetime(2026, 1, 29, 0, 0, 1)), (4, None), (5, None)]
    df = spark.createDataFrame([("a", i, t) for i, t in rows], "k string, i int, t timestamp")
    out = {r["i"]: r["cluster"] for r in clusters.gap_clusters(df, ["k"], "t", 14 * 86400, "i").collect()}
    assert out == {1: 1, 2: 1, 3: 2, 4: 3, 5: 4}


def test_merge_cluster_swaps_and_infers(spark):
    d = lambda n: datetime(2026, 1, n)
    rows = [("equal", 1, d(5), d(5), ""), ("swap", 1, d(9), d(5), "b"), ("swap", 2, None, None, "c"), ("infer", 2, None, d(1), " "), ("infer", 1, None, d(8), ""), ("apart", 1, None, d(1), "x"), ("apart", 2, None, d(31), "y")]
    df = spark.createDataFrame(rows, "k string, p int, a timestamp, b timestamp, note string")
    out = {r["k"]: (r["abstract"], r["paper"], r["note"], r["n_merged"], [x["p"] for x in r["sources"]]) for r in clusters.merge_clusters(df, ["k"], "a", "b", "p", "p", ["note"]).collect()}
    assert out == {"equal": (None, d(5), "", 1, [1]), "swap": (d(5), d(9), "b", 2, [1, 2]), "infer": (d(1), d(8), "", 2, [1, 2]), "apart": (None, d(31), "x", 2, [1, 2])}


def test_sources_keep_name_and_address_and_numeric_order(spark):
    rows = [("a", p, f"s{p}", f"u{p}", datetime(2026, 1, 1)) for p in (11, 2, 10, 1, 2)]
    df = spark.createDataFrame(rows, "k string, p int, name string, url string, t timestamp")
    out = clusters.merge_clusters(df.withColumn("a", F.lit(None).cast("timestamp")), ["k"], "a", "t", "p", "p", [], source=["name", "url"]).first()
    assert [tuple(x) for x in out["sources"]] == [(1, "s1", "u1"), (2, "s2", "u2"), (10, "s10", "u10"), (11, "s11", "u11")]


def test_dedupe_clusters_only_what_has_no_cycle_and_track(spark):
    at = lambda d: datetime(2026, 1, 1) + timedelta(days=d)
    rows = [("v", 1, "cycle 1", "", at(0)), ("v", 2, "Cycle 1", "", at(90)), ("v", 3, "", "Demo", at(0)), ("v", 4, "", "demo", at(60)), ("v", 5, "", "", at(0)), ("v", 6, "", "", at(14)), ("v", 7, "", "", at(29))]
    df = spark.createDataFrame(rows, "k string, p int, c string, t string, paper timestamp").withColumn("abstract", F.lit(None).cast("timestamp"))
    out = clusters.dedupe(df, ["k"], "c", "t", "abstract", "paper", "p", "p", [], [])
    assert {(r["part"], r["cluster"], r["n_merged"]) for r in out.collect()} == {("cycle 1", 1, 2), ("track:demo", 1, 2), ("main", 1, 2), ("main", 2, 1)}


def test_tracks_are_told_apart_for_some_venues_only(spark):
    t = lambda text_, venue: one(spark, clusters.track_of(F.lit(text_), venue=F.lit(venue)))
    assert [t("ICSE SEIP 2026", "ICSE"), t("ICSE journal-first", "ICSE"), t("CCS demos", "CCS"), t("FSE", "FSE")] == ["SEIP", "Journal First", "", ""]


@pytest.mark.parametrize(("day", "railed"), [(90, False), (91, True)])
def test_rail_boundary(spark, day, railed):
    a = F.array(F.lit(date(2026, 6, 1)))
    assert one(spark, merge.rail(a, F.array(F.date_add(F.lit(date(2026, 6, 1)), day)), date(2026, 1, 1))) is railed
    assert one(spark, merge.rail(a, F.array(F.date_add(F.lit(date(2026, 6, 1)), day)), date(2026, 7, 1))) is False


def test_null_pin_is_never_obsolete(spark):
    pairs = {"link": (F.lit(None).cast("string"), F.lit(None).cast("string"))}
    assert one(spark, merge.obsolete(F.array(F.lit("link")), pairs)) is False
    assert one(spark, merge.obsolete(F.array().cast("array<string>"), pairs)) is False


def test_merge_is_idempotent(spark):
    e = spark.createDataFrame([(1, "a", "p"), (2, "b", None)], "k int, x string, y string")
    c = spark.createDataFrame([(1, "n", None), (3, "m", "q")], "k int, x string, y string")
    o = spark.createDataFrame([(1, None, "z", ["x", "y"]), (4, "w", None, ["x"])], "k int, x string, y string, set_fields array<string>")
    once = merge.layered_merge(e, c, o, ["k"], ["x", "y"])
    again = merge.layered_merge(once.select("k", "x", "y"), c, o, ["k"], ["x", "y"])
    assert {r["change"] for r in again.collect()} == {"kept"}
    assert {(r["k"], r["x"], r["y"]) for r in once.collect()} == {(1, None, "z"), (2, "b", None), (3, "m", "q"), (4, "w", None)}


def test_merge_takes_real_values_whole_rows_and_keys(spark):
    schema = "k int, x string, y string"
    e = spark.createDataFrame([(1, "a", "p"), (2, "b", "q"), (None, "n", "n")], schema)
    c = spark.createDataFrame([(1, " tba", "new"), (2, "", "TBD"), (None, "m", None)], schema)
    none = spark.createDataFrame([], schema + ", set_fields array<string>")
    out = merge.layered_merge(e, c, none, ["k"], ["x", "y"]).collect()
    assert {(r["k"], r["x"], r["y"], r["change"]) for r in out} == {(1, "a", "new", "updated"), (2, "b", "q", "kept")}
    twice = spark.createDataFrame([(1, "a", "z"), (1, "b", "c")], schema)
    with pytest.raises(Exception, match="a key repeats in a layer"):
        merge.layered_merge(e, twice, none, ["k"], ["x", "y"]).collect()


def test_rail_withholds_upstream(spark):
    schema = "k int, place string, deadline array<string>"
    e = spark.createDataFrame([(k, "old", ["2026-06-01 23:59", "TBA"]) for k in (1, 2, 3, 4)] + [(5, "old", ["2025-06-01 23:59"])], schema)
    c = spark.createDataFrame([(1, "new", ["2026-09-01 23:59"]), (2, "new", ["2026-08-30 23:59"]), (3, "new", ["2027-06-01 23:59"]), (4, "new", ["TBA"]), (5, "new", ["2026-12-01 23:59"])], schema)
    o = spark.createDataFrame([(3, None, ["2026-06-02 23:59"], ["deadline"])], schema + ", set_fields array<string>")
    out = merge.layered_merge(e, c, o, ["k"], ["place", "deadline"], deadlines="deadline", as_of=date(2026, 1, 1)).collect()
    assert {(r["k"], r["place"], r["deadline"][0], r["change"], r["railed"]) for r in out} == {
        (1, "old", "2026-06-01 23:59", "railed", True), (2, "new", "2026-08-30 23:59", "updated", False), (3, "new", "2026-06-02 23:59", "updated", False),
        (4, "new", "2026-06-01 23:59", "updated", False), (5, "new", "2026-12-01 23:59", "updated", False),
    }


def test_canonical_records(spark):
    stamps = lambda *v: F.array(*[F.lit(x).cast("string") for x in v])
    form = lambda d, z: merge.canonical_record({"d": (d, "stamps"), "z": (z, "zone")})
    same = lambda a, b: one(spark, form(*a).eqNullSafe(form(*b)))
    null = F.lit(None).cast("string")
    assert same((stamps("2026-1-2T23:59:59", None), F.lit("AoE")), (stamps("2026-01-02 23:59"), F.lit("UTC-12")))
    assert same((F.lit(None).cast("array<string>"), null), (stamps(None), null))
    assert not same((stamps("2026-01-02 23:59"), F.lit("UTC")), (stamps("2026-01-02 23:59"), F.lit("UTC+9")))
    assert not same((stamps(None, "TBA"), null), (stamps("TBA"), null))


def test_zone_fallback_and_fixed_pacific(spark):
    z = lambda v: one(spark, dates.zone_id(F.lit(v).cast("string")))
    assert [z("PST"), z("PDT"), z("aoe"), z("UTC+5:30"), z("Mars/Base"), z(None), z("UTC+99")] == ["-08:00", "-07:00", "-12:00", "+05:30", "-12:00", "-12:00", "-12:00"]
    assert [z("UTC"), z("UTC+0"), z("UTC+18"), z("UTC+18:30"), z("UTC+5:75"), z("Europe/Paris"), z("Asia/Tokyo"), z("America/Chicago")] == ["+00:00", "+00:00", "+18:00", "-12:00", "-12:00", "Europe/Paris", "Asia/Tokyo", "America/Chicago"]
    assert one(spark, dates.instant(F.lit("2026-07-10 23:59"), F.lit("PST"))) == datetime(2026, 7, 11, 7, 59)
    assert one(spark, dates.displayed(dates.instant(F.lit("2026-07-10 23:59"), F.lit("UTC")))) == "2026-07-11 08:59"
    assert one(spark, dates.instant(F.lit("2026-07-10 23:59"), F.lit("Europe/Paris"))) == datetime(2026, 7, 10, 21, 59)
    known = lambda v: one(spark, dates.zone_known(F.lit(v).cast("string")))
    assert [known("Mars/Base"), known("Asia/Seoul"), known("AoE"), known(None)] == [False, True, True, True]


def test_date_ranges(spark):
    r = lambda v: one(spark, dates.date_range(F.lit(v)))
    assert tuple(r("March 30 − April 2, 2027")) == (date(2027, 3, 30), date(2027, 4, 2))
    assert tuple(r("Dec 30 - Jan 2, 2026")) == (date(2026, 12, 30), date(2027, 1, 2))
    assert tuple(r("Sept. 7, 2026.")) == (date(2026, 9, 7), date(2026, 9, 7))
    assert r("Feb 30, 2026") is None and r("Ma 3, 2026") is None and r("soon") is None


def test_hidden_and_struck_text_is_no_text(spark):
    html = "<!-- <li>April 1</li> --><p>May 2<br>x</p><s class='a'>June 3</s><del>July 4</del><span style='text-decoration:line-through'>Aug 5</span><b>Se</b>pt&amp;<script>1</script>"
    assert one(spark, text.unescape_html(text.strip_markup(F.lit(html)))).split() == ["May", "2", "x", "Sept&"]


def test_normalise(spark):
    flat = one(spark, text.flat(text.normalise(F.lit("Ｊuly 24th,​ 2026 – “ﬁnal”"))))
    assert flat == "july 24 2026 final"
    assert one(spark, text.tokens(F.lit("utc12 a 3"))) == ["utc", "12", "a", "3"]


def common(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_length(spark):
    rng = random.Random(3)
    pairs = [(list("abcd"), list("acd")), ([], ["a"]), (list("abcbdab"), list("bdcaba"))] + [([rng.choice("abcd") for _ in range(rng.randint(0, 12))], [rng.choice("abcd") for _ in range(rng.randint(0, 12))]) for _ in range(200)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<string>, b array<string>")
    assert [r["n"] for r in df.orderBy("i").select(text.lcs_length(F.col("a"), F.col("b")).alias("n")).collect()] == [common(a, b) for a, b in pairs]


def test_first_window(spark):
    """Windows against all of them tried one by one."""
    rng, rows = random.Random(5), []
    for i in range(120):
        page = [rng.choice("abcdefghij") for _ in range(rng.randint(5, 60))]
        at = rng.randrange(len(page))
        quote = [t for t in page[at : at + 12] if rng.random() > 0.08] or ["a"]
        rows.append((i, page, quote, rng.sample(range(len(page)), min(8, len(page)))))
    df = spark.createDataFrame(rows, "i int, page array<string>, quote array<string>, lows array<int>")
    hit = evidence.first_window(F.col("page"), F.col("quote"), F.col("lows"), evidence.window_size(F.size("quote")))
    found = 0
    for r in df.withColumn("hit", hit).collect():
        size = max(len(r["quote"]) + 10, int(len(r["quote"]) * 1.6))
        tried = [(low, common(r["quote"], r["page"][low : low + size]) / len(r["quote"])) for low in r["lows"]]
        want = next(((low, c) for low, c in tried if c >= 0.85), None)
        assert (r["hit"] and (r["hit"]["low"], r["hit"]["coverage"])) == want
        found += want is not None
    assert 20 < found < 120


@pytest.fixture(scope="module")
def call(spark):
    """A call for papers, with what is commented out and struck."""
    html = (
        "<!-- <li>Paper submission deadline: April 1, 2026</li> --><ul><li>Paper submission deadline: November 20th, 2026</li><li>Second round paper deadline: <s>May 3, 2027</s> May 5, 2027</li>"
        "<li>Notification: January 5, 2027</li></ul><p>Seoul, Korea. All times are anywhere on earth.</p><p>Workshop papers due: March 3, 2026</p>"
    )
    return spark.createDataFrame([("https://conf.example/cfp", html)], "url string, html string")


def verdict(spark, call, claims, action="upsert_manual", url="https://conf.example/cfp"):
    given = spark.createDataFrame([("x", action, url, claims)], f"id string, action string, source_url string, claims {evidence.CLAIMS}")
    r = evidence.gate(given, call, ["tracker.example"]).first()
    return r["status"], r["coverage"]


def claim(value, *quotes, scope=None):
    return (value, list(quotes), scope)


def test_gate_of_quotes(spark, call):
    quote = "Paper submission deadline – November 20, 2026"
    say = lambda value, *quotes, field="deadline": verdict(spark, call, {field: claim(value, *quotes)})[0]
    assert verdict(spark, call, {"deadline": claim(["2026-11-20 23:59"], "", quote)}) == ("VERIFIED", 1.0)
    assert say(["2026-11-21 23:59"], quote) == "UNCONFIRMED"  # the quote doesn't hold the value
    assert say(["2026-04-01 23:59"], "Paper submission deadline: April 1, 2026") == "UNCONFIRMED"  # commented out
    assert say(["2027-05-03 23:59"], "Second round paper deadline: May 3, 2027") == "UNCONFIRMED"  # struck
    assert say(["2027-01-05 23:59"], "Notification: January 5, 2027, paper deadline") == "UNCONFIRMED"  # another label leads
    assert say(["2026-03-03 23:59"], "Workshop papers due: March 3, 2026") == "UNCONFIRMED"
    assert say(["2026-11-20 23:59"], "November 20, 2026 deadline") == "UNCONFIRMED"  # hardly more than the date
    assert say(["2026-11-20 23:59"], quote + " Notification January 5, 2027") == "UNCONFIRMED"  # two dates
    assert say(["2026-11-20 23:59"]) == "UNCONFIRMED"
    assert say(["Seoul, Korea"], "Seoul, Korea. All times are anywhere on earth", field="place") == "VERIFIED"
    assert say(["AoE"], "All times are anywhere on earth", field="timezone") == "VERIFIED"
    assert say(["UTC+12"], "All times are anywhere on earth", field="timezone") == "UNCONFIRMED"


def test_gate_of_cycles_and_absences(spark, call):
    first, second = "Paper submission deadline: November 20, 2026", "Second round paper deadline: May 5, 2027"
    both = ["2026-11-20 23:59", "2027-05-05 23:59"]
    assert verdict(spark, call, {"deadline": claim(both, first, second)}) == ("VERIFIED", 1.0)
    assert verdict(spark, call, {"deadline": claim(both, first)})[0] == "UNCONFIRMED"  # each cycle needs its own
    assert verdict(spark, call, {"deadline": claim(["2026-11-20 23:59", "TBA"], first)})[0] == "UNCONFIRMED"
    block = "Paper submission deadline: November 20, 2026 Second round paper deadline: May 5, 2027 Notification: January 5, 2027"
    assert verdict(spark, call, {"abstract_deadline": claim(None, scope=block)})[0] == "VERIFIED"
    assert verdict(spark, call, {"abstract_deadline": claim(None, scope="these words are nowhere to be found on that page")})[0] == "UNCONFIRMED"
    assert verdict(spark, call, {"abstract_deadline": claim(None, scope="Notification: January 5, 2027")})[0] == "UNCONFIRMED"  # too short
    assert verdict(spark, call, {"place": claim(None, scope=block)})[0] == "UNCONFIRMED"  # no vocabulary


def test_gate_statuses(spark, call):
    good = {"deadline": claim(["2026-11-20 23:59"], "Paper submission deadline: November 20, 2026")}
    assert verdict(spark, call, {"note": claim(["two rounds"], "There will be two rounds")})[0] == "UNCHECKED"
    assert verdict(spark, call, good | {"note": claim(["x"], "y")})[0] == "VERIFIED"
    assert verdict(spark, call, good | {"place": claim(["Paris"], "Paris, France, all the time")})[0] == "UNCONFIRMED"
    assert verdict(spark, call, None)[0] == "MALFORMED" and verdict(spark, call, {})[0] == "MALFORMED" and verdict(spark, call, good, url=None)[0] == "MALFORMED"
    assert verdict(spark, call, good, url="https://www.tracker.example/cfp")[0] == "REJECTED_SOURCE"
    assert verdict(spark, call, good, url="https://conf.example/other")[0] == "UNREACHABLE"
    assert verdict(spark, call, None, action="delete_manual")[0] == "VERIFIED"


def test_passages_in_documents(spark):
    """The query on benchmark passages against every place of every document."""
    import re

    from tidemark.plans import registry

    sf = "/root/testdata/sf0.01"
    tokens = lambda t: re.findall(r"[a-z]+|\d+", re.sub(r"[^a-z0-9]+", " ", re.sub(r"(\d)(st|nd|rd|th)\b", r"\1", text.fold_text(t or ""))))
    quotes = {r["item_id"]: tokens(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        page = tokens(r["text"])
        heads: dict = {}
        for i in range(len(page) - 2):
            heads.setdefault(tuple(page[i : i + 3]), []).append(i)
        for item, q in quotes.items():
            for i in heads.get(tuple(q[:3]), []):
                if common(q, page[i : i + max(len(q) + 10, int(len(q) * 1.6))]) / len(q) >= 0.85:
                    want.add((item, r["doc_id"]))
    got = {(r["item_id"], r["doc_id"]) for r in registry.QUERIES["quote_grounding"](spark, sf).collect()}
    assert got == want and len(got) > 10


def test_first_alias_wins(spark):
    df = spark.createDataFrame([(1, "Asia  CCS"), (2, "ccs 2026"), (3, "successes"), (4, None), (5, "the Euro S&P"), (6, "")], "i int, t string")
    for most in (100, 0):  # inside the row, and joined by words
        out = {r["i"]: r["target"] for r in matching.alias_match(df, "i", "t", [("CCS", "CCS"), ("Asia CCS", "ASIACCS"), ("S&P", "S&P"), ("Euro S&P", "EUROSP")], most).collect()}
        assert out == {1: "CCS", 2: "CCS", 3: None, 4: None, 5: "S&P", 6: None}


def test_search_takes_one_field(spark):
    df = spark.createDataFrame([(1, "red fox", "x"), (2, "red", "fox"), (3, None, "a RED quick Fox")], "i int, a string, b string")
    assert [r["i"] for r in matching.search(df, ["a", "b"], "fox red", "i").collect()] == [1, 3]
    assert matching.search(df, ["a"], "", "i").count() == 0


def test_watchlist_and_validation_errors(spark):
    df = spark.createDataFrame([(1, True, True), (2, False, True), (3, False, None)], "k int, a boolean, b boolean")
    out = quality.watchlist(df, [("a", F.col("a")), ("b", F.col("b"))], ["k"]).collect()
    assert [(r["k"], r["reasons"], r["rank"]) for r in out] == [(1, "a,b", 0), (2, "b", 1)]


def test_citations_and_odd_lists(spark):
    cited = proposals.citations(F.lit("new"), F.array(*[F.lit(c) for c in "abcd"]))
    assert one(spark, cited) == ["new", "Earlier: a", "Earlier: b", "Earlier: c"]
    assert one(spark, proposals.citations(F.lit("new"), F.lit(None).cast("array<string>"))) == ["new"]
    assert [one(spark, text.as_array(F.lit(v).cast("string"))) for v in (None, "", "x")] == [[], [], ["x"]]
    assert one(spark, text.scalarised(F.array().cast("array<string>"))) is None
    name, place = text.name_and_place(F.lit("A. Person (Some Lab)"))
    assert (one(spark, name), one(spark, place)) == ("A. Person", "Some Lab")
    assert [r["k"] for r in report.by_number(spark.createDataFrame([("10",), ("9",), ("x",)], "k string"), "k").collect()] == ["9", "10", "x"]


def test_upsert_is_idempotent_and_capped(spark):
    o = spark.createDataFrame([(1, "a", None, ["x"])], "k int, x string, y string, set_fields array<string>")
    p = spark.createDataFrame([(1, None, "b", ["y"], False), (2, "n", None, ["x"], False), (3, "d", None, ["x"], True)], "k int, x string, y string, set_fields array<string>, delete boolean")
    once = proposals.upsert(o, p, ["k"], ["x", "y"])
    assert {(r["k"], r["x"], r["y"], tuple(r["set_fields"]), r["change"]) for r in once.collect()} == {(1, "a", "b", ("x", "y"), "changed"), (2, "n", None, ("x",), "added")}
    assert {r["change"] for r in proposals.upsert(once.drop("change"), p, ["k"], ["x", "y"]).collect()} == {"unchanged"}
    assert proposals.within_cap(once, 2) and not proposals.within_cap(once, 1)


def test_hosts(spark):
    ok = lambda u: one(spark, quality.admissible(F.lit(u), ["bad.org"], "/raw/"))
    assert [ok("https://good.org/a"), ok("https://bad.org"), ok("http://x.bad.org/a"), ok("https://notbad.org"), ok("ftp://good.org"), ok("https://good.org/raw/1"), ok("nothing")] == [True, False, False, True, False, False, False]


def test_sources(spark, tmp_path):
    (tmp_path / "l.txt").write_text("# head\n- a: 1\n  b: 2\n- a: 3\n")
    rows = records.blocks(records.read_texts(spark, str(tmp_path / "l.txt")), "path", "text").collect()
    assert [r["block"] for r in rows] == ["- a: 1\n  b: 2\n", "- a: 3\n"]
    good, failed = records.read_available(spark, {"a": str(tmp_path / "none")})
    assert not good and failed[0][0] == "a"
    (tmp_path / "d.json").write_text('{"schedule": [{"week": 1}, {"week": 2}]}')
    assert records.read_json_documents(spark, str(tmp_path / "d.json"), "schedule array<struct<week:int>>").select(F.explode("schedule.week")).count() == 2
    spark.createDataFrame([(1, "x", 2025), (2, "y", 2026)], "k int, v string, year int").write.partitionBy("year").parquet(str(tmp_path / "p"))
    assert {(r["k"], r["year"]) for r in records.read_partitions(spark, str(tmp_path / "p")).collect()} == {(1, 2025), (2, 2026)}
    parsed = records.parsed_documents(spark.createDataFrame([('{"week": 1}',), ("no json",)], "t string"), "t", "week int").collect()
    assert [r["document"] and r["document"]["week"] for r in parsed] == [1, None]
    config = spark.createDataFrame([("a", None, {"x": "1"}), ("b", ["y", "x"], {"y": "2"})], "k string, priority array<string>, sources map<string,string>")
    assert {r["k"]: r["priority"] for r in records.with_defaults(config, ["x", "y"]).collect()} == {"a": ["x"], "b": ["y"]}
    assert one(spark, records.expand_year(F.lit("%Y-%y"), F.lit(2026))) == "2025-2026"


def test_quotes_leave_the_page_behind(spark):
    """What is multiplied by the runs of a page doesn't hold the page."""
    import re

    from tidemark.plans import registry

    plan = registry.QUERIES["quote_grounding"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    (kept,) = re.findall(r"Generate .*\), \[([^\[\]]*)\], (?:true|false), \[", plan)
    assert re.findall(r"[a-z_]+", kept) == ["doc_id"]


def test_parts_grow_with_the_line_items(spark, monkeypatch):
    from tidemark.plans import base

    monkeypatch.setattr(base, "ITEMS", 100)
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert base.sources(spark, sf).rdd.getNumPartitions() == -(-n // 100)
