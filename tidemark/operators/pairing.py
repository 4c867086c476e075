"""Which label a date on a page belongs to, by the structure that both stand in.

Markup becomes a table of pieces, and a piece's place in it comes from windows over the page: the depth of
lists and tables is a running count, the list around a piece is the last one that opened at its depth, items and
cells are running counts in that. Pieces make units: an item of a list, a row of a table, a term with its
descriptions, or a block of flowing text. A unit's dates, labels and separators are found among its tokens, and
the first rule that applies pairs or refuses them:

A, a table whose head names one column for dates and one for labels; the other columns are the pair's scope;
B, an item that one separator splits into dates and labels, either way round (a term is split from its descriptions);
C, items without a separator, in the order of the two that all items of the list agree on, if at least two have both;
D, in any other text, the nearest label, if it is near, clearly nearer than one on the other side, without
another date between, and no other date's.

Struck dates are superseded. Two dates that a word or dash joins are one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.dates import MONTHS
from tidemark.operators.evidence import CYCLES, LABELS, MONTH_WORDS
from tidemark.operators.partitions import in_parts

#: Elements that hold items, and those that begin an item, a cell, or a block of flowing text.
ITEM_OF = {"table": ("tr",), "ul": ("li",), "ol": ("li",), "dl": ("dt",)}
CELLS = ("td", "th", "dt", "dd")
BLOCKS = ("p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "header", "footer", "nav", "main", "aside", "blockquote", "body", "title", *ITEM_OF)
#: Words of a table's head that name its columns, joints of a range, separators, and how far a label may be, and how much nearer than another.
DATE_HEADS, LABEL_HEADS = ("date", "dates", "when", "due"), ("event", "what", "milestone", "activity", "task", "stage")
JOINTS, SEPARATORS, NEAR, CLEARLY = ("to", "-", "–", "—"), (":", "–", "—"), 8, 3
#: The labels of each field; dates of the last one belong to none that is asked for.
FIELD_LABELS = {"deadline": LABELS["deadline"][0], "abstract_deadline": LABELS["abstract_deadline"][0], "date": ("conference dates", "conference date", "event dates"), "other": LABELS["deadline"][1]}
PHRASES = sorted(((phrase, field) for field, phrases in FIELD_LABELS.items() for phrase in phrases), key=lambda x: (-len(x[0]), x[0]))
LONGEST = max(len(p.split()) for p, _ in PHRASES)
#: A month's name between digits or a digit and the word's end, and the words of letters and digits that are a date: 5march2026, march5, march2026. In any other word, as a
#: hash or a key, a month is a part of it, so such a word is one token.
_MONTH = f"(?:{'|'.join(sorted(MONTH_WORDS, key=len, reverse=True))})"
_DATE_WORD = rf"(?:\d{{1,2}}{_MONTH}(?:\d{{4}})?|{_MONTH}(?:\d{{1,2}}|\d{{4}}))(?![a-z0-9])"
_CODE = rf"(?<![a-z0-9])(?!{_DATE_WORD})(?=[a-z0-9]*?(?:\d{_MONTH}(?![a-z])|(?<![a-z]){_MONTH}\d))[a-z0-9]+"
#: Dates, times, numbers, words, separators and joints of a folded text.
TOKEN = rf"(\d{{4}}-\d{{1,2}}-\d{{1,2}}(?!\d)|\d{{1,2}}:\d{{2}}(?::\d{{2}})?|{_CODE}|\d+|[a-z]+|[:–—-])"
ISO, DAY, YEAR = r"^\d{4}-\d{1,2}-\d{1,2}$", r"^([1-9]|0[1-9]|[12]\d|3[01])$", r"^\d{4}$"
UNIT = ["_page", "level", "cont", "item", "flow"]
#: Pages of a task: the windows over them hold some 200 kB each.
PAGES = 500


def pieces(pages: DataFrame, key: str, html: str, year: str | None = None) -> DataFrame:
    """A row per tag or text of a page's markup, with its place: level, cont and kind (the list or table around it), item, cell, head, flow, section, struck."""
    given = (F.col(year) if year else F.lit(None)).cast("int").alias("_year")
    rows = in_parts(pages.select(F.col(key).alias("_page"), given, F.col(html).alias("_html")), "_page", rows=PAGES)
    rows = rows.select("_page", "_year", F.posexplode(F.regexp_extract_all(text.without_silent(F.col("_html")), F.lit(r"(<[^>]*>|[^<]+)"), F.lit(1))).alias("i", "piece"))
    tag, closing = F.lower(F.regexp_extract("piece", r"^</?([a-zA-Z][a-zA-Z0-9]*)", 1)), F.startswith("piece", F.lit("</"))
    rows = rows.select("*", tag.alias("tag"), closing.alias("closing"), (~F.startswith("piece", F.lit("<"))).alias("is_text"))
    on = Window.partitionBy("_page").orderBy("i")
    opens, holder = ~F.col("closing"), F.col("tag").isin(*ITEM_OF)
    rows = rows.withColumn("_s", F.sum(F.when(holder, F.when(opens, 1).otherwise(-1)).otherwise(0)).over(on))
    # A closing tag without an opening one takes nothing away.
    rows = rows.withColumn("level", F.col("_s") - F.least(F.lit(0), F.min("_s").over(on)))
    by_level = Window.partitionBy("_page", "level").orderBy("i")
    rows = rows.withColumns({
        "cont": F.when(F.col("level") > 0, F.max(F.when(holder & opens, F.col("i"))).over(by_level)), "kind": F.when(F.col("level") > 0, F.last(F.when(holder & opens, F.col("tag")), True).over(by_level)),
    })
    begins = F.lit(False)
    for kind, tags in ITEM_OF.items():
        begins = begins | ((F.col("kind") == kind) & F.col("tag").isin(*tags))
    within = Window.partitionBy("_page", "level", "cont").orderBy("i")
    rows = rows.withColumn("item", F.when(F.col("level") > 0, F.sum(F.when(opens & begins, 1).otherwise(0)).over(within)))
    inside = Window.partitionBy("_page", "level", "cont", "item").orderBy("i")
    cell = opens & F.col("tag").isin(*CELLS)
    rows = rows.withColumn("cell", F.sum(F.when(cell, 1).otherwise(0)).over(inside))
    heading = F.col("tag").rlike("^h[1-6]$")
    rows = rows.withColumns({
        "flow": F.when(F.col("level") == 0, F.sum(F.when(F.col("tag").isin(*BLOCKS), 1).otherwise(0)).over(on)),
        "section": F.sum(F.when(heading & opens, 1).otherwise(0)).over(on), "heading": F.coalesce(~F.last(F.when(heading, F.col("closing")), True).over(on), F.lit(False)),
    })
    # A struck element ends at the next end of its tag.
    following = Window.partitionBy("_page", "tag").orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, -1)
    strikes = opens & (F.col("tag").isin(*text.STRUCK) | (~F.col("is_text") & F.col("piece").rlike("(?i)line-through|strikethrough")))
    rows = rows.withColumn("_end", F.when(strikes, F.min(F.when(F.col("closing"), F.col("i"))).over(following)))
    return rows.withColumn("struck", F.coalesce(F.max("_end").over(on) > F.col("i"), F.lit(False))).drop("_s", "_end")


def tokens_of(c: Column) -> Column:
    """Tokens of a text with its dates, times, separators and joints."""
    folded = F.translate(text.fold(text.unescape_html(c)), text.NO_WIDTH, "")
    return F.regexp_extract_all(F.regexp_replace(folded, r"(\d)(st|nd|rd|th)\b", "$1"), F.lit(TOKEN), F.lit(1))


def units(pages: DataFrame, key: str, html: str, year: str | None = None) -> DataFrame:
    """A row per unit: its place, ``tokens`` (structs of t, cell and struck), ``first``, its first piece, and ``title``, the last heading before it or around it."""
    said = pieces(pages, key, html, year).filter("is_text").withColumn("words", tokens_of(F.col("piece"))).filter(F.size("words") > 0)
    # Headings by section, carried to all that follows.
    of_section = Window.partitionBy("_page", "section")
    own = F.array_join(F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("heading"), F.struct("i", "words"))).over(of_section)), lambda x: x["words"])), " ")
    said = said.withColumn("title", own)
    rows = said.groupBy(*UNIT).agg(F.first("kind").alias("kind"), F.first("_year").alias("_year"), F.min(F.struct("i", "title"))["title"].alias("title"), F.min("i").alias("first"), F.array_sort(F.collect_list(F.struct("i", "cell", "struck", "words"))).alias("said"))
    flat = F.flatten(F.transform("said", lambda p: F.transform(p["words"], lambda t: F.struct(t.alias("t"), p["cell"].alias("cell"), p["struck"].alias("struck")))))
    return rows.withColumn("tokens", flat).drop("said")


def _is(c: Column, pattern: str) -> Column:
    return F.coalesce(c.rlike(pattern), F.lit(False))


def _date_at(tokens: Column, i: Column) -> tuple[Column, Column, Column]:
    """Whether a date is written at a token: in numbers, as month and day, or as day and month."""
    at = lambda k: F.get(tokens, i + k)["t"]
    named = F.coalesce(at(0).isin(*MONTH_WORDS), F.lit(False))
    return _is(at(0), ISO), named & _is(at(1), DAY), named & ~_is(at(1), DAY) & (i > 0) & _is(F.get(tokens, F.greatest(i - 1, F.lit(0)))["t"], DAY)


def dated(tokens: Column) -> Column:
    """Whether any date is written in a unit."""
    begins = F.filter(F.transform(tokens, lambda x, i: F.when(x["t"].isin(*MONTH_WORDS) | x["t"].rlike(ISO), i)), lambda i: i.isNotNull())
    return F.exists(begins, lambda i: _date_at(tokens, i)[0] | _date_at(tokens, i)[1] | _date_at(tokens, i)[2])


def _mark(tokens: Column, i: Column) -> Column:
    """What stands at a token: a struct of kind, low, high (behind its last token), y, m, d, field and label; null if nothing."""
    at = lambda k: F.get(tokens, i + k)["t"]
    t, none = at(0), F.lit(None).cast("string")

    def struct(kind: str, low: Column, high: Column, y: Column = none, m: Column = none, d: Column = none, field: str | None = None, label: str | None = None) -> Column:
        said = zip(("y", "m", "d", "field", "label"), (y, m, d, F.lit(field).cast("string"), F.lit(label).cast("string")), strict=True)
        return F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"), *[c.alias(n) for n, c in said])

    month = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.left(t, F.lit(3))).cast("string")
    iso, forward, backward = _date_at(tokens, i)
    year = lambda k: F.when(_is(at(k), YEAR), at(k))
    number = F.split(t, "-")
    out = F.when(iso, struct("date", i, i + 1, F.get(number, F.lit(0)), F.get(number, F.lit(1)), F.get(number, F.lit(2))))
    out = out.when(forward, struct("date", i, i + F.when(year(2).isNotNull(), 3).otherwise(2), year(2), month, at(1)))
    out = out.when(backward, struct("date", i - 1, i + F.when(year(1).isNotNull(), 2).otherwise(1), year(1), month, F.get(tokens, F.greatest(i - 1, F.lit(0)))["t"]))
    out = out.when(t.isin(*SEPARATORS), struct("separator", i, i + 1))
    for phrase, field in PHRASES:
        words = phrase.split()
        same = t == words[0]
        for k, w in enumerate(words[1:], 1):
            same = same & (at(k) == w)
        out = out.when(same, struct("label", i, i + len(words), field=field, label=phrase))
    return out


def marked(rows: DataFrame) -> DataFrame:
    """A row per date, label and separator of a unit. Ranges are one date with ``until``; labels that touch or overlap are one, of the first one's field."""
    wanted = [*MONTH_WORDS, *SEPARATORS, *{p.split()[0] for p, _ in PHRASES}]
    # A token that begins nothing is passed over before anything is looked up.
    spots = F.filter(F.transform("tokens", lambda x, i: F.when(x["t"].isin(*wanted) | x["t"].rlike(ISO), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("_at", F.explode(spots)).withColumn("mark", _mark(F.col("tokens"), F.col("_at"))).filter("mark IS NOT NULL")
    here = F.get("tokens", F.col("_at"))
    rows = rows.select(*UNIT, "info", "_year", "mark.*", here["cell"].alias("cell"), here["struck"].alias("struck"), F.get("tokens", F.col("mark.high"))["t"].alias("after"))
    rows = rows.filter("NOT struck OR kind = 'date'")
    alike = Window.partitionBy(*UNIT, "kind", "struck", F.when(F.col("kind") == "label", F.col("cell"))).orderBy("low", F.desc("high"))
    before = lambda c: F.lag(c).over(alike)
    rows = rows.withColumn("joined", (F.col("kind") == "date") & F.coalesce(before("after").isin(*JOINTS) & (before("high") + 1 == F.col("low")), F.lit(False)))
    rows = rows.withColumn("_ends", F.coalesce((F.col("kind") == "date") & F.lead("joined").over(alike), F.lit(False)))
    # The year of a range stands at its end.
    year = F.coalesce("y", F.when(F.col("_ends"), F.lead("y").over(alike)), F.col("_year").cast("string"))
    rows = rows.withColumn("day", F.try_to_date(F.concat(F.lpad(year, 4, "0"), F.lit("-"), F.lpad("m", 2, "0"), F.lit("-"), F.lpad("d", 2, "0"))))
    rows = rows.withColumn("until", F.when(F.col("_ends"), F.lead("day").over(alike)))
    # The joint of a range is no separator.
    on = Window.partitionBy(*UNIT).orderBy("low", F.desc("high"))
    joint = (F.col("kind") == "separator") & F.coalesce(F.lead("joined").over(on) & (F.lead("low").over(on) == F.col("high")), F.lit(False))
    rows = rows.withColumn("_joint", joint).filter("NOT _joint AND NOT joined").drop("_joint")
    so_far = F.max("high").over(alike.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_new", F.when((F.col("kind") != "label") | so_far.isNull() | (F.col("low") > so_far), 1).otherwise(0))
    rows = rows.withColumn("_group", F.sum("_new").over(alike))
    firsts = F.min_by(F.struct("day", "until", "field", "label"), F.struct("low", -F.col("high")))
    out = rows.groupBy(*UNIT, "kind", "struck", "cell", "_group").agg(F.first("info").alias("info"), F.min("low").alias("low"), F.max("high").alias("high"), firsts.alias("x"))
    return out.select(*UNIT, "info", "kind", "struck", "cell", "low", "high", "x.*")


def _sorted(kind: str, struck: bool) -> Column:
    what = F.struct("low", "high", "cell", "day", "until", "field", "label")
    return F.array_sort(F.collect_list(F.when((F.col("kind") == kind) & (F.col("struck") == struck), what)))


def _result(rule: Column, date: Column, label: Column, scope: Column, refusal: Column) -> Column:
    """One date's outcome; a range is refused for a field that has single days."""
    range_ = date["until"].isNotNull() & label["field"].isin(*CYCLES)
    reason = F.coalesce(refusal, F.when(range_, F.lit("range")), F.lit(""))
    return F.struct(
        rule.alias("rule"), label["field"].alias("field"), label["label"].alias("label"), scope.alias("scope"), date["day"].alias("day"), date["until"].alias("until"),
        F.when(reason == "", "paired").otherwise("refused").alias("outcome"), reason.alias("reason"), date["low"].alias("low"),
    )


def _nearest(date: Column, labels: Column) -> Column:
    """The labels before and after a date and how many tokens lie between: an array of structs of gap, label and side, nearest first."""
    gap = lambda x: F.when(x["high"] <= date["low"], date["low"] - x["high"]).when(x["low"] >= date["high"], x["low"] - date["high"])
    sided = F.transform(labels, lambda x: F.struct(gap(x).alias("gap"), (x["low"] >= date["high"]).alias("behind"), x.alias("label")))
    return F.array_sort(F.filter(sided, lambda s: s["gap"].isNotNull()))


def _by_distance(dates: Column, labels: Column) -> Column:
    """Rule D for each date of a unit."""

    def outcome(date: Column) -> Column:
        return F.get(F.transform(F.array(_nearest(date, labels)), lambda near: judged(date, near)), F.lit(0))

    def judged(date: Column, near: Column) -> Column:
        best = F.get(near, F.lit(0))
        other = F.get(F.filter(near, lambda s: s["behind"] != best["behind"]), F.lit(0))
        low, high = F.least(date["high"], best["label"]["high"]), F.greatest(date["low"], best["label"]["low"])
        between = F.exists(dates, lambda d: (d["low"] >= low) & (d["high"] <= high))
        rival = F.exists(dates, lambda d: (d["low"] != date["low"]) & (F.get(_nearest(d, labels), F.lit(0))["label"]["low"] == best["label"]["low"]))
        why = (
            F.when(best.isNull(), "no label").when(best["gap"] > NEAR, "too far").when(other.isNotNull() & (other["gap"] - best["gap"] < CLEARLY), "two sides")
            .when(between, "a date between").when(rival, "two dates")
        )
        return _result(F.lit("D"), date, best["label"], F.lit(""), why)

    return F.transform(dates, outcome)


def paired(pages: DataFrame, key: str = "page_id", html: str = "html", year: str | None = None) -> DataFrame:
    """A row per date of a page (of a range, per range): key, cont, item, rule, field, label, scope, heading, day, until, outcome, reason, low.

    ``outcome`` is paired, refused (with its reason) or superseded; a superseded date has the field of its unit's
    labels, if they are of one. ``cont`` numbers the list or table by its place in the markup, ``low`` is the date's
    first token in its unit. Dates without a year take that of the column ``year``, or have no day. Null markup and
    pages without a date have no rows. Everything of a page is computed in one task; pages don't meet.
    """
    rows = units(pages, key, html, year)
    listed = F.coalesce(F.col("item") > 0, F.lit(False))
    # A table's first row tells what its columns are.
    table = Window.partitionBy("_page", "level", "cont")
    names = lambda words: F.array_distinct(F.transform(F.filter("tokens", lambda x: x["t"].isin(*words)), lambda x: x["cell"]))
    is_head = (F.col("kind") == "table") & (F.col("item") == 1) & ~dated(F.col("tokens"))
    rows = rows.withColumn("head", F.max(F.when(is_head, F.struct(names(DATE_HEADS).alias("dates"), names(LABEL_HEADS).alias("labels"), F.col("tokens").alias("tokens")))).over(table))
    rows = rows.filter(dated(F.col("tokens")))
    date_col, label_col = F.get("head.dates", F.lit(0)), F.get("head.labels", F.lit(0))
    declared = listed & (F.col("item") > 1) & F.coalesce((F.size("head.dates") == 1) & (F.size("head.labels") == 1) & (date_col != label_col), F.lit(False))
    say = lambda tokens, cell: F.array_join(F.transform(F.filter(tokens, lambda x: x["cell"] == cell), lambda x: x["t"]), " ")
    more = F.array_except(F.array_sort(F.array_distinct(F.transform("tokens", lambda x: x["cell"]))), F.array(date_col, label_col))
    scope = F.array_join(F.transform(more, lambda c: F.concat(say(F.col("head.tokens"), c), F.lit("="), say(F.col("tokens"), c))), "; ")
    edge = F.array_min(F.filter(F.transform("tokens", lambda x, i: F.when(x["cell"] > 1, i)), lambda i: i.isNotNull()))
    info = F.struct("kind", "title", declared.alias("declared"), date_col.alias("date_col"), label_col.alias("label_col"), F.when(declared, scope).otherwise("").alias("scope"), edge.alias("edge"))
    marks = marked(rows.select(*UNIT, "_year", "tokens", info.alias("info")))
    sets = {"dates": ("date", False), "dead": ("date", True), "labels": ("label", False), "separators": ("separator", False)}
    rows = marks.groupBy(*UNIT).agg(F.first("info").alias("info"), *[_sorted(*x).alias(n) for n, x in sets.items()]).select(*UNIT, "info.*", *sets)
    own = lambda c, of: F.when(F.col("declared"), F.filter(c, lambda x: x["cell"] == F.col(of))).otherwise(F.col(c))
    rows = rows.withColumns({c: own(c, of) for c, of in (("dates", "date_col"), ("dead", "date_col"), ("labels", "label_col"))})
    # Rule B: one separator; a term's end is one.
    is_term = F.coalesce(F.col("kind") == "dl", F.lit(False))
    at = F.when(is_term, F.coalesce("edge", F.lit(-1))).when(F.size("separators") == 1, F.get("separators", F.lit(0))["low"]).otherwise(-1)
    rows = rows.withColumn("at", F.when(listed & ~F.col("declared"), at).otherwise(-1))
    ahead = lambda c: F.forall(c, lambda x: x["high"] <= F.col("at"))
    behind = lambda c: F.forall(c, lambda x: x["low"] >= F.col("at"))
    both = (F.size("dates") > 0) & (F.size("labels") > 0)
    split = (F.col("at") >= 0) & both & ((ahead("dates") & behind("labels")) | (behind("dates") & ahead("labels")))
    rows = rows.withColumn("split", split)
    # Rule C: items of a list without separators, as most of its items would have it.
    loose = listed & ~F.col("declared") & ~F.col("split") & (F.size("separators") == 0) & ~is_term & both
    single = F.col("loose") & (F.size("dates") == 1) & (F.size("labels") == 1)
    label_first = F.get("labels", F.lit(0))["low"] < F.get("dates", F.lit(0))["low"]
    rows = rows.withColumn("loose", loose).withColumns({"_n": F.count_if(single).over(table), "_first": F.count_if(single & label_first).over(table)})
    ordered = F.col("loose") & (F.col("_n") >= 2)
    dissent = (F.col("_first") > 0) & (F.col("_first") < F.col("_n"))
    fields = F.size(F.array_distinct(F.transform("labels", lambda x: x["field"])))
    label = F.get("labels", F.lit(0))
    refusal = F.when(F.size("labels") == 0, "no label").when(ordered & ~F.col("declared") & ~F.col("split") & dissent, "no order").when(fields > 1, "several labels").when(F.size("dates") > 1, "several dates")
    rule = F.when(F.col("declared"), "A").when(F.col("split"), "B").when(ordered, "C")
    whole = F.transform("dates", lambda d: _result(rule, d, label, F.col("scope"), refusal))
    live = F.when(rule.isNotNull(), whole).otherwise(_by_distance(F.col("dates"), F.col("labels")))
    old = F.transform("dead", lambda d: F.struct(
        F.lit("").alias("rule"), F.when(fields == 1, label["field"]).alias("field"), F.when(fields == 1, label["label"]).alias("label"), F.col("scope").alias("scope"), d["day"].alias("day"), d["until"].alias("until"),
        F.lit("superseded").alias("outcome"), F.lit("").alias("reason"), d["low"].alias("low"),
    ))
    out = rows.select(F.col("_page").alias(key), "cont", "item", F.col("title").alias("heading"), F.explode(F.concat(live, old)).alias("r"))
    return out.select(key, "cont", "item", "heading", "r.*")


def proposal_pairing(claims: DataFrame, pairs: DataFrame, key: str = "page_id") -> DataFrame:
    """``claims`` (key, field, day, scope; scope may be null) with ``status``: VERIFIED by a pair of the same day, REFUTED by a superseded date, else UNCONFIRMED.

    A claim without a scope is not verified by a pair of a table's row that has one.
    """
    p = pairs.select(F.col(key).alias("_k"), F.col("field").alias("_f"), F.col("day").alias("_d"), F.col("scope").alias("_s"), "outcome")
    on = (F.col(key) == F.col("_k")) & (F.col("field") == F.col("_f")) & (F.col("day") == F.col("_d"))
    fits = (F.col("outcome") == "paired") & (F.coalesce("scope", F.lit("")) == F.col("_s"))
    keys = [key, "field", "day", "scope"]
    by = claims.join(p, on, "left").groupBy(*keys).agg(F.coalesce(F.bool_or(fits), F.lit(False)).alias("_good"), F.coalesce(F.bool_or(F.col("outcome") == "superseded"), F.lit(False)).alias("_old"))
    return by.select(*keys, F.when(F.col("_good"), "VERIFIED").when(F.col("_old"), "REFUTED").otherwise("UNCONFIRMED").alias("status"))
