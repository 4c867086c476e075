"""Whether a page's own list of milestones shows that a field is not there.

That something is nowhere on a page can't be shown; that the list which holds the deadline we know doesn't name it, can.
Lists and tables come from the structure of the page (:mod:`tidemark.operators.pairing`). One that qualifies has items of
one date each, on different days. It is an authority for a claim if one item holds the known deadline under a label
of that field, enough items are labelled milestones, and all its dates lie around the edition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.pairing import UNIT, marked, units

#: Items of one date that a list has at least, their days, its milestones, and how many months its dates may lie before the deadline and after the end.
ITEMS, DAYS, MILESTONES, BEFORE, AFTER = 3, 2, 3, 18, 6
#: How near to a date a label outside the lists speaks of it, in tokens: about 200 characters.
NEAR_DATE = 40
PLACE = ["_page", "level", "cont"]


def placed_marks(pages: DataFrame, key: str, html: str, year: str | None = None) -> DataFrame:
    """A row per date and label of a page that isn't struck: its unit, day, until, field, and ``at`` and ``to``, its tokens counted through the page.

    Units follow each other by where they begin; what comes after an inner list in an item counts with the item.
    """
    rows = units(pages, key, html, year).withColumn("n", F.size("tokens"))
    # Where a unit begins, among those of its page.
    before = F.sum("n").over(Window.partitionBy("_page").orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(*UNIT, "_year", "tokens", F.struct(F.coalesce(before, F.lit(0)).alias("start")).alias("info"))
    marks = marked(rows).filter("NOT struck AND kind <> 'separator'")
    start = F.col("info.start")
    return marks.select(*UNIT, "kind", "day", "until", "field", (start + F.col("low")).alias("at"), (start + F.col("high")).alias("to"))


def enumerated(marks: DataFrame) -> DataFrame:
    """A row per list or table that qualifies: _page, level, cont, n_milestones, since, till (its first and last day), undated (a date without a day), anchors (days under the label of a deadline) and fields (of all labels).

    ``marks`` are those of :func:`placed_marks`. An item is of one date if it holds one, or one range.
    """
    dates = F.col("kind") == "date"
    items = marks.filter("item > 0 AND cont IS NOT NULL").groupBy(*PLACE, "item").agg(
        F.count_if(dates).alias("n"), F.min("day").alias("day"), F.min("day").alias("since"), F.max(F.greatest("day", F.coalesce("until", "day"))).alias("till"),
        F.coalesce(F.bool_or(dates & F.col("day").isNull()), F.lit(False)).alias("undated"), F.collect_set("field").alias("fields"),
    )
    single = F.col("n") == 1
    anchor = F.when(single & F.array_contains("fields", "deadline"), F.col("day"))
    lists = items.groupBy(*PLACE).agg(
        F.count_if(single).alias("n_items"), F.count_distinct(F.when(single, F.col("day"))).alias("n_days"), F.count_if(single & (F.size("fields") > 0)).alias("n_milestones"),
        F.min("since").alias("since"), F.max("till").alias("till"), F.bool_or("undated").alias("undated"), F.collect_set(anchor).alias("anchors"), F.array_distinct(F.flatten(F.collect_set("fields"))).alias("fields"),
    )
    return lists.filter((F.col("n_items") >= ITEMS) & (F.col("n_days") >= DAYS)).drop("n_items", "n_days")


def _spoken(marks: DataFrame, lists: DataFrame) -> DataFrame:
    """Fields that a page names outside its lists near a date, those in lists included: _page, near (an array)."""
    flagged = marks.join(lists.select(*PLACE).withColumn("_in", F.lit(True)), PLACE, "left")
    on = Window.partitionBy("_page").orderBy("at", "to")
    date = F.col("kind") == "date"
    last = F.max(F.when(date, F.col("to"))).over(on)
    coming = F.min(F.when(date, F.col("at"))).over(on.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = flagged.withColumns({"_back": F.col("at") - last, "_on": coming - F.col("to")}).filter("kind = 'label' AND _in IS NULL")
    near = F.coalesce(F.col("_back") <= NEAR_DATE, F.lit(False)) | F.coalesce(F.col("_on") <= NEAR_DATE, F.lit(False))
    return rows.filter(near).groupBy("_page").agg(F.collect_set("field").alias("near"))


def structural_absence(claims: DataFrame, pages: DataFrame, key: str = "page_id", html: str = "html", year: str | None = None) -> DataFrame:
    """``claims`` (key, field, deadline, ends; unique) with ``supported``, whether the page shows that it has no such field, and ``reason``, why not.

    Reasons, the first that holds: no list (none qualifies), no anchor (none holds the deadline under its label), few
    milestones, out of range (a date without a day, or beyond ``BEFORE`` and ``AFTER``), listed (a qualifying list
    names the field), near a date (other text does). Null deadlines have no anchor; without ``ends`` no date is in
    range. A page that is not there, or null, has no list. All marks of a page are ordered in one task; pages don't meet.
    """
    marks = placed_marks(pages, key, html, year)
    lists = enumerated(marks)
    whole = lists.groupBy("_page").agg(F.array_distinct(F.flatten(F.collect_list("fields"))).alias("named"))
    page = whole.join(_spoken(marks, lists), "_page", "left")
    anchored = lists.withColumn("_deadline", F.explode("anchors")).select("_page", "_deadline", "n_milestones", "since", "till", "undated")
    rows = claims.join(page, F.col(key) == F.col("_page"), "left").withColumn("_is_page", F.col("_page").isNotNull()).drop("_page")
    rows = rows.join(anchored, (F.col(key) == F.col("_page")) & (F.col("deadline") == F.col("_deadline")), "left")
    enough = F.col("n_milestones") >= MILESTONES
    around = ~F.col("undated") & (F.col("since") >= F.add_months("deadline", -BEFORE)) & (F.col("till") <= F.add_months("ends", AFTER))
    yes = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    said = lambda c: F.coalesce(F.array_contains(c, F.col("field")), F.lit(False))
    by = rows.groupBy(key, "field", "deadline", "ends").agg(
        yes(F.col("_is_page")).alias("_is_page"), yes(F.col("_deadline").isNotNull()).alias("_anchor"), yes(enough).alias("_enough"), yes(enough & around).alias("_around"), yes(said("named")).alias("_listed"), yes(said("near")).alias("_near"),
    )
    reason = (
        F.when(~F.col("_is_page"), "no list").when(~F.col("_anchor"), "no anchor").when(~F.col("_enough"), "few milestones").when(~F.col("_around"), "out of range")
        .when(F.col("_listed"), "listed").when(F.col("_near"), "near a date").otherwise("")
    )
    return by.select(key, "field", "deadline", "ends", (reason == "").alias("supported"), reason.alias("reason"))
