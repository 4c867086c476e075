"""Proposals: checks, verdicts, and their application to the overrides."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import WEEK_BEFORE
from tidemark.functions.text import clean, is_placeholder
from tidemark.operators.merge import canonical_record
from tidemark.operators.quality import STAMP, errors_of, record_errors

MOST_CHANGES, LEAST_QUOTE, KEPT_CITATIONS = 8, 8, 3
#: What a proposal may do, which fields it may set, and those that follow from another one.
ACTIONS = ("upsert_manual", "create_record", "delete_manual", "no_change")
FIELDS = ("abstract_deadline", "deadline", "timezone", "place", "date", "link", "note", "start", "end")
DERIVED = ("start", "end")


def claim_errors(name: Column, value: Column, quotes: Column, scope: Column) -> Column:
    """What is wrong with one field of a proposal; a null ``value`` (an array) claims that there is no such entry."""
    deletes, blank = value.isNull(), lambda c: clean(c) == ""
    bad_stamp = F.exists(value, lambda v: v.isNotNull() & ~is_placeholder(v) & ~v.rlike(STAMP))
    return errors_of(
        [
            ("field", ~name.isin(*FIELDS)),
            ("derived field", name.isin(*DERIVED)),
            ("zone deletion", deletes & (name == "timezone")),
            ("no scope", deletes & blank(scope)),
            ("no evidence", ~deletes & (F.coalesce(F.size(quotes), F.lit(0)) <= 0)),
            ("quote", ~deletes & F.exists(quotes, lambda q: F.length(clean(q)) < LEAST_QUOTE)),
            ("note of lines", (name == "note") & F.exists(value, lambda v: F.contains(v, F.lit("\n")))),
            ("note of a date", (name == "note") & F.exists(value, lambda v: v.rlike(WEEK_BEFORE))),
            ("bad date", name.isin("deadline", "abstract_deadline") & bad_stamp),
        ]
    )


def proposal_errors(proposals: DataFrame, titles: DataFrame, as_of: date) -> DataFrame:
    """``proposals`` (id, action, title, year, source_url, reason, obsolete_because, ``claims`` as in the evidence module) with ``errors``.

    Errors of fields are written ``field: error``. ``titles`` are the known ones; few enough or not, they
    are joined by their key. A deletion of a whole entry claims nothing and needs no fields.
    """
    known = titles.select(F.col("title")).distinct().withColumn("_known", F.lit(True))
    rows = proposals.join(known, "title", "left")
    deletes, concrete = F.col("action") == "delete_manual", F.exists(F.col("claims")["deadline"]["value"], lambda v: ~is_placeholder(v))
    own = errors_of(
        [
            ("action", ~F.coalesce(F.col("action").isin(*ACTIONS), F.lit(False))),
            ("title", F.col("_known").isNull()),
            ("year", F.col("year").isNull() | ~F.col("year").between(as_of.year - 2, as_of.year + 1)),
            ("id", ~F.coalesce(F.col("id") == F.concat_ws(":", "action", "title", F.col("year").cast("string")), F.lit(False))),
            ("not obsolete", deletes & ~F.coalesce(F.col("obsolete_because") == "upstream_agrees", F.lit(False))),
            ("source", ~deletes & ~F.coalesce(F.col("source_url").rlike("^https?://"), F.lit(False))),
            ("no reason", ~deletes & (clean(F.col("reason")) == "")),
            ("no fields", ~deletes & (F.coalesce(F.size("claims"), F.lit(0)) <= 0)),
            ("no deadline", (F.col("action") == "create_record") & ~F.coalesce(concrete, F.lit(False))),
        ]
    )
    of = F.flatten(F.transform(F.array_sort(F.map_keys("claims")), lambda k: F.transform(claim_errors(k, F.col("claims")[k]["value"], F.col("claims")[k]["quotes"], F.col("claims")[k]["scope"]), lambda e: F.concat_ws(": ", k, e))))
    return rows.withColumn("errors", F.when(deletes | (F.coalesce(F.size("claims"), F.lit(0)) <= 0), own).otherwise(F.concat(own, of))).drop("_known")


def judged(proposals: DataFrame, verdicts: DataFrame, key: str, status: str = "status", good: str = "VERIFIED") -> DataFrame:
    """``proposals`` with ``accepted``, by one join; one without a good verdict is not."""
    fine = verdicts.filter(F.col(status) == good).select(F.col(key).alias("_good")).distinct()
    return proposals.join(fine, F.col(key) == F.col("_good"), "left").withColumn("accepted", F.col("_good").isNotNull()).drop("_good")


def accepted(proposals: DataFrame, verdicts: DataFrame, key: str, status: str = "status", good: str = "VERIFIED") -> DataFrame:
    """Proposals with a good verdict; one without a verdict is not accepted."""
    return proposals.join(verdicts.filter(F.col(status) == good).select(key), key, "left_semi")


def rejected(proposals: DataFrame, verdicts: DataFrame, key: str, status: str = "status", good: str = "VERIFIED") -> DataFrame:
    """The other proposals."""
    return proposals.join(verdicts.filter(F.col(status) == good).select(key), key, "left_anti")


def upsert(overrides: DataFrame, proposals: DataFrame, keys: list[str], fields: list[str], canonical: dict[str, str] | None = None) -> DataFrame:
    """Overrides after the proposals: fields, set_fields and change (added, changed, unchanged, kept).

    Fields that a proposal doesn't set keep what the override says. A proposal marked ``delete`` is
    never applied. One that only writes the same value in another way leaves its row as it is:
    ``canonical`` gives the kind of each field that has a comparison form (see ``canonical_record``).
    """
    theirs = proposals.filter(~F.col("delete")).select(*keys, *[F.col(f).alias(f"_p_{f}") for f in fields], F.col("set_fields").alias("_ps"))
    mine = overrides.select(*keys, *[F.col(f).alias(f"_o_{f}") for f in fields], F.col("set_fields").alias("_os"))
    rows = mine.join(theirs, keys, "full")
    sets = lambda f: F.coalesce(F.array_contains("_ps", f), F.lit(False))
    value = {f: F.when(sets(f), F.col(f"_p_{f}")).otherwise(F.col(f"_o_{f}")) for f in fields}
    none = F.array().cast("array<string>")
    both = F.array_sort(F.array_distinct(F.concat(F.coalesce("_os", none), F.coalesce("_ps", none))))
    form = lambda values: canonical_record({f: (v, (canonical or {}).get(f, "text")) for f, v in values.items()})
    alike = form(value).eqNullSafe(form({f: F.col(f"_o_{f}") for f in fields}))
    same = alike & (F.size(F.array_except(F.coalesce("_ps", none), F.coalesce("_os", none))) == 0)
    change = F.when(F.col("_ps").isNull(), "kept").when(F.col("_os").isNull(), "added").when(same, "unchanged").otherwise("changed")
    left = F.col("_os").isNotNull() & same
    return rows.select(*keys, *[F.when(left, F.col(f"_o_{f}")).otherwise(value[f]).alias(f) for f in fields], both.alias("set_fields"), change.alias("change"))


def checked(changes: DataFrame, title: str, year: str, deadlines: str, abstracts: str, zone: str, link: str, titles: DataFrame, as_of: date) -> DataFrame:
    """``changes`` with ``errors``: the record's own validation, before anything is written; a deadline may still be missing."""
    known = titles.select(F.col(title)).distinct().withColumn("_known", F.lit(True))
    rows = changes.join(known, title, "left")
    errors = record_errors(F.col(title), F.col(year), F.col(deadlines), F.col(abstracts), F.col(zone), F.col(link), F.col("_known"), as_of, need_deadline=False)
    return rows.withColumn("errors", errors).drop("_known")


def citations(new: Column, kept: Column, most: int = KEPT_CITATIONS) -> Column:
    """The new citation before the newest ``most`` of the earlier ones."""
    return F.concat(F.array(new), F.transform(F.slice(F.coalesce(kept, F.array().cast("array<string>")), 1, most), lambda c: F.concat(F.lit("Earlier: "), c)))


def within_cap(changes: DataFrame, cap: int = MOST_CHANGES) -> bool:
    """Whether so few rows change that the run may go on; reads one row more than the cap at most."""
    return changes.filter(F.col("change").isin("added", "changed")).limit(cap + 1).count() <= cap


def first_quote(quotes: Column, absences: Column) -> Column:
    """The first quote that isn't blank, in order, or else the first such absence quote."""
    usable = lambda a: F.get(F.filter(a, lambda q: F.trim(F.coalesce(q, F.lit(""))) != ""), F.lit(0))
    return F.coalesce(usable(quotes), usable(absences))


def stable_id(*parts: Column) -> Column:
    """Sixteen characters that stay the same for the same parts."""
    return F.left(F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256), F.lit(16))
