"""Validation, coverage, watchlists and effort reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import leading_date, zone_known
from tidemark.functions.text import is_placeholder

#: Fixed value: the note of a record that an audit has not reached.
SEEDED = "Seeded before the audit; the auditor did not reach this record."
#: The written forms of a date and time and of a zone; notes that stand for what isn't known yet; the reasons to watch a record, the most urgent first.
STAMP = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$"
ZONE = r"^(AoE|PST|PDT|UTC([+-]\d{1,2})?|[A-Za-z]+(/[A-Za-z0-9_+\-]+)+)$"
STALE = r"(?i)not (?:yet |publicly )?(?:available|announced)|announced yet|not yet available"
REASONS = ("deadline-within-45-days", "tba-upcoming-cycle", "manual-override-active", "cross-source-disagreement", "stale-placeholder-note", "coverage-gap", "tba-metadata")
HORIZON = 45


def errors_of(rules: list[tuple[str, Column]]) -> Column:
    """The names of the rules that are broken, in their order; a null condition counts as not broken."""
    return F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))


def _bad_stamp(stamps: Column) -> Column:
    return F.exists(stamps, lambda d: d.isNotNull() & ~is_placeholder(d) & ~d.rlike(STAMP))


def record_errors(title: Column, year: Column, deadlines: Column, abstracts: Column, zone: Column, link: Column, known_titles: Column, as_of: date, zones: tuple[str, ...] | None = None, need_deadline: bool = True) -> Column:
    """What is wrong with a record; ``known_titles`` says whether the title is one of the dimension's.

    ``need_deadline`` is off for records that may still lack one, as merged overrides do. ``zones`` are the
    names that resolve, by default all of the runtime's.
    """
    real = zone.isNotNull() & ~is_placeholder(zone)
    concrete = F.exists(F.coalesce(deadlines, F.array().cast("array<string>")), lambda d: d.isNotNull() & ~is_placeholder(d))
    return errors_of(
        [
            ("title", title.isNull() | ~F.coalesce(known_titles, F.lit(False))),
            ("year", year.isNull() | ~year.between(as_of.year - 2, as_of.year + 1)),
            ("no deadline", ~concrete & F.lit(need_deadline)),
            ("bad deadline", _bad_stamp(deadlines)),
            ("bad abstract", _bad_stamp(abstracts)),
            ("bad zone", real & ~zone.rlike(ZONE)),
            ("unknown zone", real & zone.rlike(ZONE) & ~zone_known(zone, zones)),
            ("bad link", link.isNotNull() & ~link.rlike("^https?://")),
        ]
    )


def watch_reasons(year: Column, deadlines: Column, note: Column, place: Column, dates: Column, zone: Column, disagrees: Column, overridden: Column, as_of: date) -> Column:
    """Why a record is to be looked at, as an array in the order of :data:`REASONS`.

    Past editions whose dates have all gone by are history: a disagreement or an override earns them nothing.
    """
    days = F.filter(F.transform(deadlines, leading_date), lambda d: d.isNotNull())
    none, today = F.size(days) == 0, F.lit(as_of)
    alive, coming = none | F.exists(days, lambda d: d >= today), year >= as_of.year
    found = {
        "deadline-within-45-days": F.exists(days, lambda d: d.between(today, F.date_add(today, HORIZON))),
        "tba-upcoming-cycle": coming & none,
        "manual-override-active": alive & overridden,
        "cross-source-disagreement": alive & disagrees,
        "stale-placeholder-note": coming & F.coalesce(note, F.lit("")).rlike(STALE),
        "tba-metadata": coming & ~none & alive & (is_placeholder(place) | is_placeholder(dates) | is_placeholder(zone)),
    }
    return errors_of([(r, found[r]) for r in REASONS if r in found])


def full_watchlist(records: DataFrame, reasons: Column, targets: DataFrame, covered: DataFrame, title: str, year: str, next_year: int) -> DataFrame:
    """title, year, reasons (an array) and rank: records with a reason, and a row for each target that nothing covers.

    ``covered`` has the titles and years of all records and overrides; a target needs one of ``next_year`` or
    later. Best reason first, then by title and year.
    """
    rows = records.select(title, year, reasons.alias("reasons")).filter(F.size("reasons") > 0)
    later = covered.filter(F.col(year) >= next_year)
    gaps = missing_keys(targets, later, [title]).select(title, F.lit(next_year).alias(year), F.array(F.lit("coverage-gap")).alias("reasons"))
    place = F.array(*map(F.lit, REASONS))
    rank = F.array_min(F.transform("reasons", lambda r: F.array_position(place, r).cast("int") - 1))
    return rows.unionByName(gaps).withColumn("rank", rank).orderBy("rank", title, year)


def admissible(url: Column, denied_hosts: list[str], denied_path: str | None = None) -> Column:
    """A web address whose host is not denied, nor a subdomain of one that is."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    denied = F.lit(False)
    for h in denied_hosts:
        denied = denied | (host == h) | F.endswith(host, F.lit("." + h))
    path = url.rlike(denied_path) if denied_path else F.lit(False)
    return F.coalesce(url.rlike("^https?://") & host.isNotNull() & (host != "") & ~denied & ~path, F.lit(False))


def missing_keys(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Expected keys that nothing covers."""
    return expected.select(*keys).distinct().join(present.select(*keys), keys, "left_anti")


def watchlist(df: DataFrame, reasons: list[tuple[str, Column]], order: list[str]) -> DataFrame:
    """Rows with a reason: reasons (comma-joined, in the list's order) and rank, the first reason's place."""
    found = errors_of(reasons)
    rows = df.withColumn("_r", found).filter(F.size("_r") > 0)
    names = F.array(*[F.lit(n) for n, _ in reasons])
    rank = F.array_position(names, F.get("_r", F.lit(0))).cast("int") - 1
    return rows.withColumn("reasons", F.array_join("_r", ",")).withColumn("rank", rank).drop("_r").orderBy("rank", *order)


def effort(df: DataFrame, status: str, unchecked: str) -> DataFrame:
    """Rows by status, with the total and how many of it were examined at all; the rows are read once, the totals are of the few statuses."""
    by = df.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))
    all_ = Window.partitionBy()
    return by.select("status", "n", F.sum("n").over(all_).alias("total"), F.coalesce(F.sum(F.when(F.col("status") != unchecked, F.col("n"))).over(all_), F.lit(0)).alias("examined"))


def audit_seed(watchlist: DataFrame, title: str, year: str) -> DataFrame:
    """A watchlist as the start of an audit: title, year, cause, attempted (none yet) and note. Nothing counts as checked before it was."""
    none = F.array().cast("array<string>")
    return watchlist.select(title, year, F.lit("not_checked").alias("cause"), none.alias("attempted"), F.lit(SEEDED).alias("note"))


def health(df: DataFrame, severity: Column, key: str, message: Column) -> DataFrame:
    """Messages as rows of severity, key and message; a null message is none."""
    return df.select(severity.alias("severity"), F.col(key).alias("key"), message.alias("message")).filter("message IS NOT NULL")
