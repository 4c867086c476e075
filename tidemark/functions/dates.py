"""Dates, date ranges, zones and day labels as column expressions; today is always a parameter."""

from __future__ import annotations

from datetime import date
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import clean

#: Month names in order, the forms of a date and time, of a date range and of an offset, and what a note says of an abstract.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
#: Offset of a deadline without a usable zone: anywhere on earth.
ANYWHERE = "-12:00"
STAMP = r"^(\d{4})-(\d{1,2})-(\d{1,2})[ T](\d{1,2}):(\d{2})(?::\d{2})?$"
RANGE = r"^([A-Za-z.]+)\s*(\d{1,2})\s*(?:-\s*([A-Za-z.]+)?\s*(\d{1,2}))?\s*,?\s*(\d{4})\.?$"
OFFSET = r"(?i)^UTC([+-])(\d{1,2})(?::?(\d{2}))?$"
WEEK_BEFORE = r"(?i)abstract.*1 week before|1 week before.*abstract"
#: Where the board shows its times.
DISPLAY = "Asia/Seoul"


def _once(value: Column, body) -> Column:
    """``body`` of a value that is computed once; a plain expression would be computed at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def norm_stamp(c: Column) -> Column:
    """``YYYY-MM-DD HH:MM`` from many forms of date and time; null for placeholders, dates alone and anything else."""
    two = lambda p, i: F.lpad(F.get(p, F.lit(i)), 2, "0")
    shown = lambda p: F.concat(F.get(p, F.lit(0)), F.lit("-"), two(p, 1), F.lit("-"), two(p, 2), F.lit(" "), two(p, 3), F.lit(":"), two(p, 4))
    # Placeholders don't have the form.
    return _once(clean(c), lambda t: F.when(t.rlike(STAMP), _once(F.split(t, "[-T :]"), shown)))


def kept_stamp(c: Column) -> Column:
    """The normal form, or the raw value where there is none."""
    return F.coalesce(norm_stamp(c), c)


def leading_date(c: Column) -> Column:
    """The date that a text starts with; null if there is none or it doesn't exist."""
    found = r"^(\d{4})-(\d{1,2})-(\d{1,2})"
    text = F.coalesce(c.cast("string"), F.lit(""))
    part = lambda k, n: F.lpad(F.regexp_extract(text, found, k), n, "0")
    return F.when(text.rlike(found), F.try_to_date(F.concat_ws("-", part(1, 4), part(2, 2), part(3, 2))))


def month_number(c: Column) -> Column:
    """The month that a name of three letters or more begins, or null."""
    names, short = F.array(*map(F.lit, MONTHS)), F.array(*[F.lit(m[:3]) for m in MONTHS])

    def found(name: Column) -> Column:
        at = F.array_position(short, F.left(name, F.lit(3))).cast("int")  # no two begin alike
        return F.when((F.length(name) >= 3) & F.startswith(F.get(names, at - 1), name), at)

    return _once(F.regexp_replace(F.lower(clean(c)), r"^\.+|\.+$", ""), found)


def date_range(c: Column) -> Column:
    """A struct of start and end from texts like ``March 30 - April 2, 2027``; null if not understood.

    Any dash will do; the second month defaults to the first, the end to the start, and an end
    before the start belongs to the next year.
    """
    text = F.translate(clean(c), "–—−", "---")
    made = lambda y, m, d: F.try_to_date(F.format_string("%04d-%02d-%02d", y, m, d))

    def read(g: Column) -> Column:
        part = lambda k: F.get(g, F.lit(k))
        first = month_number(part(0))
        return F.struct(
            part(4).try_cast("int").alias("year"), first.alias("first"), F.when(part(2) != "", month_number(part(2))).otherwise(first).alias("second"),
            part(1).try_cast("int").alias("day"), part(3).try_cast("int").alias("last"),
        )

    def placed(p: Column) -> Column:
        end = F.when(p["last"].isNull(), made(p["year"], p["first"], p["day"])).otherwise(made(p["year"], p["second"], p["last"]))
        return F.struct(p.alias("p"), made(p["year"], p["first"], p["day"]).alias("start"), end.alias("end"))

    def turned(x: Column) -> Column:
        later = made(x["p"]["year"] + 1, x["p"]["second"], x["p"]["last"])
        return F.struct(x["start"].alias("start"), F.when(x["end"] < x["start"], later).otherwise(x["end"]).alias("end"))

    def whole(r: Column) -> Column:
        return F.when(r["start"].isNotNull() & r["end"].isNotNull(), r)

    # The pattern is matched once and its groups are taken apart at a mark that it can't hold.
    groups = lambda t: F.split(F.regexp_replace(t, RANGE, "$1|$2|$3|$4|$5"), r"\|")
    return _once(text, lambda t: F.when(t.rlike(RANGE), _once(_once(_once(_once(groups(t), read), placed), turned), whole)))


def canonical_zone(c: Column) -> Column:
    """The comparison form of a zone name."""
    return _once(clean(c), lambda t: F.when(t == "AoE", "UTC-12").when(t.isin("UTC", "UTC+0"), "UTC+0").otherwise(t))


def zone_of_fixed_feed(c: Column) -> Column:
    """Zones of the feed that writes PT and UTC offsets; others are null."""
    text = clean(c)
    return F.when(text == "AoE", "AoE").when(text.isin("UTC", "UTC+0"), "UTC+0").when(text == "PT", "America/Los_Angeles").when(text.rlike(r"^UTC[+-]\d{1,2}$"), text)


def zone_of_named_feed(c: Column) -> Column:
    """Zones of the feed that writes Etc/GMT with its sign the other way round; none means anywhere on earth."""
    text, etc = clean(c), r"^Etc/GMT([+-])(\d{1,2})$"
    turned = F.concat(F.lit("UTC"), F.when(F.regexp_extract(text, etc, 1) == "+", "-").otherwise("+"), F.regexp_extract(text, etc, 2))
    return F.when(text == "", "AoE").when(text.rlike(etc), turned).when(text.isin("Etc/GMT", "Etc/UTC", "UTC"), "UTC+0").otherwise(text)


@lru_cache(maxsize=1)
def zone_names() -> tuple[str, ...]:
    """The zone names that Spark can resolve, as its Java runtime lists them."""
    jvm = SparkSession.active()._jvm  # type: ignore[attr-defined]
    return tuple(sorted(jvm.java.time.ZoneId.getAvailableZoneIds()))


def zone_known(c: Column, names: tuple[str, ...] | None = None) -> Column:
    """False only for a name with a slash that is no zone; offsets and short names are not looked up."""
    return _once(clean(c), lambda t: ~F.contains(t, F.lit("/")) | t.isin(*(names or zone_names())))


def zone_id(c: Column, names: tuple[str, ...] | None = None) -> Column:
    """A zone that Spark can resolve: a fixed offset, a known name, or the fallback offset.

    PST and PDT are fixed offsets, not zones with a summer time; offsets go up to 18 hours. An unknown
    name must not reach a function that fails the whole query on it, so the names, a set of fixed
    size, are part of the expression.
    """
    part = lambda t, k: F.lpad(F.regexp_extract(t, OFFSET, k), 2, "0")

    def fixed(t: Column) -> Column:
        at = F.struct(F.regexp_extract(t, OFFSET, 1).alias("sign"), part(t, 2).alias("h"), part(t, 3).alias("m"))
        fits = lambda x: F.when((F.concat(x["h"], x["m"]) <= "1800") & (x["m"] <= "59"), F.concat(x["sign"], x["h"], F.lit(":"), x["m"])).otherwise(ANYWHERE)
        return _once(at, fits)

    def resolved(t: Column) -> Column:
        return (
            F.when(F.upper(t).isin("AOE", "UTC-12"), ANYWHERE).when(t.isin("UTC", "UTC+0"), "+00:00").when(t.rlike(OFFSET), fixed(t))
            .when(F.upper(t) == "PST", "-08:00").when(F.upper(t) == "PDT", "-07:00").when(t.isin(*(names or zone_names())), t).otherwise(ANYWHERE)
        )

    return _once(clean(c), resolved)


def instant(stamp: Column, zone: Column) -> Column:
    """The instant, as a UTC wall clock, of a local ``YYYY-MM-DD HH:MM`` in a zone name of any kind."""
    return F.to_utc_timestamp(F.try_to_timestamp(norm_stamp(stamp), F.lit("yyyy-MM-dd HH:mm")), zone_id(zone))


def displayed(at: Column, zone: str = DISPLAY) -> Column:
    """The wall clock of a UTC instant in the zone of the board, as ``YYYY-MM-DD HH:MM``."""
    return F.date_format(F.from_utc_timestamp(at, zone), "yyyy-MM-dd HH:mm")


def derived_abstract(paper: Column, note: Column) -> Column:
    """Seven days before the paper where the note says that the abstract is due a week before."""
    return F.when(F.coalesce(note, F.lit("")).rlike(WEEK_BEFORE), paper - F.expr("INTERVAL 7 DAYS"))


def days_left(c: Column, as_of: date) -> Column:
    return F.datediff(c, F.lit(as_of))


def day_label(days: Column) -> Column:
    """``D-n`` before, ``D-Day`` on the day, ``D+n`` after, ``TBA`` if unknown."""
    return (
        F.when(days.isNull(), "TBA").when(days < 0, F.concat(F.lit("D+"), (-days).cast("string"))).when(days == 0, "D-Day").otherwise(F.concat(F.lit("D-"), days.cast("string")))
    )


def urgency(days: Column, urgent: int = 14, soon: int = 60) -> Column:
    return F.when(days.isNull(), "tba").when(days < 0, "past").when(days <= urgent, "urgent").when(days <= soon, "soon").otherwise("later")


def date_forms(d: Column) -> Column:
    """How a date may be written, flattened: names and short names with day and year either way round, and
    numbers; month and day as numbers alone only when the day can't be a month."""
    month, day, year = F.month(d), F.dayofmonth(d), F.year(d)
    name = F.get(F.array(*map(F.lit, MONTHS)), month - 1)
    short = F.when(month == 9, "sept").otherwise(F.left(name, F.lit(3)))
    days = F.array_distinct(F.array(day.cast("string"), F.lpad(day.cast("string"), 2, "0")))
    y, m, yy = year.cast("string"), month.cast("string"), F.lpad((year % 100).cast("string"), 2, "0")
    mm, dd = F.lpad(m, 2, "0"), F.lpad(day.cast("string"), 2, "0")
    say = lambda *parts: F.concat_ws(" ", *parts)
    named = F.flatten(F.transform(days, lambda x: F.array(say(name, x, y), say(x, name, y), say(short, x, y), say(x, short, y))))
    plain = F.flatten(F.transform(days, lambda x: F.array(say(m, x, y), say(mm, x, y), say(x, m, y), say(m, x, yy))))
    every = F.concat(named, F.array(say(y, mm, dd)), F.when(day > 12, plain).otherwise(F.array().cast("array<string>")))
    return F.array_sort(F.array_distinct(every))


def in_week_of(c: Column, as_of: date) -> Column:
    """Whether a date is in the week (Monday to Sunday, whole days) of ``as_of``."""
    return F.date_trunc("week", c.cast("date")) == F.date_trunc("week", F.lit(as_of))
