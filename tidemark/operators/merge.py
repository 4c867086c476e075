"""Layered merge of existing, upstream and override records, and the checks around it.

Overrides are tri-state: a field that isn't in ``set_fields`` has no say, one that is there with a
value wins, one that is there with null deletes. Upstream only ever gives real values: an empty text
or a placeholder says nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.dates import canonical_zone, kept_stamp, leading_date
from tidemark.functions.text import clean, is_placeholder

RAIL_DAYS = 90


def owned(set_fields: Column, field: str) -> Column:
    return F.coalesce(F.array_contains(set_fields, field), F.lit(False))


def upstream_first(existing: Column, candidate: Column, owned_: Column) -> Column:
    """What upstream says unless the override owns the field or upstream says nothing."""
    return F.when(~owned_ & candidate.isNotNull(), candidate).otherwise(existing)


def overridden(value: Column, override: Column, owned_: Column) -> Column:
    """The override's value where it owns the field, null included."""
    return F.when(owned_, override).otherwise(value)


def real(value: Column, listed: bool = False) -> Column:
    """A value that says something: the text unless it is blank or a placeholder; a list less such items, null if none is left."""
    if not listed:
        return F.when(~is_placeholder(value), value)
    kept = F.filter(value, lambda x: ~is_placeholder(x))
    return F.when(F.size(kept) > 0, kept)


def future_days(stamps: Column) -> Column:
    """The days of a list of dates and times; what is no date is left out."""
    return F.filter(F.transform(stamps, leading_date), lambda d: d.isNotNull())


def layered_merge(
    existing: DataFrame, candidates: DataFrame, overrides: DataFrame, keys: list[str], fields: list[str], origin: str = "origin", deadlines: str | None = None, as_of: date | None = None
) -> DataFrame:
    """One row per key of any layer: the merged fields, which fields the override changed, the origin and the change.

    ``existing`` and ``candidates`` hold the fields, ``overrides`` the fields and ``set_fields``. Rows that
    only an override has take its values. A field may be a text or an array of texts; of a candidate only
    :func:`real` values count. With ``deadlines``, a field of dates, and ``as_of``, the safety rail holds:
    a candidate that would move a date still to come too far gives no field at all, unless the override
    owns the dates; ``railed`` says so, and so does ``change``. Rows without a whole key take no part; a
    key that repeats in a layer fails the query.
    """
    # The layers are stacked and grouped, so that each row is shuffled once; two full joins would
    # shuffle the result of the first again. A layer's row stays whole.
    listed = {f.name for f in existing.schema.fields if f.name in fields and f.dataType.typeName() == "array"}
    none = F.lit(None).cast("array<string>")
    stacked = [
        df.select(*keys, F.struct(*fields, (F.col("set_fields") if tag == "o" else none).alias("set_fields")).alias("_row"), F.lit(tag).alias("_layer"))
        for tag, df in (("e", existing), ("c", candidates), ("o", overrides))
    ]
    rows = stacked[0].unionByName(stacked[1]).unionByName(stacked[2]).dropna(subset=keys)
    one = [F.first(F.when(F.col("_layer") == tag, F.col("_row")), ignorenulls=True).alias(f"_{tag}") for tag in "eco"]
    most = F.greatest(*[F.count_if(F.col("_layer") == tag) for tag in "eco"])
    rows = rows.groupBy(*keys).agg(*one, F.when(most > 1, F.raise_error(F.lit("a key repeats in a layer")).cast("boolean")).otherwise(True).alias("_fine")).filter("_fine")
    own = {f: owned(F.col("_o.set_fields"), f) for f in fields}
    given = {f: real(F.col(f"_c.{f}"), f in listed) for f in fields}
    railed = F.lit(False)
    if deadlines and as_of:
        railed = ~own[deadlines] & F.coalesce(rail(future_days(F.col(f"_e.{deadlines}")), future_days(given[deadlines]), as_of), F.lit(False))
    rows = rows.withColumn("railed", railed)
    before = {f: upstream_first(F.col(f"_e.{f}"), given[f], own[f] | F.col("railed")) for f in fields}
    after = {f: overridden(before[f], F.col(f"_o.{f}"), own[f]) for f in fields}
    changed = F.array_compact(F.array(*[F.when(own[f] & ~after[f].eqNullSafe(before[f]), F.lit(f)) for f in fields]))
    there = lambda tag: F.col(f"_{tag}").isNotNull()
    kind = F.when(there("e") & there("c"), "both").when(there("e"), "existing").when(there("c"), "upstream").otherwise("override")
    same = F.lit(True)
    for f in fields:
        same = same & after[f].eqNullSafe(F.col(f"_e.{f}"))
    change = F.when(~there("e"), "created").when(F.col("railed"), "railed").when(same, "kept").otherwise("updated")
    return rows.select(*keys, *[after[f].alias(f) for f in fields], F.array_join(changed, ",").alias("overridden"), kind.alias(origin), change.alias("change"), *(["railed"] if deadlines else []))


def changed_fields(pairs: dict[str, tuple[Column, Column]]) -> Column:
    """Names, sorted and comma-joined, of the fields whose two values differ; null equals null."""
    return F.array_join(F.array_compact(F.array(*[F.when(~a.eqNullSafe(b), F.lit(n)) for n, (a, b) in sorted(pairs.items())])), ",")


def distance_days(dates: Column, others: Column) -> Column:
    """For each date the days to the nearest of the others."""
    return F.transform(dates, lambda d: F.array_min(F.transform(others, lambda o: F.abs(F.datediff(o, d)))))


def rail(existing: Column, candidates: Column, as_of: date, days: int = RAIL_DAYS) -> Column:
    """Whether upstream would move an existing date that is still to come by more than ``days``."""
    future = F.filter(existing, lambda d: d >= F.lit(as_of))
    return (F.size(future) > 0) & (F.size(candidates) > 0) & F.exists(distance_days(future, candidates), lambda n: n > days)


def largest_move(old: Column, new: Column) -> Column:
    """The farthest that any old date is from its nearest new one; null if either has none."""
    return F.when((F.size(old) > 0) & (F.size(new) > 0), F.array_max(distance_days(old, new)))


def canonical_record(fields: dict[str, tuple[Column, str]]) -> Column:
    """The comparison form of a record: a struct in which different writings of the same value are equal.

    Each field comes with its kind: "stamps" (an array of dates and times, normal forms where there are
    any, less nulls at its end), "zone", or "text". Null and absent are the same.
    """

    def stamps(c: Column) -> Column:
        kept = F.transform(F.coalesce(c, F.array().cast("array<string>")), kept_stamp)
        last = F.array_max(F.transform(kept, lambda x, i: F.when(x.isNotNull(), i)))
        return F.when(last.isNotNull(), F.slice(kept, 1, last + 1))

    forms = {"stamps": stamps, "zone": lambda c: F.when(c.isNotNull(), canonical_zone(c)), "text": lambda c: c.cast("string")}
    return F.struct(*[forms[kind](c).alias(name) for name, (c, kind) in fields.items()])


def disagree(a: Column, b: Column, tolerance: int = 1) -> Column:
    """Whether two sources differ in the number of dates, or in a sorted pair by more than the tolerance."""
    apart = F.zip_with(F.array_sort(a), F.array_sort(b), lambda x, y: F.coalesce(F.abs(F.datediff(x, y)) > tolerance, F.lit(True)))
    return (F.size(a) != F.size(b)) | F.exists(apart, lambda x: x)


def source_winner(df: DataFrame, keys: list[str], priority: str, tie: str) -> DataFrame:
    """The row of the best priority per key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(priority, tie))
    return df.withColumn("_n", rank).filter("_n = 1").drop("_n")


def usable_prefix(df: DataFrame, keys: list[str], priority: str, failed: str) -> DataFrame:
    """The rows before the first failed source in order of priority."""
    seen = F.max(F.col(failed).cast("int")).over(Window.partitionBy(*keys).orderBy(priority).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn("_seen", seen).filter("_seen = 0").drop("_seen")


def cross_fill(df: DataFrame, keys: list[str], priority: str, dates: str, value: str) -> DataFrame:
    """The winner of each key, its missing value taken from the first loser with the same days.

    ``dates`` is an array of dates, ``value`` is null where missing.
    """
    win = Window.partitionBy(*keys).orderBy(priority)
    whole = win.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = df.withColumn("_n", F.row_number().over(win)).withColumn("_days", F.first(dates).over(whole))
    fits = F.when((F.col("_n") > 1) & F.col(dates).eqNullSafe(F.col("_days")), F.col(value))
    rows = rows.withColumn("filled", F.coalesce(value, F.first(fits, ignorenulls=True).over(whole)))
    return rows.filter("_n = 1").drop("_n", "_days")


def enforce(value: Column, dimension: Column, year: Column, from_year: int) -> Column:
    """The dimension's value from ``from_year`` on; before that only where there is none."""
    return F.when(year >= from_year, dimension).otherwise(F.coalesce(value, dimension))


def without_stale_note(note: Column, had: Column, has: Column, pattern: str) -> Column:
    """The note, but for a placeholder at the moment when the record gets its first date."""
    return F.when(~had & has & F.coalesce(note, F.lit("")).rlike(pattern), F.lit(None)).otherwise(note)


def obsolete(set_fields: Column, pairs: dict[str, tuple[Column, Column]]) -> Column:
    """Whether upstream now agrees with all that an override sets.

    Never so for one that sets nothing comparable, nor for one that pins a field to null.
    """
    own = {f: owned(set_fields, f) for f in pairs}
    some, fine = F.lit(False), F.lit(True)
    for f, (mine, theirs) in pairs.items():
        some = some | own[f]
        fine = fine & (~own[f] | F.coalesce(clean(mine) == clean(theirs), F.lit(False)) & mine.isNotNull())
    return some & fine


def date_change(old: Column, new: Column) -> Column:
    """Whether two date ranges, both understood, differ."""
    return F.coalesce(old.isNotNull() & new.isNotNull() & ~old.eqNullSafe(new), F.lit(False))


def kept_range(old: Column, parsed: Column, same_text: Column) -> Column:
    """Start and end beside a new date text: what it says, else the old ones only if the text hasn't changed."""
    return F.coalesce(parsed, F.when(same_text, old))
