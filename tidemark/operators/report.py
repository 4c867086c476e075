"""Boards, pages, schedules and other reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import any_contains, clean
from tidemark.sources.versions import scratch


def board(df: DataFrame, year: str, days: str, category: str, name: str, categories: list[str], filters: list[Column]) -> DataFrame:
    """Rows that pass all filters, with the year's number of rows, in the board's order.

    By year, days (unknown last), the categories' order (others last), and name in binary order.
    """
    rows = df
    for f in filters:
        rows = rows.filter(f)
    place = F.array_position(F.array(*map(F.lit, categories)), F.col(category)).cast("int")
    rows = rows.withColumn("category_order", F.when(place > 0, place).otherwise(len(categories) + 1))
    # Counted in the tasks first and joined, so that no year's rows meet in one task; Spark sends the few counts to all.
    counts = rows.groupBy(F.col(year).alias("_year")).agg(F.count(F.lit(1)).alias("n_in_year"))
    rows = rows.join(counts, F.col(year).eqNullSafe(F.col("_year"))).drop("_year")
    return rows.orderBy(year, F.col(days).asc_nulls_last(), "category_order", name)


def numbered(df: DataFrame, keys: list[str], order: list[Column], name: str = "nth") -> DataFrame:
    """``df`` with the row's number within its keys."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def numbered_over_ranges(df: DataFrame, order: list[Column], name: str = "nth") -> DataFrame:
    """``df`` with the row's number in the order of all rows, from 1, without a task that has them all.

    Rows are sorted over ranges, each range's rows are counted, and the few counts tell where each begins. Rows that
    tie are in any order; ``order`` should leave none.
    """
    keys = {f"_o{i}": c for i, c in enumerate(order)}
    rows = df.withColumns(keys).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Both uses have to find the same rows in the same ranges.
    scratch(df.sparkSession)
    rows = rows.checkpoint().withColumn("_id", F.monotonically_increasing_id())
    # The number holds the partition above its lower 33 bits, and the row's place in it below.
    rows = rows.select(*df.columns, F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_nth"))
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    return rows.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_start") + F.col("_nth") + 1).alias(name))


def paginate(df: DataFrame, keys: list[str], order: list[Column], size: int = 9, span: int = 5) -> DataFrame:
    """``df`` with page and page_range, both from 1, within the keys."""
    rows = numbered(df, keys, order, "_n")
    rows = rows.withColumn("page", F.floor((F.col("_n") - 1) / size).cast("bigint") + 1)
    return rows.withColumn("page_range", F.floor((F.col("page") - 1) / span).cast("bigint") + 1).drop("_n")


def two_columns(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``df`` with column 1 or 2; the first gets the larger half."""
    return df.withColumn("column", F.ntile(2).over(Window.partitionBy(*keys).orderBy(*order)))


def changes(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """``df`` with is_first and is_change: whether the value differs from the row before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.lag(value).over(w)
    return df.withColumn("is_first", F.row_number().over(w) == 1).withColumn("is_change", ~before.eqNullSafe(F.col(value)))


def topics_until(items: DataFrame, deadlines: DataFrame, week: str, topic: str, until: str, keys: list[str]) -> DataFrame:
    """Per deadline the distinct topics of the weeks up to it, comma-joined in order.

    Topics are collected per week first, so the inequality meets one row per week.
    """
    weekly = items.groupBy(week).agg(F.collect_set(topic).alias("_t"))
    rows = deadlines.select(*keys, until).join(weekly, F.col(week) <= F.col(until), "left")
    return rows.groupBy(*keys, until).agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("_t")))), ",").alias("topics"))


def lookup(value: Column, table: dict[str, str], default: str) -> Column:
    """The table's entry, or the default's."""
    out = F.lit(table[default])
    for k, v in reversed(table.items()):
        out = F.when(value == k, F.lit(v)).otherwise(out)
    return out


def badge(value: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The label of the first prefix that the value starts with."""
    out = F.lit(otherwise)
    for prefix, label in reversed(rules):
        out = F.when(F.startswith(value, F.lit(prefix)), F.lit(label)).otherwise(out)
    return out


def cover_and_rest(items: Column) -> tuple[Column, Column]:
    """The first of an array and what follows it."""
    return F.get(items, F.lit(0)), F.slice(items, 2, F.greatest(F.size(items), F.lit(1)))


def adjacent_comments(df: DataFrame, keys: list[str], line_no: str, text: str) -> DataFrame:
    """Lines that aren't comments or blank, with the number of comment lines in the block right above."""
    blank, comment = F.trim(F.col(text)) == "", F.startswith(F.trim(F.col(text)), F.lit("#"))
    w = Window.partitionBy(*keys).orderBy(line_no)
    rows = df.withColumn("_block", F.sum(blank.cast("int")).over(w)).withColumn("_comment", comment.cast("int"))
    above = Window.partitionBy(*keys, "_block").orderBy(line_no)
    rows = rows.withColumn("comments", F.sum("_comment").over(above).cast("bigint"))
    return rows.filter(~blank & ~comment).drop("_block", "_comment")


def publication_search(df: DataFrame, title: str, authors: str, venue: str, type_: str, query: str, kind: str = "all") -> DataFrame:
    """Rows in whose title, authors or venue the query occurs, case aside, and whose type holds ``kind``."""
    rows = df.filter(any_contains([F.col(title), F.col(authors), F.col(venue)], query))
    return rows if kind == "all" else rows.filter(F.contains(F.col(type_), F.lit(kind)))


def section(highlight: Column, kind: Column, wanted: str = "all") -> Column:
    """Whether a row shows in the section ``wanted``: featured ones have a place of their own under "all" only."""
    return F.lit(True) if wanted == "all" else (F.coalesce(highlight, F.lit(0)) != 1) & F.contains(kind, F.lit(wanted))


def note_badge(note: Column, type_: Column, rules: list[tuple[str, str]], of_type: dict[str, str], otherwise: str) -> Column:
    """The badge of a note: by the type where it has one of its own, none for an empty note, else by the first word that it holds."""
    out = F.lit(otherwise)
    for word, label in reversed(rules):
        out = F.when(F.contains(note, F.lit(word)), F.lit(label)).otherwise(out)
    out = F.when(clean(note) == "", "").otherwise(out)
    for name, label in of_type.items():
        out = F.when(type_ == name, F.lit(label)).otherwise(out)
    return out


def tabs(df: DataFrame, text: list[str], query: str, year: str, chosen: str = "all") -> DataFrame:
    """Rows of the chosen year's tab; a query looks through all tabs."""
    if query:
        return df.filter(any_contains([F.col(c) for c in text], query))
    return df if chosen == "all" else df.filter(F.col(year).cast("string") == chosen)


def by_number(df: DataFrame, key: str) -> DataFrame:
    """``df`` in the order of a text key's number; keys that are none come last, by their text."""
    return df.orderBy(F.col(key).try_cast("bigint").asc_nulls_last(), key)


def changed_paths(path: Column, allowed: str, litter: str) -> Column:
    """What kind of change a path is: allowed, litter, or changed."""
    return F.when(path.rlike(allowed), "allowed").when(path.rlike(litter), "litter").otherwise("changed")


def awarded(display: Column, word: str = "Award") -> Column:
    """Whether what is shown beside a record, if anything, names an award."""
    return F.coalesce(F.contains(display, F.lit(word)), F.lit(False))


def board_filters(text: list[Column], query: str, year: Column, chosen_year: str, category: Column, chosen: str, paper_days: Column, days: Column, upcoming: bool, track: Column, workshop: Column, workshops: bool) -> list[Column]:
    """The board's filters; "all" chooses every year or category, and what is still to come goes by the paper's date where there is one."""
    out = [track == ""]
    if query.strip():
        out.append(F.contains(F.lower(F.concat_ws(" ", *text)), F.lit(query.strip().lower())))
    if chosen_year != "all":
        out.append(year.cast("string") == chosen_year)
    if chosen != "all":
        out.append(category == chosen)
    if upcoming:  # a date not known yet is to come
        out.append(F.coalesce(paper_days, days, F.lit(0)) >= 0)
    return out if workshops else [*out, ~workshop]
