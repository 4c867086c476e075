"""Names to a small dimension by ordered aliases, and search over text fields."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import clean

#: Aliases that are sent to every task inside the expression; more are joined by their words.
MOST_ALIASES = 2_000


def alias_match(df: DataFrame, id_col: str, title: str, aliases: list[tuple[str, str]], most: int = MOST_ALIASES) -> DataFrame:
    """``df`` with ``target``: the first alias, in list order, that the title is, starts or ends with, or holds as words.

    Case and white space don't count. Null where nothing matches. A few aliases are compared inside the
    row as an array. More than ``most`` are joined by equality with the runs of words of the title that
    are as long as an alias is.
    """
    listed = [(" ".join(a.lower().split()), t) for a, t in aliases]
    words = F.lower(clean(F.col(title)))
    if len(aliases) <= most:
        # A title with a space at either end holds exactly the aliases that stand between spaces in it.
        padded = F.concat(F.lit(" "), words, F.lit(" "))
        table = F.array(*[F.struct(F.lit(f" {a} ").alias("alias"), F.lit(t).alias("target")) for a, t in listed])
        hits = F.filter(table, lambda x: F.contains(padded, x["alias"]))
        return df.withColumn("target", F.get(hits, F.lit(0))["target"])
    by = df.sparkSession.createDataFrame([(a, i, t) for i, (a, t) in enumerate(listed)], "_alias string, _ordinal int, _target string")
    by = by.groupBy("_alias").agg(F.min(F.struct("_ordinal", "_target")).alias("_hit"))
    parts = F.split("_words", " ")
    runs = lambda n: F.transform(F.sequence(F.lit(1), F.size(parts) - n + 1), lambda i: F.array_join(F.slice(parts, i, n), " "))
    every = F.array_distinct(F.concat(*[F.when(F.size(parts) >= n, runs(n)).otherwise(F.array().cast("array<string>")) for n in sorted({len(a.split(" ")) for a, _ in listed})]))
    # Titles are matched once each.
    titles = df.select(words.alias("_words")).distinct()
    found = titles.select("_words", F.explode(every).alias("_alias")).join(by, "_alias").groupBy("_words").agg(F.min("_hit")["_target"].alias("target"))
    return df.withColumn("_words", words).join(found, "_words", "left").select(*df.columns, "target")


def literal_hit(fields: list[Column], query: str) -> Column:
    """Whether some one field holds every word of the query, case aside."""
    out = F.lit(False)
    for f in fields:
        every = F.lit(True)
        for word in query.lower().split(" "):
            every = every & F.contains(F.lower(F.trim(F.coalesce(f.cast("string"), F.lit("")))), F.lit(word))
        out = out | every
    return out


def fuzzy_hit(fields: list[Column], query: str) -> Column:
    """Whether the query's characters occur in order in some one field, case aside."""
    pattern = "(?is)" + ".*?".join(re.escape(c) for c in query)
    out = F.lit(False)
    for f in fields:
        out = out | F.coalesce(f.cast("string"), F.lit("")).rlike(pattern)
    return out


def not_excluded(fields: list[Column], patterns: list[str]) -> Column:
    """No field matches a pattern."""
    out = F.lit(True)
    for f in fields:
        for p in patterns:
            out = out & ~F.coalesce(f.cast("string"), F.lit("")).rlike(p)
    return out


def search(df: DataFrame, fields: list[str], query: str, ordinal: str, limit: int = 10, fuzzy: bool = False, exclude: list[str] | None = None) -> DataFrame:
    """The first ``limit`` hits in order of ``ordinal``. An empty query finds nothing."""
    if not query:
        return df.limit(0)
    columns = [F.col(f) for f in fields]
    hit = (fuzzy_hit if fuzzy else literal_hit)(columns, query)
    return df.filter(hit & not_excluded(columns, exclude or [])).orderBy(ordinal).limit(limit)


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row per key."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).filter("_n = 1").drop("_n")
