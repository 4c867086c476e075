"""Sources: tagged unions, partial failures, nested feeds to candidates; sinks: JSON and indexes (see ``versions`` for tables that change)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.functions.text import escape_html, truncated_words

#: Fixed value: comments of timeline entries that are no paper cycle.
NO_CYCLE = r"(?i)abstract|registration|notification|camera[ -]?ready|workshop"


def tagged_union(parts: list[tuple[str, int, DataFrame]]) -> DataFrame:
    """All rows of all sources, each with its source's name and priority; columns that one lacks are null."""
    tagged = [df.withColumn("source", F.lit(name)).withColumn("priority", F.lit(p)) for name, p, df in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def read_available(spark: SparkSession, paths: dict[str, str], format_: str = "parquet") -> tuple[dict[str, DataFrame], list[tuple[str, str]]]:
    """Readers for the sources that are there, and name and reason of those that aren't."""
    good, failed = {}, []
    for name, path in paths.items():
        try:
            good[name] = spark.read.format(format_).load(path)
        except AnalysisException as e:
            failed.append((name, e.getCondition() or type(e).__name__))
    return good, failed


def read_json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON documents; what doesn't parse is null rather than an error."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path)


def parsed_documents(df: DataFrame, c: str, schema: str) -> DataFrame:
    """``df`` with ``document``, a JSON text by its schema; null where it isn't one."""
    return df.withColumn("document", F.from_json(F.col(c), schema, {"mode": "PERMISSIVE"}))


def scanned(good: dict[str, DataFrame], failed: list[tuple[str, str]], spark: SparkSession) -> DataFrame:
    """A row per source: name, whether it could be read, and its number of rows; one that failed has none."""
    rows = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), F.lit(True).alias("ok"), "n") for name, df in good.items()]
    lost = spark.createDataFrame([(name, False, 0) for name, _ in failed], "name string, ok boolean, n bigint")
    return reduce(DataFrame.unionByName, rows, lost)


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """A folder of partitions; files that vanish meanwhile count as empty."""
    return spark.read.option("ignoreMissingFiles", True).parquet(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Landed files, one row each: path and whole text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def blocks(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Blocks of a list file, raw, each from its ``- `` to the next: id, nth, block."""
    parts = F.filter(F.split(F.col(text), r"(?m)^(?=- )"), lambda b: F.startswith(b, F.lit("- ")))
    return df.select(id_col, F.posexplode(parts).alias("nth", "block"))


def several_editions(df: DataFrame, key: str, entries: str, min_year: int, max_year: int, skip: str) -> DataFrame:
    """Candidates of a feed whose entries hold a timeline: key, year, deadlines, abstracts.

    Timeline entries whose comment says that they are no paper cycle count only if they have an
    abstract date of their own. Entries outside the years, or without a deadline, are left out; an
    entry without a timeline fails the query.
    """
    rows = df.select(key, F.explode(entries).alias("e")).filter(F.col("e.year").between(min_year, max_year))
    line = F.when(F.col("e.timeline").isNull(), F.raise_error(F.lit("entry without a timeline"))).otherwise(F.col("e.timeline"))
    kept = F.filter(line, lambda t: t["deadline"].isNotNull() & (~F.coalesce(t["comment"], F.lit("")).rlike(skip) | t["abstract"].isNotNull()))
    rows = rows.select(key, F.col("e.year").alias("year"), kept.alias("_t")).filter(F.size("_t") > 0)
    return rows.select(key, "year", F.transform("_t", lambda t: t["deadline"]).alias("deadlines"), F.transform("_t", lambda t: t["abstract"]).alias("abstracts"))


def single_edition(df: DataFrame, key: str, name: str, locators: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that a locator (key, name, description_contains or null) finds alone, and the keys that find none or several."""
    wanted = locators.withColumnRenamed(name, "_wanted")
    rows = wanted.join(df, F.col("_wanted") == F.col(name), "left")
    fits = F.col("description_contains").isNull() | F.contains(F.coalesce(F.col("description"), F.lit("")), F.col("description_contains"))
    rows = rows.withColumn("_fits", fits & F.col(name).isNotNull()).withColumn("_hits", F.count_if("_fits").over(Window.partitionBy(key)))
    return rows.filter("_hits = 1 AND _fits").drop("_hits", "_fits", "_wanted"), rows.filter("_hits <> 1").select(key, F.col("_hits").alias("hits")).distinct()


def expand_year(value: Column, year: Column) -> Column:
    """``%y`` for the year and ``%Y`` for the year before."""
    return F.replace(F.replace(value, F.lit("%Y"), (year - 1).cast("string")), F.lit("%y"), year.cast("string"))


def with_defaults(config: DataFrame, priority: list[str]) -> DataFrame:
    """The dimension with the default priority where none is given, less the sources that a row doesn't map."""
    given = F.coalesce("priority", F.array(*map(F.lit, priority)))
    return config.withColumn("priority", F.filter(given, lambda s: F.map_contains_key("sources", s)))


def record_text(fields: list[tuple[str, Column]]) -> Column:
    """``- name: value`` lines in the given order, strings quoted, null fields left out."""
    lines = [F.when(v.isNotNull(), F.concat(F.lit(f"{n}: '"), F.replace(v.cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))) for n, v in fields]
    return F.concat(F.lit("- "), F.concat_ws("\n  ", *lines))


def assembled(df: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """One text per key: the rows' texts in order, a blank line between them."""
    return df.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda s: s[text]), "\n\n").alias("content"))


def json_lines(df: DataFrame, keep_nulls: bool = False) -> DataFrame:
    """Each row as JSON; with ``keep_nulls`` null fields are written as null, which an override needs."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value"))


def checked_overrides(df: DataFrame, titles: DataFrame, title: str, year: str, order: str) -> DataFrame:
    """Overrides with a reason: unknown title, no year, or repeated key; the first of a key has none."""
    known = titles.select(F.col(title).alias("_title")).distinct()
    rows = df.join(known, F.col(title) == F.col("_title"), "left")
    nth = F.row_number().over(Window.partitionBy(title, year).orderBy(order))
    reason = F.when(F.col("_title").isNull(), "unknown title").when(F.col(year).isNull(), "no year").when(nth > 1, "repeated")
    return rows.withColumn("reason", reason).drop("_title")


def search_index(df: DataFrame, keys: list[str], order: str, fields: list[str]) -> DataFrame:
    """One JSON array per key with the rows' fields in order."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(order, F.struct(*fields).alias("_row")))), lambda s: s["_row"])
    return df.groupBy(*keys).agg(F.to_json(rows).alias("content"))


def watchlist_json(df: DataFrame, order: list[str]) -> DataFrame:
    """A watchlist as JSON lines in its order: rank, then ``order``; null fields are left out."""
    return json_lines(df.orderBy("rank", *order))


def verdict_json(verdicts: DataFrame) -> DataFrame:
    """Verdicts (id, status, ...) as JSON lines: id, whether it is accepted or rejected, the gate's own status, and the rest as detail."""
    rest = [c for c in verdicts.columns if c not in ("id", "status", "accepted")]
    said = F.when(F.col("status") == "VERIFIED", "accepted").otherwise("rejected")
    return json_lines(verdicts.select("id", said.alias("status"), F.col("status").alias("gate"), F.struct(*rest).alias("detail")))


def feed_items(df: DataFrame, title: str, body: str, at: str, link: str, words: int = 30) -> DataFrame:
    """``item`` elements of a feed: texts escaped, the body cut to its first words, the time as in RFC 822 (UTC)."""
    short = truncated_words(F.col(body), words)
    when, url = F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), escape_html(F.col(link))
    item = F.concat(
        F.lit("<item><title>"), escape_html(F.col(title)), F.lit("</title><description>"), escape_html(short), F.lit("</description><pubDate>"), when,
        F.lit(" +0000</pubDate><link>"), url, F.lit('</link><guid isPermaLink="true">'), url, F.lit("</guid></item>"),
    )
    return df.withColumn("item", item)
