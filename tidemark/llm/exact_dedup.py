"""Exact duplicates by 128-bit content hash, with the bytes compared inside each group.

Only DataFrame functions. A text is normalised and hashed to 128 bits (MD5). Classes are counted on
the hash and a SHA-256 digest alone, so no text is shuffled for a class of one. The texts of larger
classes are grouped by hash, digest and bytes; tasks combine what they hold first, so a class that
holds a third of all rows sends one row per task. Texts that only share the 128-bit hash are
different classes by their SHA-256; should two texts ever share both digests, the comparison of
bytes stops the query instead of answering wrongly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import MOST_BROADCAST, as_often, copied, cut, dealt_join, documents, row_hash, text_or_empty

#: White-space runs that are not already one space.
LONG_RUN = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text_col: str) -> Column:
    """The text with each run of white space replaced by one space; null is empty."""
    return F.regexp_replace(text_or_empty(text_col), LONG_RUN, " ")


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: _id, _row, _norm and _key, its two digests."""
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), row_hash(df).alias("_row"), normalised(text_col).alias("_norm"))
    return rows.select("*", F.concat(F.unhex(F.md5("_norm")), F.unhex(F.sha2("_norm", 256))).alias("_key"))


def _order() -> Column:
    return F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"))


def _classes(rows: DataFrame, brief: DataFrame) -> DataFrame:
    """Per class of equal texts: _key, the row that stays (smallest id, nulls last, then row hash) and its size."""
    classes = cut(brief.groupBy("_key").agg(F.min(_order()).alias("_keep"), F.sum("n").alias("group_size")))
    several = classes.filter("group_size > 1").select(F.col("_key").alias("_of"))
    wanted = F.broadcast(several) if several.count() <= MOST_BROADCAST else several
    held = rows.join(wanted, F.col("_key") == F.col("_of"), "left_semi")
    # Two texts with both digests in common would be two rows here.
    texts = held.groupBy("_key", "_norm").agg(F.count(F.lit(1)).alias("n")).groupBy(F.col("_key").alias("_of")).agg(F.count(F.lit(1)).alias("_texts"))
    one = F.when(F.coalesce("_texts", F.lit(1)) == 1, F.col("group_size")).otherwise(F.raise_error(F.lit("two texts share MD5 and SHA-256")).cast("bigint"))
    checked = classes.join(texts, F.col("_key") == F.col("_of"), "left")
    return checked.select("_key", F.col("_keep.id").alias("keep_id"), F.col("_keep.row").alias("_keep_row"), one.alias("group_size"))


def _stays() -> Column:
    return F.col("_id").eqNullSafe(F.col("keep_id")) & (F.col("_row") == F.col("_keep_row"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the smallest id stays. Null text counts as empty. Null ids lose to any other id;
    in a class of null ids keep_id is null and one row stays. Of rows that share the kept id the
    one with the smallest hash of the whole row stays, and of wholly equal rows any one. Texts of
    any length are hashed whole. Other columns play no part, whatever their names and kinds. An
    empty table gives an empty result.
    """
    rows = _rows(df, id_col, text_col)
    # Wholly equal rows are one here, with their number.
    brief = cut(rows.groupBy("_key", "_id", "_row").agg(F.count(F.lit(1)).alias("n")))
    figures = _classes(rows, brief)
    out = copied(dealt_join(brief, figures, "_key"), "n")
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size", (_stays() & (F.col("_copy") == 1)).alias("kept"), F.lower(F.hex(F.substring("_key", 17, 32))).alias("text_sha256"))


def without_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that :func:`exact_dedup` keeps, with all their columns; the same holds for odd rows.

    Only the rows that go, or that are there several times, are joined to the table again.
    """
    rows = _rows(df, id_col, text_col)
    brief = cut(rows.groupBy("_key", "_id", "_row").agg(F.count(F.lit(1)).alias("n")))
    figures = _classes(rows, brief).filter("group_size > 1")
    out = dealt_join(brief, figures, "_key").withColumn("times", _stays().cast("int")).filter("times <> n")
    return as_often(df, id_col, out.select("_id", "_row", "times"))


def op8_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


QUERIES = {"op8_exact_dedup": op8_exact_dedup}
SQL = {
    "op8_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY norm)
    """
}
