"""Text cleaning as column expressions; Unicode folding and entity decoding as Arrow functions."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What stands for a value that isn't known yet.
PLACEHOLDERS = ("TBA", "TBD")
#: Elements whose content is no text, elements that strike text out, styles that do, and how tags split lines.
SILENT = ("script", "style", "svg", "noscript", "template")
STRUCK = ("s", "del", "strike")
STRUCK_STYLE = r"(?is)<(\w+)[^>]*(?:line-through|strikethrough)[^>]*>.*?</\1>"
LINE_ENDS = r"(?i)</(p|div|li|tr|td|th|h[1-6]|section|article|table|dd|dt)\s*>"
BREAKS = r"(?i)<(br|hr)\s*/?>"
INLINE = r"(?i)</?(b|i|em|strong|span|u|a|sup|sub|small|mark|code|abbr|time|font)\b[^>]*>"


def clean(c: Column) -> Column:
    """White space (Unicode) collapsed and trimmed; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\s+", " "))


def known(c: Column) -> Column:
    """The cleaned text, or null for empty and placeholder values."""
    text = clean(c)
    return F.when(F.upper(text).isin("", *PLACEHOLDERS), F.lit(None).cast("string")).otherwise(text)


def is_placeholder(c: Column) -> Column:
    """Empty, null or a placeholder in any case."""
    return F.upper(clean(c)).isin("", *PLACEHOLDERS)


def as_array(c: Column, kind: str = "string") -> Column:
    """Null and empty text as an empty array, any other text as an array of one; an array (``kind`` "array") less its nulls and blanks."""
    none = F.array().cast("array<string>")
    if kind == "array":
        return F.coalesce(F.filter(c, lambda x: F.coalesce(x, F.lit("")) != ""), none)
    return F.when(F.coalesce(c.cast("string"), F.lit("")) == "", none).otherwise(F.array(c.cast("string")))


def scalarised(c: Column) -> Column:
    """An array as it is written: nothing for none, the value of one as it is, several in brackets."""
    return F.when(F.size(c) == 1, F.get(c, F.lit(0))).when(F.size(c) > 1, F.concat(F.lit("["), F.array_join(c, ", "), F.lit("]")))


def shown(c: Column, not_yet: str = "To appear") -> Column:
    """The cleaned text of a field that is to be shown, null where it is empty or not there yet."""
    return F.nullif(F.nullif(clean(c), F.lit("")), F.lit(not_yet))


def name_and_place(c: Column, mark: str = " (") -> tuple[Column, Column]:
    """A name and the affiliation in brackets behind it, empty where there is none."""
    text = clean(c)
    return F.split_part(text, F.lit(mark), F.lit(1)), F.replace(F.when(F.contains(text, F.lit(mark)), F.split_part(text, F.lit(mark), F.lit(2))).otherwise(""), F.lit(")"), F.lit(""))


def escape_html(c: Column) -> Column:
    out = F.coalesce(c.cast("string"), F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def _without(c: Column, begins: str, pattern: str) -> Column:
    """``c`` less what a pattern with a search for an end finds; it runs only over texts that hold a beginning."""
    return F.get(F.transform(F.array(c), lambda t: F.when(t.rlike(begins), F.regexp_replace(t, pattern, " ")).otherwise(t)), F.lit(0))


def _pair(tags: Iterable[str], rest: str) -> tuple[str, str]:
    return rf"(?i)<({'|'.join(tags)})\b", rf"(?is)<({'|'.join(tags)})\b{rest}.*?</\1>"


def without_silent(c: Column) -> Column:
    """Markup less its comments, which go first so that what they hide never comes back, and its silent elements."""
    return _without(_without(F.coalesce(c, F.lit("")), "(?s)<!--", r"(?s)<!--.*?-->"), *_pair(SILENT, ""))


def strip_markup(c: Column) -> Column:
    """Readable text of HTML, entities left as they are.

    Comments go first, so that what they hide never comes back; then silent and struck elements with
    all they hold, struck by style too. Block ends and breaks become line ends, inline tags vanish,
    every other tag becomes a space.
    """
    out = _without(_without(without_silent(c), *_pair(STRUCK, "[^>]*>")), "(?i)line-through|strikethrough", STRUCK_STYLE)
    for pattern, new in ((BREAKS, "\n"), (LINE_ENDS, "\n"), (INLINE, ""), (r"<[^>]+>", " ")):
        out = F.regexp_replace(out, pattern, new)
    return out


#: Characters of no width, dashes, and quotes with their plain forms.
NO_WIDTH, DASHES, QUOTES = "\u200b\u200c\u200d\ufeff\u00ad", "[\u2010-\u2015\u2212]", ("\u2018\u2019\u201b\u201c\u201d", "\'\'\'\"\"")


@F.pandas_udf(T.StringType())
def _unescaped(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape_html(c: Column) -> Column:
    """Entities decoded; only texts that hold one go through Python."""
    return F.coalesce(_unescaped(F.when(F.contains(c, F.lit("&")), c)), c)


def fold_text(text: str) -> str:
    """NFKC and case folding of one text."""
    return unicodedata.normalize("NFKC", text).casefold()


@F.pandas_udf(T.StringType())
def _folded(texts: pd.Series) -> pd.Series:
    return texts.map(fold_text, na_action="ignore")


def fold(c: Column) -> Column:
    """NFKC and case folding; ASCII texts only need lower case, and no other goes through Python."""
    plain = c.rlike(r"\A\p{ASCII}*\z")
    return F.when(plain, F.lower(c)).otherwise(_folded(F.when(~plain, c)))


def normalise(c: Column) -> Column:
    """Folded text with plain spaces, dashes and quotes, and no zero-width characters."""
    out = F.translate(fold(F.coalesce(c, F.lit(""))), NO_WIDTH, "")
    out = F.regexp_replace(out, DASHES, "-")
    out = F.translate(out, *QUOTES)
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def flat(normalised: Column) -> Column:
    """Letters a-z and digits with single spaces; ordinal endings of numbers dropped."""
    return F.trim(F.regexp_replace(F.regexp_replace(normalised, r"(\d)(st|nd|rd|th)\b", "$1"), r"[^a-z0-9]+", " "))


def tokens(flattened: Column) -> Column:
    """Runs of letters and runs of digits."""
    return F.regexp_extract_all(flattened, F.lit(r"([a-z]+|\d+)"), F.lit(1))


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """The template with each ``{name}`` replaced by its column; unknown names stay, null is empty."""
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def shortened(c: Column, most: int = 55) -> Column:
    """At most ``most`` characters, an ellipsis for what is cut."""
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("…"))).otherwise(c)


def truncated_words(c: Column, most: int) -> Column:
    """The first words with single spaces, dots for what is cut."""
    words = F.split(clean(c), " ")
    return F.concat(F.array_join(F.slice(words, 1, most), " "), F.when(F.size(words) > most, "...").otherwise(""))


def capitalised(c: Column) -> Column:
    """The first letter in upper case, the rest in lower case."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def any_contains(fields: Iterable[Column], needle: str) -> Column:
    """Whether the needle occurs in any field, case aside."""
    out = F.lit(False)
    for f in fields:
        out = out | F.contains(F.lower(F.coalesce(f, F.lit(""))), F.lit(needle.lower()))
    return out


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two arrays, by rolling rows."""
    start = F.array_repeat(F.lit(0), F.size(b) + 1)

    def row(previous: Column, x: Column) -> Column:
        cells = F.zip_with(F.slice(previous, F.lit(1), F.size(b)), b, lambda p, y: F.struct(p.alias("diagonal"), (x == y).alias("same")))
        indexed = F.zip_with(cells, F.slice(previous, F.lit(2), F.size(b)), lambda c, up: F.struct(c["diagonal"], c["same"], up.alias("up")))
        return F.aggregate(indexed, F.array(F.lit(0)), lambda out, c: F.concat(out, F.array(F.when(c["same"], c["diagonal"] + 1).otherwise(F.greatest(F.element_at(out, -1), c["up"])))))

    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0)).otherwise(F.element_at(F.aggregate(a, start, row), -1))
