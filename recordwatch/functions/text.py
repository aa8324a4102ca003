"""Text functions as native column expressions; one Arrow UDF where Catalyst has no Unicode normal forms."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType

#: Every run of Unicode white space (plain \s would leave no-break blanks).
BLANKS = r"(?U)[\s\x1C-\x1F]+"
# Typographic characters and what they are read as.
TYPOGRAPHIC = {"‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", " ": " "}


def collapse(text: Column) -> Column:
    """Trimmed text with single blanks; null becomes empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " "))


def clean_text(text: Column, limit: int | None = None) -> Column:
    """Collapsed text, cut to ``limit`` characters without a blank at the end."""
    flat = collapse(text)
    return F.rtrim(F.substring(flat, 1, limit)) if limit else flat


def excerpt(text: Column, limit: int) -> Column:
    """At most ``limit`` characters, the last an ellipsis where something was cut."""
    return F.when(F.char_length(text) > limit, F.concat(F.rtrim(F.substring(text, 1, limit - 1)), F.lit("…"))).otherwise(text)


def line_excerpt(text: Column, limit: int) -> Column:
    """An excerpt on one line: line ends as blanks, none at the ends; null becomes empty."""
    return excerpt(F.trim(F.translate(F.coalesce(text, F.lit("")), "\r\n", "  ")), limit)


def cell_excerpt(text: Column, limit: int) -> Column:
    """An excerpt for a Markdown table, cut after it is escaped."""
    return excerpt(table_cell(text), limit)


def semantic_text_ascii(text: Column) -> Column:
    """Semantic normal form of texts without entities, where only typographic characters and blanks matter."""
    return collapse(F.translate(text, "".join(TYPOGRAPHIC), "".join(TYPOGRAPHIC.values())))


@F.pandas_udf(StringType())
def _semantic(values: pd.Series) -> pd.Series:
    table = str.maketrans(TYPOGRAPHIC)
    return values.map(lambda v: " ".join(unicodedata.normalize("NFKC", html.unescape(v)).translate(table).split()), na_action="ignore").fillna("")


def semantic_text(text: Column) -> Column:
    """Semantic normal form: entities, NFKC, typographic characters, blanks. Null becomes empty.

    ASCII texts without an ampersand have neither entities nor other letters and are done in the JVM; only the rest is handed to an
    Arrow UDF over whole batches.
    """
    plain = F.coalesce(text.rlike(r"^[\x00-%'-\x7F]*$"), F.lit(True))
    return F.when(plain, semantic_text_ascii(text)).otherwise(_semantic(F.when(~plain, text)))


def is_empty(value: Column) -> Column:
    """Null, or a text without characters; one class of emptiness for all comparisons."""
    return value.isNull() | (value.cast("string") == "")


def is_empty_of(value: Column, kind: DataType) -> Column:
    """The same for a value of any kind: lists and mappings without entries are empty too, a number never is."""
    if isinstance(kind, (ArrayType, MapType)):
        return value.isNull() | (F.size(value) == 0)
    return is_empty(value) if isinstance(kind, StringType) else value.isNull()


def n_filled(df: DataFrame, columns: list[str]) -> Column:
    """How many of a table's ``columns``, of whatever kind, are not empty."""
    return sum((F.when(is_empty_of(F.col(c), df.schema[c].dataType), 0).otherwise(1) for c in columns), F.lit(0))


def completeness(*values: Column) -> Column:
    """How many of the values are not empty."""
    return sum((F.when(is_empty(v), 0).otherwise(1) for v in values), F.lit(0))


def grows(before: Column, after: Column) -> Column:
    """Whether ``after`` holds all of ``before`` and more, without regard to case."""
    old, new = F.lower(before), F.lower(after)
    return (old != "") & (new != "") & (old != new) & F.contains(new, old)


def matched_keywords(text: Column, keywords: list[str]) -> Column:
    """Sorted array of the keywords that occur in the text, in lower case."""
    known = F.array(*[F.lit(k.lower()) for k in keywords])
    return F.array_sort(F.array_distinct(F.filter(known, lambda k: F.contains(F.lower(F.coalesce(text, F.lit(""))), k))))


def first_filled(*values: Column) -> Column:
    """The first value that isn't blank, collapsed."""
    return F.coalesce(*[F.nullif(collapse(v), F.lit("")) for v in values])


def truthy_or(value: Column, other: Column) -> Column:
    """``value`` unless it is null, empty or zero."""
    text = value.cast("string")
    return F.when(value.isNull() | text.isin("", "0", "0.0", "false"), other).otherwise(value)


def table_cell(text: Column) -> Column:
    """Text for a Markdown table: bars escaped, line ends as blanks."""
    return F.replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"\r?\n", " "), F.lit("|"), F.lit("\\|"))


def link(url: Column, label: Column) -> Column:
    return F.when(is_empty(url), F.lit("-")).otherwise(F.concat(F.lit("["), table_cell(label), F.lit("]("), url, F.lit(")")))


def truthy(text: Column) -> Column:
    return F.lower(F.trim(F.coalesce(text, F.lit("")))).isin("1", "true", "yes", "on")


def optional_number(text: Column) -> Column:
    """A whole number, or null for what isn't one."""
    return F.expr("null") if text is None else text.try_cast("bigint")


# Shapes of access keys, and of addresses in text.
SECRET_SHAPES = r"sk-[A-Za-z0-9_\-]{20,}|ghp_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}"
URL_SHAPE = r"https?://[^\s<>\"')]+"


def has_secret(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(SECRET_SHAPES)


def urls_in(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(URL_SHAPE), F.lit(0))
