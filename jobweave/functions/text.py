"""Cleaning of ad texts as column expressions.

Only the entity step needs Python: Spark has no such function. Nulls pass through every step.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from jobweave import fixed


@F.pandas_udf(StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


# The optimizer copies a deterministic expression to each place that reads it, and with it
# the whole cleaning chain; it leaves one that may not be repeated in its place.
_unescape = _unescape.asNondeterministic()


def unescape_entities(text: Column) -> Column:
    """HTML entities to characters. Texts without ``&`` are not sent to Python."""
    return F.coalesce(_unescape(F.when(F.contains(text, F.lit("&")), text)), text)


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, fixed.TAG_PATTERN, " ")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, fixed.URL_PATTERN, " ")


def strip_notices(text: Column) -> Column:
    for notice in (fixed.JAVASCRIPT_NOTICE, fixed.CAPTCHA_NOTICE):
        text = F.replace(text, F.lit(notice), F.lit(" "))
    return text


def strip_stars(text: Column) -> Column:
    return F.regexp_replace(text, fixed.STAR_PATTERN, " ")


def plain_spaces(text: Column) -> Column:
    return F.replace(text, F.lit(fixed.NO_BREAK_SPACE), F.lit(" "))


def squeeze_spaces(text: Column) -> Column:
    """Two or more whitespace characters to one space; a single newline stays."""
    return F.regexp_replace(text, fixed.SPACES_PATTERN, " ")


def strip(text: Column) -> Column:
    """Unicode whitespace off both ends (``trim`` only knows the space)."""
    return F.trim(text, F.lit(fixed.WHITESPACE))


def clean_text(text: Column) -> Column:
    """All steps; entities come first, so that an escaped tag is removed as a tag."""
    for step in (
        unescape_entities, strip_tags, strip_urls, strip_notices,
        strip_stars, plain_spaces, squeeze_spaces, strip,
    ):
        text = step(text)
    return text


def eol_to_space(text: Column) -> Column:
    return F.translate(text, "\r\n", "  ")


def word_text(text: Column) -> Column:
    """Lower-case runs of letters with one space between (and perhaps around) them."""
    return F.regexp_replace(F.lower(text), r"\P{L}+", " ")


def words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.array_remove(F.split(F.lower(text), r"\P{L}+"), "")


def na_to_null(df: DataFrame) -> DataFrame:
    """Texts that stand for a missing value to null, in every string column."""
    strings = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(
        *(
            F.when(~F.col(c).isin(fixed.NA_TOKENS), F.col(c)).alias(c) if c in strings else F.col(c)
            for c in df.columns
        )
    )


def clean_ads(df: DataFrame, title: str = "title", description: str = "description") -> DataFrame:
    """Add the clean columns and let the title stand in for a missing description.

    Both columns are cleaned before the fallback; a description that is blank after cleaning
    keeps its raw text and takes only the clean title.
    """
    title_clean, description_clean = F.col("title_clean"), F.col("description_clean")
    filled = F.coalesce(description_clean, title_clean)
    return (
        df.withColumns(
            {
                "description_clean": clean_text(F.col(description)),
                "title_clean": clean_text(F.col(title)),
            }
        )
        .withColumns(
            {
                description: F.coalesce(F.col(description), F.col(title)),
                "description_clean": F.when(strip(filled) == "", title_clean).otherwise(filled),
            }
        )
    )
