"""From model answers to codes: attaching, validating, labelling, submitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.config import Limits
from jobweave.functions.answers import parse_classification, parse_translation
from jobweave.joins import DEFAULT_LIMITS, lookup_join
from jobweave.sources.tables import code_table


def apply_overrides(
    df: DataFrame,
    overrides: DataFrame,
    key: str = "id",
    column: str = "description",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Replace ``column`` for the keys in ``overrides(key, column)``; the rest stays."""
    chosen = overrides.groupBy(key).agg(F.max(column).alias("_override"))
    return (
        lookup_join(df, chosen, key, "left", limits)
        .withColumn(column, F.coalesce("_override", column))
        .select(*df.columns)
    )


def attach_results(rows: DataFrame, results: DataFrame, key: str | list[str] = "id") -> DataFrame:
    """Rows with the results of the same key; which join it is, is left to the optimizer."""
    return rows.join(results, key, "inner")


def first_labels(labels: DataFrame) -> DataFrame:
    """``code, label_code``: where a code has several rows, the first in load order."""
    order = F.col("pos") if "pos" in labels.columns else F.monotonically_increasing_id()
    return (
        labels.select("code", "label", order.alias("_pos"))
        .groupBy("code")
        .agg(F.min_by("label", "_pos").alias("label_code"))
    )


def validate_codes(
    df: DataFrame,
    labels: DataFrame,
    codes: DataFrame | None = None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Check ``class_code`` and look up its label in one lookup.

    An unknown or missing code makes the row not codable and clears its likelihood; the code
    itself stays as it was answered. A valid code keeps what the answer said, also when
    that is not codable. A valid code without a label gets a null label.
    """
    valid = (code_table(labels) if codes is None else codes.select("code").distinct()).join(
        first_labels(labels), "code", "left"
    )
    lookup = valid.select(
        F.col("code").alias("class_code"), "label_code", F.lit(True).alias("_valid")
    )
    known = F.coalesce("_valid", F.lit(False))
    return lookup_join(df, lookup, "class_code", "left", limits).select(
        *[c for c in df.columns if c not in ("codable", "class_code", "likelihood")],
        (F.col("codable") & known).alias("codable"),
        "class_code",
        F.when(known, F.col("likelihood")).alias("likelihood"),
        "label_code",
        known.alias("valid_code"),
    )


def read_translations(
    df: DataFrame,
    raw: str = "raw_translations",
    coerce_objects: bool = False,
    too_long: Column | None = None,
) -> DataFrame:
    """Add ``job_desc_extracted, title_en, description_en, keywords, outcome`` to each row.

    Columns of these names are replaced. ``too_long`` tells prompts that were never sent.
    """
    df = df.drop("job_desc_extracted", "title_en", "description_en", "keywords", "outcome")
    return df.withColumn("_r", parse_translation(F.col(raw), coerce_objects)).select(
        *df.columns,
        F.col("_r.job_desc_extracted"),
        F.col("_r.title").alias("title_en"),
        F.col("_r.description").alias("description_en"),
        F.col("_r.keywords"),
        F.when(F.lit(False) if too_long is None else too_long, "too_long")
        .when(F.col("_r.parsed"), "ok").otherwise("parse_error").alias("outcome"),
    )


def read_classifications(
    df: DataFrame,
    labels: DataFrame,
    raw: str = "raw_responses",
    codes: DataFrame | None = None,
    coerce_objects: bool = False,
    limits: Limits = DEFAULT_LIMITS,
    too_long: Column | None = None,
) -> DataFrame:
    """Add ``codable, class_code, likelihood, label_code, outcome`` to each row.

    Columns of these names are replaced. ``too_long`` tells prompts that were never sent.
    """
    df = df.drop("codable", "class_code", "likelihood", "label_code", "outcome", "valid_code", "parsed")
    parsed = df.withColumn("_r", parse_classification(F.col(raw), coerce_objects)).select(
        *df.columns, "_r.parsed", "_r.codable", "_r.class_code", "_r.likelihood"
    )
    checked = validate_codes(parsed, labels, codes, limits)
    return checked.withColumn(
        "outcome",
        F.when(F.lit(False) if too_long is None else too_long, "too_long")
        .when(~F.col("parsed"), "parse_error")
        .when(~F.col("valid_code"), "invalid_code")
        .otherwise("ok"),
    ).drop("parsed", "valid_code")


def submission(df: DataFrame, key: str = "id", compat: bool = False) -> DataFrame:
    """Key and code, without the codes of rows that are not codable.

    ``compat`` keeps those codes: the comparison that should blank them never matches there.
    """
    code = F.col("class_code") if compat else F.when(F.col("codable"), F.col("class_code"))
    return df.select(key, code.alias("class_code"))
