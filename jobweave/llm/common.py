"""What several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Characters that separate words; every other character belongs to one.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hash60(*parts: Column) -> Column:
    """The first 60 bits of an MD5 over the texts of ``parts``; a null part counts as a NUL."""
    text = F.concat_ws("\x01", *(F.coalesce(p.cast("string"), F.lit("\0")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def replace_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that a result is about to bring, whatever their case."""
    taken = {n.lower() for n in names}
    return df.drop(*(c for c in df.columns if c.lower() in taken))
