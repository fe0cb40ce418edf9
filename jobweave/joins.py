"""Joins against a table that is usually small, decided by its measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.config import Limits

DEFAULT_LIMITS = Limits()


def fits_broadcast(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> bool:
    """Whether ``df`` is within the broadcast bounds, measured by one aggregation over it."""
    sizes = [F.coalesce(F.length(F.to_json(F.struct(df[c]))), F.lit(0)) for c in df.columns]
    rows, size = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(sum(sizes[1:], sizes[0])), F.lit(0))
    ).first()
    return rows <= limits.broadcast_rows and size <= limits.broadcast_bytes


def content_hash(df: DataFrame) -> Column:
    """A hash of the whole row. Unlike a random number, a retried task gives the same one."""
    unhashable = ("map", "variant")
    return F.xxhash64(
        *(f.name for f in df.schema.fields
          if not any(kind in f.dataType.simpleString() for kind in unhashable))
    )


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Join ``rows`` with ``lookup`` without letting a hot key end in one task.

    ``lookup`` within the bounds is broadcast and ``rows`` does not move. Otherwise both sides
    are shuffled on (key, salt), with ``lookup`` repeated per salt, so that rows of one key
    spread over ``limits.salts`` tasks.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if fits_broadcast(lookup, limits):
        return rows.join(F.broadcast(lookup), keys, how)
    salted = rows.withColumn(
        "_salt", F.pmod(content_hash(rows), F.lit(limits.salts)).cast("int")
    )
    repeated = lookup.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(limits.salts - 1)))
    )
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
