"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobweave.storage import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node in ``links`` (columns ``a``, ``b``); the root is the smallest node.

    Alternates two steps until nothing changes: every node ties its larger neighbours to its
    smallest one, then its smaller neighbours. Each round is stored in the shared folder, which
    cuts lineage. A hub's rows only meet its one minimum in a join, which adaptive execution can split.
    Null ends and self-links tie nothing.
    """
    edges = materialise(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(smallest, "a").where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(least, "a")
        small = tied.select("a", F.col("m").alias("b")).unionByName(
            tied.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        edges = materialise(small, "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Number and checksum of the links."""
    mixed = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mixed)).first())
