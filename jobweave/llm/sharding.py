"""Sharding by extendible hashing, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobweave.joins import lookup_join
from jobweave.llm.common import hash60, replace_columns
from jobweave.storage import materialise

HASH_BITS = 60
#: Bits that one pass over the rows counts; the cells of a pass are at most two to this power.
PASS_BITS = 20


def extendible_shards(
    df: DataFrame, key: list[str], size: Column, limit: int, pass_bits: int = PASS_BITS
) -> DataFrame:
    """Add ``n_bytes``, ``depth``, ``shard`` (the hash-prefix bits of the row's bucket) to each row.

    All rows start in one bucket. A bucket over ``limit`` bytes splits on the next bit of the hash of
    ``key``, one that fits stays, so depths differ. Rows are counted per cell of ``pass_bits`` bits, and
    the splitting works on these counts; only cells that are still too large are counted deeper. A
    bucket in which all rows have the same hash cannot be split by it: a single row
    over the limit has such a bucket to itself, and many rows of one key (a hot key, repeated rows) go
    on splitting on the bits of a second hash, of a number given to each such row and stored.

    A null size counts as 0, null keys are a value like any other. An empty table gives an empty
    result. Columns named like the results are replaced.
    """
    rows = replace_columns(df, "n_bytes", "depth", "shard", "_hash", "_prefix", "_cell", "_at")
    hashed = hash60(*(F.col(k) for k in key))
    rows = rows.withColumn("n_bytes", F.coalesce(size.cast("long"), F.lit(0))).withColumn("_hash", hashed)
    placed, stuck = _place(rows, limit, pass_bits)
    if stuck is not None:
        numbered = stuck.withColumn("_copy", F.monotonically_increasing_id())
        numbered = materialise(numbered, "hot-keys").withColumnsRenamed({"depth": "_depth", "shard": "_shard"})
        numbered = numbered.withColumn("_hash", hash60(F.col("_copy"))).drop("_copy")
        again, _ = _place(numbered, limit, pass_bits)
        again = again.withColumn("depth", F.col("_depth") + F.col("depth")).withColumn(
            "shard", F.concat("_shard", "shard")
        )
        placed = placed.unionByName(again.drop("_depth", "_shard"))
    return placed.drop("_hash")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard; the rows of a shard are written by the task that holds it."""
    sharded.repartition("shard").write.mode("overwrite").partitionBy("shard").parquet(path)


def _place(rows: DataFrame, limit: int, pass_bits: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows with their bucket; and rows of buckets that many rows of one hash overfill, or None."""
    leaves = _directory(rows, limit, pass_bits)
    depths = [r["depth"] for r in leaves.select("depth").distinct().orderBy("depth").collect()]
    if not depths:
        return rows.withColumn("depth", F.lit(0)).withColumn("shard", F.lit("")), None
    leaves = leaves.withColumn("many", (F.col("bytes") > limit) & (F.col("n") > 1))
    found = []
    for low, high in _bands(depths):
        # The directory of a band has an entry for each prefix of ``high`` bits.
        entries = leaves.where(F.col("depth").between(low, high)).select(
            F.explode(F.expr(
                f"sequence(shiftleft(prefix, {high} - depth), shiftleft(prefix + 1, {high} - depth) - 1)"
            )).alias("_at"),
            F.struct("depth", "prefix", "many").alias(f"_leaf{high}"),
        )
        rows = rows.withColumn("_at", _prefix(F.col("_hash"), high))
        rows = lookup_join(rows, entries, "_at").drop("_at")
        found.append(f"_leaf{high}")
    leaf = F.coalesce(*found)
    rows = rows.withColumn("depth", leaf["depth"]).withColumn("_many", leaf["many"]).withColumn(
        "shard", F.when(leaf["depth"] == 0, "").otherwise(
            F.lpad(F.bin(leaf["prefix"]), leaf["depth"], F.lit("0")))
    ).drop(*found)
    if leaves.where("many").isEmpty():
        return rows.drop("_many"), None
    return rows.where(~F.col("_many")).drop("_many"), rows.where("_many").drop("_many")


def _bands(depths: list[int], width: int = 6) -> list[tuple[int, int]]:
    """Ranges of at most ``width`` depths, so that entries per bucket stay few."""
    bands: list[tuple[int, int]] = []
    for depth in depths:
        if bands and depth - bands[-1][0] < width:
            bands[-1] = (bands[-1][0], depth)
        else:
            bands.append((depth, depth))
    return bands


def _prefix(value: Column, bits: int) -> Column:
    return F.shiftright(value, HASH_BITS - bits)


def _directory(rows: DataFrame, limit: int, pass_bits: int) -> DataFrame:
    """The buckets that no longer split: ``depth, prefix, bytes, n``."""
    leaves, open_rows, above = None, rows.select("_hash", "n_bytes"), 0
    while True:
        below = min(HASH_BITS, above + pass_bits)
        cells = materialise(
            open_rows.groupBy(_prefix(F.col("_hash"), below).alias("cell")).agg(
                F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("n"),
                F.min("_hash").alias("low"), F.max("_hash").alias("high"),
            ),
            "cells",
        )
        buckets = (
            cells.withColumn("depth", F.explode(F.sequence(F.lit(above), F.lit(below))))
            .groupBy("depth", F.expr(f"shiftright(cell, {below} - depth)").alias("prefix"))
            .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"),
                 F.min("low").alias("low"), F.max("high").alias("high"))
            .withColumn("fits", (F.col("bytes") <= limit) | (F.col("low") == F.col("high")))
        )
        buckets = materialise(buckets, "buckets")
        parents = buckets.where(~F.col("fits")).select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
        split = buckets.withColumn("parent", F.shiftright("prefix", 1)).join(
            parents, ["depth", "parent"], "left_semi")
        reached = buckets.where(F.col("depth") == above).unionByName(split.drop("parent"))
        if above:
            reached = split.drop("parent")
        done = reached.where(F.col("fits") | (F.col("depth") == HASH_BITS)).drop("low", "high", "fits")
        leaves = done if leaves is None else leaves.unionByName(done)
        deeper = buckets.where(~F.col("fits") & (F.col("depth") == below)).select(
            F.col("prefix").alias("_cell"))
        if below == HASH_BITS or deeper.isEmpty():
            return materialise(leaves, "directory")
        open_rows = lookup_join(
            open_rows.withColumn("_cell", _prefix(F.col("_hash"), below)), deeper, "_cell", "left_semi"
        ).drop("_cell")
        above = below
