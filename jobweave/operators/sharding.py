"""Cutting a table into shards: exact contiguous ones, or by hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobweave.joins import content_hash, lookup_join
from jobweave.storage import materialise


def hash_shard(key: Column, shards: int) -> Column:
    """Shard 1..n by hash: no order, no counting, no shuffle. The choice for large runs."""
    return (F.pmod(F.xxhash64(key), F.lit(shards)) + 1).cast("int")


def position_shards(table: DataFrame, shards: int, column: str = "shard") -> DataFrame:
    """Add the shard 1..n of each row by its place in the files of a Parquet table, in the order of their names.

    Every shard gets ``rows // n`` rows, the last one also the rest; with fewer rows than shards, all rows are in
    the last. The place is the rows of the files before plus the row's own number in its file, so only files are
    counted: nothing is sorted, and no row moves. ``table`` must be a scan, filtered by partition columns at most.
    """
    placed = table.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    counts = materialise(table.select(F.col("_metadata.file_path").alias("_file")).groupBy("_file").agg(
        F.count(F.lit(1)).alias("_n")), "file-rows")
    size = (counts.agg(F.sum("_n")).first()[0] or 0) // shards
    if size == 0:
        return table.withColumn(column, F.lit(shards))
    # One row per file. Names are told apart by their first parts, so that no task numbers all files.
    before = F.sum("_n").over(Window.partitionBy("_folder").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1))
    folder = F.regexp_extract("_file", r"^(.*)/[^/]*$", 1)
    folders = counts.groupBy(folder.alias("_folder")).agg(F.sum("_n").alias("_all"))
    above = F.sum("_all").over(Window.orderBy("_folder").rowsBetween(Window.unboundedPreceding, -1))  # a row per folder
    starts = counts.withColumn("_folder", folder).withColumn("_in", F.coalesce(before, F.lit(0))).join(
        F.broadcast(folders.select("_folder", F.coalesce(above, F.lit(0)).alias("_above"))), "_folder")
    starts = materialise(starts.select("_file", (F.col("_in") + F.col("_above")).alias("_start")), "file-starts")
    place = F.col("_start") + F.col("_row")
    shard = F.least(F.floor(place / F.lit(size)) + 1, F.lit(shards)).cast("int")
    return lookup_join(placed, starts, "_file").withColumn(column, shard).select(*table.columns, column)


def contiguous_shards(
    df: DataFrame, shards: int, order_by: Sequence[str], column: str = "shard"
) -> DataFrame:
    """Add the shard 1..n of each row in the given order.

    Every shard gets ``rows // n`` rows, the last one also the rest; with fewer rows than
    shards, all rows are in the last. A shard is then a range of keys, so only keys are
    counted and ranked, and the wide rows get their shard by comparing with n-1 cut keys: they
    are neither shuffled nor numbered. Rows that share a cut key are told apart by a
    hash of the row, and copies of one row by a stored row number.
    """
    order = list(order_by)
    cuts = _cut_keys(df, shards, order)
    if any(skipped for _, skipped in cuts or []):
        df, order = df.withColumn("_tie", content_hash(df)), [*order, "_tie"]
        cuts = _cut_keys(df, shards, order)
    if cuts is None:
        return df.withColumn(column, F.lit(shards))

    here = F.struct(*order)
    split = {key for key, skipped in cuts if skipped}
    at_cut = _any(here.eqNullSafe(_literal(key, df, order)) for key in split)
    shard = F.lit(1)
    for key, _ in cuts:
        shard = shard + (here >= _literal(key, df, order)).cast("int")
    result = (df.where(~at_cut) if split else df).withColumn(column, shard).drop("_tie")
    if split:
        copies = materialise(df.where(at_cut).withColumn("_copy", F.monotonically_increasing_id()), "copies")
        for key in split:
            result = result.unionByName(_split_copies(copies, cuts, key, order, column))
    return result


def _any(conditions) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


def _literal(key: Sequence, df: DataFrame, order: Sequence[str]) -> Column:
    types = dict(df.dtypes)
    return F.struct(*(F.lit(v).cast(types[n]).alias(n) for v, n in zip(key, order)))


def _cut_keys(df: DataFrame, shards: int, order: Sequence[str]) -> list[tuple] | None:
    """For each cut the first key of the next shard, and how many of its rows stay before it.

    Keys are counted (copies combine before the shuffle), range partitioned, and stored with
    the number of their range, because ranks are only right if both passes see the same ranges.
    """
    counted = materialise(
        df.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
        .repartitionByRange(*order)
        .withColumn("_range", F.spark_partition_id()),
        "keys",
    )
    ranges = counted.groupBy("_range").agg(F.sum("_n").alias("_n")).orderBy("_range").collect()
    total = sum(row["_n"] for row in ranges)
    size = total // shards
    if size == 0:
        return None
    found = []
    before = 0
    for row in ranges:
        wanted = [c for c in (size * i for i in range(1, shards)) if before <= c < before + row["_n"]]
        if wanted:
            running = Window.partitionBy("_range").orderBy(*order)
            ranked = counted.where(F.col("_range") == row["_range"]).withColumn(
                "_upto", F.sum("_n").over(running) + before
            )
            hits = ranked.where(
                _any((F.col("_upto") > c) & (F.col("_upto") - F.col("_n") <= c) for c in wanted)
            ).collect()
            for c in wanted:
                hit = next(h for h in hits if h["_upto"] - h["_n"] <= c < h["_upto"])
                found.append((tuple(hit[n] for n in order), c - (hit["_upto"] - hit["_n"])))
        before += row["_n"]
    return found


def _split_copies(
    copies: DataFrame, cuts: list[tuple], key: tuple, order: Sequence[str], column: str
) -> DataFrame:
    """Shards of the rows that share one cut key, by their stored row number."""
    here = F.struct(*order)
    group = copies.where(here.eqNullSafe(_literal(key, copies, order)))
    shard = F.lit(1)
    for cut_key, skipped in cuts:
        if cut_key != key:
            shard = shard + (here >= _literal(cut_key, copies, order)).cast("int")
        elif skipped == 0:
            shard = shard + 1
        else:
            shard = shard + (F.col("_copy") >= _nth_copy(group, skipped)).cast("int")
    return group.withColumn(column, shard).drop("_tie", "_copy")


def _nth_copy(group: DataFrame, skipped: int) -> int:
    """The row number that has exactly ``skipped`` smaller ones.

    The upper bits of the number are the task that wrote the row, the lower 33 count inside it.
    Counts per task find the task; only that task's rows, one input partition, are ranked.
    """
    per_task = (
        group.groupBy(F.shiftright("_copy", 33).alias("task"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("task")
        .collect()
    )
    for row in per_task:
        if skipped < row["n"]:
            inside = group.where(F.shiftright("_copy", 33) == row["task"])
            place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("_copy"))
            nth = inside.select("_copy", place.alias("place")).where(F.col("place") == skipped + 1)
            return nth.first()["_copy"]
        skipped -= row["n"]
    raise ValueError("more rows to skip than there are copies")
