"""Mixing sources to target weights by a splitting tree, in DataFrame operations only.

Documents of a source fall into hashed blocks, whose order is a random permutation. A source's
target fixes how many of its blocks are drawn, and how often. The drawn blocks are then dealt to the output
shards down a binary tree: each node passes an exact number of blocks to its left half, taken in random
order without replacement, so the counts per source follow a multivariate hypergeometric
distribution. Shards hold disjoint draws, and each is shuffled by itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobweave.joins import lookup_join
from jobweave.llm.common import WORD, hash60, replace_columns
from jobweave.storage import materialise


@dataclass(frozen=True)
class Mix:
    """What is mixed: weights by rank of the source, repeating; size of the mix; bound per document."""

    weights: Sequence[int] = (3, 1, 2)
    total_share: float = 1.5
    most: int = 2
    blocks: int = 1024
    shards: int = 8
    seed: int = 9


ADDED = ("size", "source_size", "target", "draws")


def mix(documents: DataFrame, plan: Mix = Mix()) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``draws`` (the output shard of each copy taken).

    Sources get their weighted share of the mix, but at most ``most`` times their size; what is
    over goes to the others by weight, until none is above. A source is taken whole as often as its target allows, and once more in
    part: whole blocks in permuted order, then documents of the next block, then the one document that brings it
    closest to the target.

    Sizes are words of the text (null: 0). The null source comes last. Rows with the same source and
    ``doc_id`` are one document and are drawn together; null ids are one as well. Empty documents belong to a
    block like others and bring no words. An empty table gives an empty result. Columns named like the results are replaced; the
    seed and the ids alone decide what is drawn, so reruns agree.
    """
    rows = replace_columns(documents, *ADDED, "_sk", "_h", "_block", "_doc").withColumns({
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
        "_sk": _source_key(F.col("source")),
        "_h": hash60(F.lit(plan.seed), F.col("doc_id")),
    }).withColumn("_block", F.pmod("_h", F.lit(plan.blocks)))
    units = materialise(
        rows.groupBy("_sk", "_block", "_h").agg(F.sum("size").alias("size")), "mix-units"
    )
    targets = materialise(source_targets(units, plan), "mix-targets")
    blocks = units.groupBy("_sk", "_block").agg(F.sum("size").alias("size"))
    order = Window.partitionBy("_sk").orderBy("_block")
    blocks = materialise(
        lookup_join(blocks, targets, "_sk")
        .withColumn("upto", F.sum("size").over(order))
        .withColumn("whole", F.col("upto") <= F.col("need"))
        .withColumn("edge", ~F.col("whole") & (F.col("upto") - F.col("size") < F.col("need"))),
        "mix-blocks",
    )
    extra = _edge_documents(units, blocks, targets)
    dealt = _deal(blocks, extra, plan)
    placed = lookup_join(rows, dealt, ["_sk", "_block"])
    placed = lookup_join(placed, extra.withColumn("_extra", F.lit(True)), ["_sk", "_h"])
    once_more = F.coalesce(F.col("_whole") | F.col("_extra"), F.lit(False))
    copies = F.col("_copies") + once_more.cast("int")
    return placed.withColumn(
        "draws", F.when(copies > 0, F.slice("_shards", F.lit(1), copies)).otherwise(F.array().cast("array<int>"))
    ).drop("_sk", "_h", "_block", "_whole", "_extra", "_copies", "_shards")


def place_in_shard(plan: Mix, doc_id: Column, copy: Column) -> Column:
    """What a shard's rows are ordered by: random, and the same in every run."""
    return hash60(F.lit(plan.seed + 1), doc_id, copy)


def shuffled(mixed: DataFrame, plan: Mix = Mix()) -> DataFrame:
    """A row per drawn copy with its ``shard``, each shard in random order of its own."""
    drawn = mixed.select("*", F.posexplode("draws").alias("_copy", "shard")).drop("draws")
    return drawn.withColumn("_order", place_in_shard(plan, F.col("doc_id"), F.col("_copy"))).repartition(
        "shard", F.pmod("_order", F.lit(64))
    ).sortWithinPartitions("shard", "_order").drop("_order", "_copy")


def source_targets(units: DataFrame, plan: Mix) -> DataFrame:
    """``_sk, source_size, target, copies, need``: one row per source.

    ``copies``: how often the source is taken whole; ``need``: the words of it still due.
    """
    sizes = units.groupBy("_sk").agg(F.sum("size").alias("source_size"))
    weights = F.array(*(F.lit(float(w)) for w in plan.weights))
    ranked = numbered(sizes, ["_sk"])
    sources = materialise(
        ranked.withColumn("weight", F.element_at(
            weights, (F.pmod("place", F.lit(len(plan.weights))) + 1).cast("int")
        )).withColumn("most", F.col("source_size") * F.lit(float(plan.most))),
        "mix-sources",
    )
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * plan.total_share
    capped = F.lit(False)
    level = F.lit(0.0)
    while True:  # each round caps at least one more source, or ends
        rest, weight, at_cap = sources.agg(
            F.count_if(~capped), F.sum(F.when(~capped, F.col("weight"))), F.sum(F.when(capped, F.col("most")))
        ).first()
        if not rest or not weight:
            break
        level = F.lit((total - (at_cap or 0.0)) / weight)
        above = capped | (level * F.col("weight") > F.col("most"))
        if sources.where(above & ~capped).isEmpty():
            break
        capped = above
    target = F.when(capped, F.col("most")).otherwise(level * F.col("weight"))
    return sources.withColumn("target", target).withColumn(
        "copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    ).select(
        "_sk", "source_size", "target", "copies",
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("need"),
    )


def numbered(df: DataFrame, order: list[str], column: str = "place") -> DataFrame:
    """Add the place 0.. of each row in ``order`` (which must tell rows apart): ranges, counted and numbered."""
    ranged = materialise(
        df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range: as many as there are partitions.
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_range", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return lookup_join(ranged, starts, "_range").withColumn(column, F.col("_before") + inside).drop("_range", "_before")


def _source_key(source: Column) -> Column:
    """Text that sorts as the source by code point, with null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _edge_documents(units: DataFrame, blocks: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents outside whole blocks that are taken once more: ``_sk, _h``."""
    edge = blocks.where("edge").select(
        "_sk", "_block", (F.col("need") - F.col("upto") + F.col("size")).alias("gap"))
    inside = lookup_join(units, edge, ["_sk", "_block"], "inner")
    running = F.sum("size").over(Window.partitionBy("_sk", "_block").orderBy("_h"))
    chosen = materialise(
        inside.withColumn("upto", running).where(F.col("upto") <= F.col("gap")).select(
            "_sk", "_h", "size", "gap"),
        "mix-edge",
    )
    filled = chosen.groupBy("_sk").agg(F.sum("size").alias("filled"))
    gaps = lookup_join(edge, filled, "_sk").select(
        "_sk", (F.col("gap") - F.coalesce("filled", F.lit(0))).alias("gap"), F.col("_block").alias("at"))
    left = lookup_join(units.where("size > 0"), gaps, "_sk", "inner").where(F.col("_block") >= F.col("at"))
    left = lookup_join(left, chosen.select("_sk", "_h"), ["_sk", "_h"], "left_anti")
    best = left.groupBy("_sk").agg(
        F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), "_h", "gap")).alias("best")
    ).where("best.off < best.gap").select("_sk", F.col("best._h").alias("_h"))
    return materialise(chosen.select("_sk", "_h").unionByName(best), "mix-extra")


def _deal(blocks: DataFrame, extra: DataFrame, plan: Mix) -> DataFrame:
    """The shards of each block's copies: ``_sk, _block, source_size, target, _copies, _whole, _shards``.

    A block that only some documents of are drawn from once more gets a place for that draw, too.
    """
    parts = extra.select("_sk", F.pmod("_h", F.lit(plan.blocks)).alias("_block")).distinct().withColumn(
        "part", F.lit(True))
    quotas = lookup_join(blocks, parts, ["_sk", "_block"]).withColumn(
        "quota", F.col("copies") + (F.col("whole") | F.coalesce("part", F.lit(False))).cast("int"))
    drawn = quotas.where("quota > 0").select(
        "_sk", "_block", F.explode(F.sequence(F.lit(1), F.col("quota"))).alias("copy"))
    nodes = materialise(
        drawn.withColumn("low", F.lit(0)).withColumn("high", F.lit(plan.shards)), "mix-tree")
    for level in range(max(0, plan.shards - 1).bit_length()):
        nodes = materialise(_split(nodes, plan.seed + 100 + level), "mix-tree")
    shards = nodes.groupBy("_sk", "_block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("copy", "low"))), lambda d: d["low"]).alias("_shards"))
    return lookup_join(quotas, shards, ["_sk", "_block"]).select(
        "_sk", "_block", "source_size", "target", F.col("copies").alias("_copies"),
        F.col("whole").alias("_whole"), "_shards")


def _split(nodes: DataFrame, seed: int) -> DataFrame:
    """Deals the draws of each node to its two halves, in exact numbers and random order.

    The order is that of a hash. Its upper bits cut a node into bins; a draw's place is the count of
    the bins before plus its place in its own, so no task ranks a whole node.
    """
    order = hash60(F.lit(seed), F.col("_sk"), F.col("_block"), F.col("copy"))
    node = ["low", "high"]
    hashed = nodes.withColumn("_o", order).withColumn("_bin", F.shiftright("_o", 52))
    counts = hashed.groupBy(*node, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    over = Window.partitionBy(*node)
    before = F.sum("_n").over(over.orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1))
    bins = counts.select(*node, "_bin", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_n").over(over).alias("_all"))
    inside = F.row_number().over(Window.partitionBy(*node, "_bin").orderBy("_o", "_sk", "_block", "copy"))
    placed = lookup_join(hashed, bins, [*node, "_bin"]).withColumn("_place", F.col("_before") + inside)
    width = F.col("high") - F.col("low")
    middle = F.col("low") + F.ceil(width / 2).cast("int")
    left = F.col("_place") <= F.round(F.col("_all") * (middle - F.col("low")) / width)
    return placed.select(
        "_sk", "_block", "copy",
        F.when((width > 1) & ~left, middle).otherwise(F.col("low")).alias("low"),
        F.when((width > 1) & left, middle).otherwise(F.col("high")).alias("high"),
    )
