"""Near-duplicate vectors by NN-descent.

Each vector keeps a list of its nearest so far. A round introduces the neighbours of a vector to each
other and keeps whom they prefer. A list that is full of links is saturated and doubles. Links at or above the threshold make
the components, also those that no list has room for: each group of vectors that are compared gives its ties. Vectors drawn until enough of them have links are compared with all; the search goes on until their
links, nearly all, lie inside components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobweave.joins import fits_broadcast
from jobweave.llm.arrow import group_starts, pieces, whole_groups
from jobweave.llm.components import connected_components
from jobweave.llm.vectors import dots, matrix, usable
from jobweave.storage import materialise

#: Entries of lists. A width of zero marks a tie: links, listed or not, connect its ends.
LISTS = "node long, neighbour long, similarity double, width int"


@dataclass(frozen=True)
class Settings:
    """``widest`` bounds a list, not a vector's links: ties keep what falls out of lists, and inside components all links
    are counted in blocks."""

    width: int = 8
    widest: int = 64
    tables: int = 6  # random partitions that the first lists come from, at least
    at_once: int = 12  # partitions that are shuffled at a time
    bucket: int = 200  # vectors in a bucket, about
    rounds: int = 1  # before each audit
    audits: int = 6
    audited: int = 512  # vectors drawn for the audits at first
    evidence: int = 400  # drawn vectors that must have a link, or all are drawn
    slice_bytes: int = 16 << 20  # of drawn vectors that are compared with all at a time
    recall: float = 0.98
    block: int = 1024
    seed: int = 6


def link_vectors(vectors: DataFrame, threshold: float = 0.9, settings: Settings = Settings()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``vec_id, embedding``.

    Links join vectors whose cosine, in double precision, is at least ``threshold``: those the search has found, and
    all between vectors of one component. The component is the smallest ``vec_id`` that links reach.

    Vectors that are null, zero, hold null or non-finite components or are not of the usual length link with nothing and form
    components of their own. Equal vectors are searched once and link with each other; rows that repeat an id count like
    others. A null id never names a component unless it is alone there. An empty table gives an empty result; further columns
    are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    named = rows.withColumn("name", F.xxhash64("embedding"))
    good = usable(named)
    points = materialise(
        good.groupBy("name").agg(
            F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.min("embedding").alias("embedding")),
        "vectors",
    )
    n = points.count()
    roots = _roots(points, n, threshold, settings)
    linked = materialise(points.join(roots, points["name"] == roots["node"]).drop("node"), "linked-vectors")
    inside = _links_inside(linked, threshold, settings)
    firsts = linked.groupBy("root").agg(F.min("first").alias("component"))
    known = linked.select("name", "root").join(firsts, "root").join(inside, "name", "left").select(
        "name", "component", F.col("links").alias("others"))
    of_point = points.select("name", "first", "copies").join(known, "name", "left").select(
        "name", F.coalesce("component", "first").alias("component"),
        (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"))
    # Only vectors with a link of any kind are looked up.
    of_point = materialise(of_point.where("links > 0"), "vector-links")
    tagged = named.select("vec_id", F.when(F.col("embedding").isNotNull(), F.col("name")).alias("name"))
    result = tagged.join(of_point, "name", "left")
    component = F.coalesce("component", "vec_id")
    return result.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def _roots(points: DataFrame, n: int, threshold: float, settings: Settings) -> DataFrame:
    """``node, root`` of the vectors with links, refined until the audit is satisfied.

    A table of which all vectors had to be drawn needs no second turn: the audit has seen all its links. If the last audit
    falls short, that is an error.
    """
    turn_of = partitions(n, threshold, settings)
    sets = -(-turn_of // settings.at_once)
    each = -(-turn_of // sets)
    lists, truth, whole, recall = None, None, False, 0.0
    for audit in range(settings.audits):
        for turn in range(audit * sets, (audit + 1) * sets):
            first = _first_lists(points, n, threshold, settings, turn, each)
            lists = _merge(first if lists is None else lists.unionByName(first), settings, threshold)
        for _ in range(settings.rounds):
            lists, changed = _round(points, lists, settings, threshold)
            if changed <= 0.001 * n:
                break
        ties = _ties(lists, threshold)
        roots = materialise(connected_components(ties), "vector-roots")
        lists = lists.where("width > 0").unionByName(roots.where(F.col("node") != F.col("root")).select(
            "node", F.col("root").alias("neighbour"), F.lit(1.0).alias("similarity"), F.lit(0).alias("width")))
        if truth is None:
            truth, whole = true_links(points, n, threshold, settings)
        recall = _recall(truth, roots)
        if whole or recall >= settings.recall:
            # What only the audit has found is true as well.
            seen = truth.select(F.col("node").alias("a"), F.col("neighbour").alias("b"))
            ends = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
            return roots if recall == 1 else connected_components(ends.unionByName(seen))
    raise RuntimeError(
        f"after {settings.audits * sets * each} partitions the search reaches {recall:.4f} of the audited vectors' links, "
        f"less than {settings.recall}")


def partitions(n: int, threshold: float, settings: Settings) -> int:
    """How many random partitions a turn takes.

    Two vectors at the threshold are on the same side of a plane with probability 1 - angle / pi. With so many partitions they
    share a bucket of one with a probability of ``recall``, however few other links there are.
    """
    side = 1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi
    together = side ** _planes(n, settings)
    if together >= settings.recall:
        return settings.tables
    return max(settings.tables, int(np.ceil(np.log1p(-min(settings.recall, 0.9999)) / np.log1p(-together))))


def _planes(n: int, settings: Settings) -> int:
    return int(max(0, np.ceil(np.log2(max(1, n) / settings.bucket))))


def _ties(lists: DataFrame, threshold: float) -> DataFrame:
    return lists.where((F.col("width") == 0) | (F.col("similarity") >= threshold)).select(F.col("node").alias("a"), F.col("neighbour").alias("b"))


def _first_lists(
    points: DataFrame, n: int, threshold: float, settings: Settings, turn: int, tables: int
) -> DataFrame:
    """Candidates from random partitions: vectors on the same side of some random planes."""
    keyed = points.select("name", "embedding").mapInArrow(
        partial(_bucket, planes=_planes(n, settings), settings=settings, turn=turn, tables=tables),
        "part int, bucket long, name long, embedding array<double>")
    # A crowded bucket is dealt out at random; its members still meet in other partitions and rounds.
    crowded = keyed.groupBy("part", "bucket").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > 40 * settings.bucket).select(
        "part", "bucket", F.ceil(F.col("n") / (20 * settings.bucket)).alias("blocks"))
    crowded = materialise(crowded, "crowded-buckets")
    keyed = keyed.join(F.broadcast(crowded) if fits_broadcast(crowded) else crowded, ["part", "bucket"], "left").select(
        "part", "bucket", F.pmod(F.xxhash64("name", "part"), F.coalesce("blocks", F.lit(1))).alias("block"),
        "name", "embedding")
    ordered = keyed.repartition("part", "bucket", "block").sortWithinPartitions("part", "bucket", "block", "name")
    return ordered.mapInArrow(partial(_nearest_in_bucket, settings=settings, threshold=threshold), LISTS)


def _bucket(
    batches: Iterator[pa.RecordBatch], planes: int, settings: Settings, turn: int, tables: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            vectors = matrix(piece.column(1))
            for part in range(tables):
                rng = np.random.default_rng((settings.seed, turn, part))
                sides = vectors @ rng.standard_normal((vectors.shape[1], planes)) > 0
                bucket = sides @ (1 << np.arange(planes, dtype=np.int64)) if planes else np.zeros(len(vectors), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(bucket), part, dtype=np.int32)), pa.array(bucket), piece.column(0), piece.column(1)],
                    names=["part", "bucket", "name", "embedding"],
                )


def _nearest_in_bucket(
    batches: Iterator[pa.RecordBatch], settings: Settings, threshold: float
) -> Iterator[pa.RecordBatch]:
    """The nearest of each vector in its bucket, taken in runs of bounded length, and the ties of each run."""
    for batch in batches:
        for piece in pieces(batch):
            starts = group_starts(piece, 3)
            for begin, stop in zip(starts, starts[1:]):
                for start in range(begin, stop, 4 * settings.bucket):
                    end = min(stop, start + 4 * settings.bucket)
                    names = piece.column(3).slice(start, end - start).to_numpy()
                    vectors = _unit(matrix(piece.column(4).slice(start, end - start)))
                    if len(names) < 2:
                        continue
                    similarity = vectors @ vectors.T
                    a, b = _stars(_near(similarity, vectors, threshold))
                    yield _list_rows(names[a], names[b], np.ones(len(a)), 0)
                    np.fill_diagonal(similarity, -np.inf)
                    width = min(settings.width, len(names) - 1)
                    near = np.argpartition(-similarity, width - 1, axis=1)[:, :width]
                    row = np.repeat(np.arange(len(names)), width)
                    yield _list_rows(names[row], names[near.ravel()], dots(vectors[row], vectors[near.ravel()]), settings.width)


def _list_rows(node, neighbour, similarity, width) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(node), pa.array(neighbour), pa.array(similarity),
         pa.array(np.broadcast_to(np.asarray(width, dtype=np.int32), node.shape))],
        names=["node", "neighbour", "similarity", "width"],
    )


def _near(similarity: np.ndarray, vectors: np.ndarray, threshold: float) -> np.ndarray:
    """Which vectors link with each other, none with itself."""
    near = similarity >= threshold
    # Numbers at the threshold are decided by the product that does not depend on the place.
    a, b = np.nonzero(np.abs(similarity - threshold) < 1e-9)
    near[a, b] = dots(vectors[a], vectors[b]) >= threshold
    np.fill_diagonal(near, False)
    return near


def _stars(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector that links connect with an earlier one, and the first of its group."""
    some = np.flatnonzero(near.any(axis=1))
    if not len(some):
        return some, some
    near = near[np.ix_(some, some)]
    root = np.arange(len(some))
    while True:
        least = np.minimum(root, np.where(near, root, len(some)).min(axis=1))
        least = least[least]
        if np.array_equal(root, least):
            break
        root = least
    tied = np.flatnonzero(root != np.arange(len(some)))
    return some[tied], some[root[tied]]


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of norm one; scaled first, so that no square leaves the range of a double."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(dots(scaled, scaled))[:, None]


def _merge(found: DataFrame, settings: Settings, threshold: float) -> DataFrame:
    """The best of each node's candidates, as many as its list is wide; a saturated list gets twice the width. Ties stay."""
    ordered = found.repartition("node").sortWithinPartitions("node", F.desc("similarity"), "neighbour")
    return materialise(
        ordered.mapInArrow(partial(_keep_best, settings=settings, threshold=threshold), LISTS), "neighbour-lists")


def _keep_best(batches: Iterator[pa.RecordBatch], settings: Settings, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in whole_groups(batches, 1):
        node, neighbour, similarity, width = (batch.column(i).to_numpy() for i in range(4))
        tie = width == 0
        if tie.any():
            ends = np.unique(np.stack((node[tie], neighbour[tie]), axis=1), axis=0)
            yield _list_rows(ends[:, 0], ends[:, 1], np.ones(len(ends)), 0)
            node, neighbour, similarity, width = (x[~tie] for x in (node, neighbour, similarity, width))
        if not len(node):
            continue
        order = np.lexsort((neighbour, -similarity, node))
        fresh = np.ones(len(node), dtype=bool)
        fresh[1:] = (node[order][1:] != node[order][:-1]) | (neighbour[order][1:] != neighbour[order][:-1])
        # The same pair always has the same similarity, so copies are neighbours in this order.
        order = order[fresh]
        node, neighbour, similarity, width = node[order], neighbour[order], similarity[order], width[order]
        starts = np.concatenate(([0], np.flatnonzero(node[1:] != node[:-1]) + 1))
        size = np.diff(np.append(starts, len(node)))
        widest = np.maximum.reduceat(width, starts)
        linked = np.add.reduceat((similarity >= threshold).astype(np.int64), starts)
        wider = np.where(linked >= widest, np.minimum(settings.widest, np.maximum(widest * 2, linked)), widest)
        rank = np.arange(len(node)) - np.repeat(starts, size)
        keep = rank < np.repeat(wider, size)
        yield _list_rows(node[keep], neighbour[keep], similarity[keep], np.repeat(wider, size)[keep])


def _round(points: DataFrame, lists: DataFrame, settings: Settings, threshold: float) -> tuple[DataFrame, int]:
    """Introduces neighbours of a node to each other. Also returns how many list entries are new."""
    ties, lists = lists.where("width = 0"), lists.where("width > 0")
    both = lists.select(F.col("node").alias("center"), F.col("neighbour").alias("member"), "similarity", "width").unionByName(
        lists.select(F.col("neighbour").alias("center"), F.col("node").alias("member"), "similarity", "width"))
    own = lists.groupBy("node").agg(
        F.max("width").alias("width"), F.min("similarity").alias("least"), F.count(F.lit(1)).alias("n"))
    state = points.select("name", "embedding").join(own, points["name"] == own["node"], "left").select(
        F.col("name").alias("member"), "embedding", F.coalesce("width", F.lit(settings.width)).alias("own_width"),
        F.when(F.col("n") >= F.col("width"), F.col("least")).otherwise(float("-inf")).alias("least"))
    state = materialise(state, "vector-state")
    # Of a center that very many name, the nearest come first and in groups of bounded size.
    ordered = both.select("center", "member", "similarity").distinct().join(
        F.broadcast(state) if fits_broadcast(state) else state, "member")
    ordered = ordered.repartition("center").sortWithinPartitions("center", F.desc("similarity"), "member")
    found = ordered.select("center", "member", "least", "own_width", "embedding").mapInArrow(
        partial(_introduce, settings=settings, threshold=threshold), LISTS)
    merged = _merge(lists.unionByName(ties).unionByName(found), settings, threshold)
    changed = merged.where("width > 0").join(lists, ["node", "neighbour"], "left_anti").count()
    return merged, changed


def _introduce(
    batches: Iterator[pa.RecordBatch], settings: Settings, threshold: float
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            starts = group_starts(piece, 1)
            member, least, width = (piece.column(i).to_numpy() for i in (1, 2, 3))
            vectors = _unit(matrix(piece.column(4))) if piece.num_rows else None
            rows, ties = [], []
            for begin, stop in zip(starts, starts[1:]):
                for start in range(begin, stop, 4 * settings.widest):
                    end = min(stop, start + 4 * settings.widest)
                    if end - start < 2:
                        continue
                    similarity = vectors[start:end] @ vectors[start:end].T
                    a, b = _stars(_near(similarity, vectors[start:end], threshold))
                    ties.append((a + start, b + start))
                    np.fill_diagonal(similarity, -np.inf)
                    # No more than a list holds can enter it from here.
                    most = min(int(width[start:end].max()), end - start - 1)
                    bound = -np.partition(-similarity, most - 1, axis=1)[:, most - 1]
                    a, b = np.nonzero(similarity >= np.maximum(bound, np.nextafter(least[start:end], np.inf))[:, None])
                    rows.append((a + start, b + start))
            if rows:
                a, b = (np.concatenate(x) for x in zip(*ties))
                yield _list_rows(member[a], member[b], np.ones(len(a)), 0)
                a, b = (np.concatenate(x) for x in zip(*rows))
                exact = dots(vectors[a], vectors[b])
                yield _list_rows(member[a], member[b], exact, width[a])


def true_links(points: DataFrame, n: int, threshold: float, settings: Settings) -> tuple[DataFrame, bool]:
    """``node, neighbour``: all links of vectors drawn at random, and whether all vectors are drawn.

    A drawn vector with many links is no more evidence than one with a single link, and one without is none, so
    vectors are drawn until enough of them have links.
    """
    spark = points.sparkSession
    truth = spark.createDataFrame([], "node long, neighbour long")
    width = len(points.select("embedding").first()[0]) if n else 1
    most = max(1, settings.slice_bytes // (8 * width))
    place = F.xxhash64(F.lit(settings.seed), "name").bitwiseAND(F.lit((1 << 62) - 1))
    drawn, size, linked = 0, settings.audited, 0
    while drawn < n and linked < settings.evidence:
        upto = min(n, drawn + min(size, most))
        some = points.where((place >= F.lit((1 << 62) * drawn // n)) & (place < F.lit((1 << 62) * upto // n)))
        sample = some.select("name", "embedding").toArrow()
        drawn, size = upto, 2 * size
        if not sample.num_rows:
            continue
        names, vectors = sample.column(0).to_numpy(), _unit(matrix(sample.column(1).combine_chunks()))
        found = points.select("name", "embedding").mapInArrow(
            partial(_links_of, names=names, vectors=vectors, threshold=threshold), "node long, neighbour long")
        truth = materialise(truth.unionByName(found), "true-links")
        linked = truth.select("node").distinct().count()
    return truth, drawn >= n


def _recall(truth: DataFrame, roots: DataFrame) -> float:
    """The share of the true links that lie inside components, where all are counted, or the mean share of a vector's if less."""
    of_node = roots.select("node", F.col("root").alias("x"))
    of_neighbour = roots.select(F.col("node").alias("neighbour"), F.col("root").alias("y"))
    of_vector = truth.join(of_node, "node", "left").join(of_neighbour, "neighbour", "left").groupBy("node").agg(
        F.count(F.lit(1)).alias("links"), F.count_if(F.col("x") == F.col("y")).alias("found"))
    links, found, mean = of_vector.agg(F.sum("links"), F.sum("found"), F.avg(F.col("found") / F.col("links"))).first()
    return min(found / links, mean) if links else 1.0


def _links_of(batches: Iterator[pa.RecordBatch], names, vectors, threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            ids = piece.column(0).to_numpy()
            if not piece.num_rows:
                continue
            unit = _unit(matrix(piece.column(1)))
            for start in range(0, len(names), 1024):
                a, b = np.nonzero(vectors[start : start + 1024] @ unit.T >= threshold - 1e-9)
                a += start
                other = (names[a] != ids[b]) & (dots(vectors[a], unit[b]) >= threshold)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[a][other]), pa.array(ids[b][other])], names=["node", "neighbour"])


def _links_inside(linked: DataFrame, threshold: float, settings: Settings) -> DataFrame:
    """``name, links``: how many other rows each vector links with in its component, blocks meeting blocks."""
    sizes = linked.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / settings.block).cast("int").alias("blocks"))
    sizes = sizes.withColumnRenamed("root", "of")
    cut = linked.join(sizes, linked["root"] == sizes["of"]).withColumn(
        "own", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int"))
    cells = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "root", F.least("own", "other").cast("long").alias("low"), F.greatest("own", "other").cast("long").alias("high"),
        "name", F.col("own").cast("long").alias("own"), "copies", "embedding")
    ordered = cells.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "own", "name")
    counted = ordered.mapInArrow(partial(_count_links, threshold=threshold), "name long, links long")
    return counted.groupBy("name").agg(F.sum("links").alias("links"))


def _count_links(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    for batch in whole_groups(batches, 3):
        starts = group_starts(batch, 3)
        low, high, names, own, copies = (batch.column(i).to_numpy() for i in range(1, 6))
        vectors = _unit(matrix(batch.column(6)))
        links = np.zeros(len(names), dtype=np.int64)
        for start, end in zip(starts, starts[1:]):
            similarity = vectors[start:end] @ vectors[start:end].T
            near = _near(similarity, vectors[start:end], threshold)
            if low[start] != high[start]:
                near &= own[start:end, None] != own[None, start:end]
            links[start:end] = near @ copies[start:end]
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(links)], names=["name", "links"])
