"""Approximate nearest neighbours by inner product with an adaptive dimension scan.

Vectors lie in lists around centroids. A query probes the nearest lists. There the vectors, rotated at random, are
scanned block of columns by block of columns: a partial distance over some columns estimates the whole one, and a
hypothesis test against the query's k-th best distance abandons a candidate as soon as it is surely farther.
Inner products become distances by one more column that gives all vectors the same norm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from jobweave.llm.arrow import pieces
from jobweave.llm.vectors import dots, matrix, usable, usual_length
from jobweave.storage import materialise


@dataclass(frozen=True)
class Settings:
    """``sample`` vectors (expected) train the centroids; ``audited`` queries set how many lists are probed."""

    sample: int = 20_000
    most_lists: int = 1024
    audited: int = 64
    recall: float = 0.96
    rows: int = 4096  # of a list that a task holds; larger lists are cut
    columns: int = 16  # of a block
    margin: float = 2.1  # of the hypothesis test
    seed: int = 8


@dataclass(frozen=True)
class Index:
    """What every task needs: bounded by the number of lists and the length of a vector."""

    centroids: np.ndarray
    rotation: np.ndarray
    norm: float  # the largest of all vectors
    cuts: np.ndarray  # blocks of each list
    settings: Settings

    def rotated(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """Vectors with the column that evens out their norms (0 in a query), rotated."""
        lift = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(0.0, self.norm**2 - dots(vectors, vectors)))
        return np.column_stack((vectors, lift)) @ self.rotation


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, settings: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each query, rank from 1.

    ``vectors`` and ``queries`` have ``vec_id, embedding``. A query does not find rows of its own id. The score is the inner
    product of the original vectors in double precision; ties go to the smaller ``vec_id``. The number of
    probed lists is the smallest that gave the audited queries the recall set, compared with a scan of all rows.

    Vectors that are null, zero, hold null or non-finite components, or are not of the usual length take no part, nor
    do null ids. Rows that repeat an id are candidates of their own, and one query (of different vectors the smallest). Fewer than ``k`` candidates are all
    returned. An empty table gives an empty result; further columns are ignored.
    """
    length = usual_length(_columns(vectors))
    rows = usable(_columns(vectors), length)
    asked = usable(_columns(queries), length).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    index, probes = build(rows, asked, k, settings)
    if index is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    stored = materialise(
        rows.mapInArrow(partial(_assign, index=index), "cell long, vec_id long, embedding array<double>"), "ann-lists")
    near = _probe(stored, asked.withColumn("worst", F.lit(float("-inf"))), index, k, 0, 1)
    best = _best(near, k)
    kth = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("worst"))
    known = asked.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn(
        "worst", F.coalesce("worst", F.lit(float("-inf"))))
    more = _probe(stored, known, index, k, 1, probes)
    return _best(best.drop("rank").unionByName(more), k)


def build(rows: DataFrame, asked: DataFrame, k: int, settings: Settings) -> tuple[Index | None, int]:
    """Centroids of a bounded sample, and the number of lists to probe."""
    norm, n = rows.agg(F.sqrt(F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x))), F.count(F.lit(1))).first()
    if not n:
        return None, 0
    sample = _thinned(rows, n, settings.sample, settings.seed)
    dimension = sample.shape[1] + 1
    rng = np.random.default_rng(settings.seed)
    rotation = np.linalg.qr(rng.standard_normal((dimension, dimension)))[0]
    lists = int(max(1, min(settings.most_lists, np.sqrt(n), len(sample))))
    index = Index(np.zeros((1, dimension)), rotation, float(norm), np.ones(1, dtype=np.int64), settings)
    centroids = _kmeans(index.rotated(sample), lists, rng)
    index = Index(centroids, rotation, float(norm), np.ones(lists, dtype=np.int64), settings)
    sizes = rows.select("embedding").mapInArrow(partial(_list_of, index=index), "list int").groupBy("list").count().collect()
    cuts = np.ones(lists, dtype=np.int64)
    for row in sizes:  # one row per list
        cuts[row["list"]] = -(-row["count"] // settings.rows)
    index = Index(centroids, rotation, float(norm), cuts, settings)
    return index, _probes(rows, asked, index, k)


def _columns(vectors: DataFrame) -> DataFrame:
    return vectors.select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(F.col("vec_id").isNotNull())


def _thinned(rows: DataFrame, n: int, expected: int, seed: int) -> np.ndarray:
    """About ``expected`` vectors, chosen by a hash: all if there are no more."""
    share = F.pmod(F.xxhash64(F.lit(seed), "vec_id", "embedding"), F.lit(1 << 30)) / float(1 << 30)
    some = rows.where(share < expected / n) if n > expected else rows
    table = some.select("vec_id", "embedding").toArrow()
    order = np.argsort(table.column(0).to_numpy(), kind="stable")
    return matrix(table.column(1).combine_chunks())[order]


def _kmeans(points: np.ndarray, lists: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    centroids = points[np.sort(rng.choice(len(points), lists, replace=False))].copy()
    for _ in range(rounds):
        near = _nearest(points, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, points)
        count = np.bincount(near, minlength=lists)
        centroids[count > 0] = sums[count > 0] / count[count > 0, None]
    return centroids


def _distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, up to a constant per point."""
    return (centroids**2).sum(axis=1) - 2 * points @ centroids.T


def _nearest(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.concatenate(
        [_distances(points[i : i + 2048], centroids).argmin(axis=1) for i in range(0, len(points), 2048)]
        or [np.zeros(0, dtype=np.int64)])


def _probes(rows: DataFrame, asked: DataFrame, index: Index, k: int) -> int:
    """How many of the nearest lists hold the wanted share of the audited queries' true neighbours.

    A bounded number of queries scans all rows: each task returns its ``k`` best of each, which are merged.
    """
    n = asked.count()
    if not n:
        return 1
    share = F.pmod(F.xxhash64(F.lit(index.settings.seed + 1), "vec_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = asked.where(share < index.settings.audited / n) if n > index.settings.audited else asked
    table = sample.select("vec_id", "embedding").toArrow()
    if not table.num_rows:
        return len(index.centroids)
    ids, vectors = table.column(0).to_numpy(), matrix(table.column(1).combine_chunks())
    found = rows.mapInArrow(
        partial(_scan_all, index=index, ids=ids, vectors=vectors, k=k), "query_id long, vec_id long, list int, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    true = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "list").collect()
    order = _distances(index.rotated(vectors, query=True), index.centroids).argsort(axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(order.shape[1])[None, :], axis=1)
    place = {q: i for i, q in enumerate(ids.tolist())}
    needed = np.sort([rank[place[r["query_id"]], r["list"]] for r in true])
    if not len(needed):
        return 1
    return int(needed[min(len(needed) - 1, int(np.ceil(index.settings.recall * len(needed))))]) + 1


def _scan_all(batches: Iterator[pa.RecordBatch], index: Index, ids, vectors, k: int) -> Iterator[pa.RecordBatch]:
    held = {q: (np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)) for q in range(len(ids))}
    for batch in batches:
        for piece in pieces(batch):
            vec, rows = piece.column(0).to_numpy(), matrix(piece.column(1))
            near = _nearest(index.rotated(rows), index.centroids)
            scores = vectors @ rows.T
            for q in range(len(ids)):
                score = np.concatenate((held[q][0], scores[q][vec != ids[q]]))
                of = np.concatenate((held[q][1], vec[vec != ids[q]]))
                lists = np.concatenate((held[q][2], near[vec != ids[q]]))
                keep = np.lexsort((of, -score))[:k]
                held[q] = score[keep], of[keep], lists[keep]
    sizes = [len(held[q][0]) for q in held]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate([held[q][1] for q in held])),
            pa.array(np.concatenate([held[q][2] for q in held]).astype(np.int32)),
            pa.array(np.concatenate([held[q][0] for q in held])),
        ],
        names=["query_id", "vec_id", "list", "score"],
    )


def _list_of(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            near = _nearest(index.rotated(matrix(piece.column(0))), index.centroids)
            yield pa.RecordBatch.from_arrays([pa.array(near.astype(np.int32))], names=["list"])


def _cells(lists: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    return lists.astype(np.int64) << 32 | blocks


def _assign(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Each vector with its list, and its block of a large one."""
    for batch in batches:
        for piece in pieces(batch):
            near = _nearest(index.rotated(matrix(piece.column(1))), index.centroids)
            mixed = piece.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            block = mixed.astype(np.int64) % index.cuts[near]
            yield pa.RecordBatch.from_arrays(
                [pa.array(_cells(near, block)), piece.column(0), piece.column(1)], names=["cell", "vec_id", "embedding"])


def _probe(stored: DataFrame, asked: DataFrame, index: Index, k: int, first: int, last: int) -> DataFrame:
    """The best ``k`` of each probed block, for the lists from the ``first`` nearest up to the ``last``."""
    sent = asked.select("vec_id", "embedding", "worst").mapInArrow(
        partial(_send, index=index, first=first, last=last),
        "cell long, query boolean, vec_id long, worst double, embedding array<double>")
    held = stored.select(
        "cell", F.lit(False).alias("query"), "vec_id", F.lit(0.0).alias("worst"), "embedding")
    met = held.unionByName(sent).repartition("cell").sortWithinPartitions("cell", "query")
    return met.mapInArrow(partial(_scan, index=index, k=k), "query_id long, vec_id long, score double")


def _send(batches: Iterator[pa.RecordBatch], index: Index, first: int, last: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch, 1 << 18):
            order = _distances(index.rotated(matrix(piece.column(1)), query=True), index.centroids).argsort(
                axis=1, kind="stable")[:, first:last]
            row = np.repeat(np.arange(piece.num_rows), order.shape[1])
            lists = order.ravel()
            many = index.cuts[lists]
            block = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row, cell = np.repeat(row, many), _cells(np.repeat(lists, many), block)
            for start in range(0, len(row), 4096):
                some = row[start : start + 4096]
                at = pa.array(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[start : start + 4096]), pa.array(np.ones(len(some), dtype=bool)),
                     piece.column(0).take(at), piece.column(2).take(at), piece.column(1).take(at)],
                    names=["cell", "query", "vec_id", "worst", "embedding"],
                )


def _scan(batches: Iterator[pa.RecordBatch], index: Index, k: int) -> Iterator[pa.RecordBatch]:
    """The queries of a block come after its vectors, so only these are held."""
    cell, ids, vectors = None, [], []
    block = None
    for batch in batches:
        for piece in pieces(batch):
            cells, query = piece.column(0).to_numpy(), piece.column(1).to_numpy(zero_copy_only=False)
            change = (cells[1:] != cells[:-1]) | (query[1:] != query[:-1])
            starts = np.concatenate(([0], np.flatnonzero(change) + 1, [len(cells)]))
            for start, end in zip(starts, starts[1:]):
                if cells[start] != cell:
                    cell, ids, vectors, block = cells[start], [], [], None
                part = piece.slice(start, end - start)
                values = matrix(part.column(4))
                if not query[start]:
                    ids.append(part.column(2).to_numpy())
                    vectors.append(values)
                elif ids:
                    if block is None:
                        block = np.concatenate(ids), np.concatenate(vectors)
                        block = *block, index.rotated(block[1])
                    for at in range(0, len(values), 256):
                        yield _scan_block(
                            part.column(2).to_numpy()[at : at + 256], values[at : at + 256],
                            part.column(3).to_numpy()[at : at + 256], block, index, k)


def _scan_block(query_ids, queries, worst, block, index: Index, k: int) -> pa.RecordBatch:
    ids, vectors, turned = block
    asked = index.rotated(queries, query=True)
    dimension = turned.shape[1]
    # |q - x|^2 = |q|^2 + norm^2 - 2 q.x, so the k-th best product bounds the distance.
    bound = np.maximum(0.0, dots(queries, queries) + index.norm**2 - 2 * worst)
    alive_q, alive_x = np.nonzero(query_ids[:, None] != ids[None, :])
    partial_sum = np.zeros(len(alive_q))
    for start in range(0, dimension, index.settings.columns):
        end = min(start + index.settings.columns, dimension)
        a, b = asked[:, start:end], turned[:, start:end]
        if len(alive_q) * 4 > len(asked) * len(turned):  # most are left: the whole block at once
            gap = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T
            partial_sum += gap[alive_q, alive_x]
        else:
            difference = a[alive_q] - b[alive_x]
            partial_sum += dots(difference, difference)
        if end < dimension:
            slack = (1 + index.settings.margin / np.sqrt(end)) ** 2 * end / dimension
            stay = partial_sum <= bound[alive_q] * slack + 1e-9
        else:
            stay = partial_sum <= bound[alive_q] * (1 + 1e-9) + 1e-9
        alive_q, alive_x, partial_sum = alive_q[stay], alive_x[stay], partial_sum[stay]
    score = np.concatenate(
        [dots(queries[alive_q[i : i + 65536]], vectors[alive_x[i : i + 65536]]) for i in range(0, len(alive_q), 65536)]
        or [np.zeros(0)])
    order = np.lexsort((ids[alive_x], -score, alive_q))
    q = alive_q[order]
    first = np.searchsorted(q, q, side="left")
    order = order[np.arange(len(q)) - first < k]
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids[alive_q[order]]), pa.array(ids[alive_x[order]]), pa.array(score[order])],
        names=["query_id", "vec_id", "score"],
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
