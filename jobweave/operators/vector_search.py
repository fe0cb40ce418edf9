"""Nearest vectors where neither side fits one task: exact, by hashing, and over compressed vectors.

Every way places queries and corpus rows into buckets and cuts large buckets into cells of bounded size. A
task holds the corpus side of one cell, streams the queries past it and keeps the best of each; the best of all cells are
merged by query. Nothing of either table passes through the driver, but for a sample of fixed size that compressed
vectors are fitted on.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from jobweave.joins import lookup_join
from jobweave.operators.similarity import SCORE_DIGITS, best_pairs, unit_rows
from jobweave.storage import materialise

#: Values of the corpus side of a cell, and values or similarities that a task makes at a time.
CELL_VALUES = 4_000_000
_BATCH_VALUES = 2_000_000
_PAIR_VALUES = 500_000
#: Multiply-adds that one task is given, about, and that one cell may take.
_TASK_WORK = 4_000_000_000
_CELL_WORK = 320_000_000_000
#: Corpus rows that meet queries at a time, and results of queries that a task holds at a time.
_TILE = 1024
_BATCH_RESULTS = 200_000

_CELL = ["bucket", "i", "j"]
#: Keys that Arrow puts in the same order as Spark.
_PLAIN_KEYS = (LongType(), IntegerType(), StringType())


@dataclass(frozen=True)
class Hashing:
    """Random-hyperplane buckets: ``tables`` of them per row, with ``rows`` corpus rows each on average."""

    tables: int = 6
    rows: int = 512
    recall: float = 0.95  # that the audit must reach
    buckets: int = 48  # that one query is sent to, in all tables, before comparing all rows is the cheaper way
    audited: int = 64  # queries that are also searched exactly
    seed: int = 11


@dataclass(frozen=True)
class Compression:
    """Product quantisation: every ``width`` dimensions become one byte."""

    width: int = 4
    sample: int = 20_000  # rows that the codebooks are fitted on, at most
    rounds: int = 8
    candidates: int = 20  # per result, compared exactly at the end
    seed: int = 12


@dataclass(frozen=True)
class Codebooks:
    """The centres of each part of a vector: parts x 256 x width."""

    centres: np.ndarray
    dimensions: int
    metric: str

    @property
    def bytes_per_vector(self) -> int:
        return len(self.centres)

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        codes = np.empty((len(vectors), len(self.centres)), dtype=np.uint8)
        for part, (centres, some) in enumerate(zip(self.centres, _parts(vectors, self.centres.shape[2]))):
            codes[:, part] = _nearest(some, centres)
        return codes

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The vectors that codes stand for: products with them are the sums of the looked-up parts, and much faster."""
        parts, entries, width = self.centres.shape
        at = codes + np.arange(parts) * entries
        return self.centres.reshape(-1, width).take(at, axis=0).reshape(len(codes), -1)[:, : self.dimensions]


@dataclass(frozen=True)
class Sides:
    """Both tables as they were when the search began; ``metric`` is ``cosine`` or ``dot``."""

    asked: DataFrame  # the queries with ``_q``
    wanted: DataFrame  # _q, field, vec
    rows: DataFrame  # _c, the kept columns, vec
    names: list[str]
    kept: list[str]
    key: str
    metric: str
    dimensions: int


def sides(
    queries: DataFrame, query_vectors: dict[str, Column], corpus: DataFrame, corpus_vector: str, key: str,
    payload: Sequence[str] = (), metric: str = "cosine",
) -> Sides:
    """Stores both tables with row numbers; vectors may come from a model that must not be asked twice."""
    if metric not in ("cosine", "dot"):
        raise ValueError(f"unknown metric: {metric}")
    names, kept = list(query_vectors), list(dict.fromkeys([key, *payload]))
    asked = materialise(
        queries.withColumns({f"_v_{n}": v.cast("array<double>") for n, v in query_vectors.items()})
        .withColumn("_q", F.monotonically_increasing_id()), "asked")
    fields = F.array(*(
        F.struct(F.lit(i).alias("field"), F.col(f"_v_{n}").alias("vec")) for i, n in enumerate(names)))
    wanted = asked.select("_q", F.inline(fields)).where("vec is not null")
    rows = materialise(
        corpus.where(F.col(corpus_vector).isNotNull())
        .select(*kept, F.col(corpus_vector).cast("array<double>").alias("vec"))
        .withColumn("_c", F.monotonically_increasing_id()), "corpus")
    dimensions = next(filter(None, (t.agg(F.max(F.size("vec"))).first()[0] for t in (rows, wanted))), 0)
    return Sides(asked, wanted, rows, names, kept, key, metric, dimensions)


def exact_hits(both: Sides, k: int, cell_values: int = CELL_VALUES, only: DataFrame | None = None) -> DataFrame:
    """``_q, field, _c, score, _place``: the k best of all corpus rows, blocks against blocks.

    Scores are rounded to six digits; ties go to the smaller key, then to the row stored first. ``only`` narrows the queries.
    """
    wanted = both.wanted if only is None else both.wanted.join(only, "_q", "left_semi")
    best = _in_cells(
        wanted, _keyed(both), both.dimensions, partial(_search, k=k, metric=both.metric), cell_values)
    return _merged(best, k, apart=True)


def top_k_blocks(both: Sides, k: int = 5, cell_values: int = CELL_VALUES) -> DataFrame:
    """The queries, with an ordered array of the k nearest corpus rows for each query vector."""
    return _with_hits(both, exact_hits(both, k, cell_values))


def top_k_hashed(both: Sides, k: int = 5, hashing: Hashing = Hashing()) -> tuple[DataFrame, float]:
    """As ``top_k_blocks``, among the rows that share a bucket with the query; and the audited recall.

    A corpus row lies in one bucket of each table. A query looks into its own bucket and those across the planes
    that it is nearest to. Their number doubles until the audited queries have the recall. Where that takes every bucket, or
    sends a query to more than ``hashing.buckets`` of them, as with vectors that lie in no groups, all rows are compared in blocks: a copy of each query per
    bucket would be more to shuffle. All scores are exact.
    """
    bits = max(0, math.ceil(math.log2(max(1, both.rows.count()) / hashing.rows)))
    planes = np.random.default_rng(hashing.seed).normal(size=(hashing.tables if bits else 1, bits, both.dimensions))
    shared = both.rows.sparkSession.sparkContext.broadcast(planes)
    placed = _bucketed(_keyed(both), ["_c", "_key", "vec"], shared, 1)
    audit = both.wanted.select("_q").distinct().orderBy(F.xxhash64("_q"), "_q").limit(hashing.audited)
    audit = materialise(audit, "audited")
    exact = materialise(exact_hits(both, k, only=audit), "audit-hits")

    def find(wanted: DataFrame, probes: int) -> DataFrame:
        looking = _bucketed(wanted, ["_q", "field", "vec"], shared, probes)
        return _merged(_in_cells(looking, placed, both.dimensions, partial(_search, k=k, metric=both.metric)), k)

    probes = 1
    while True:
        reached = recall(exact, find(both.wanted.join(audit, "_q", "left_semi"), probes))
        if reached >= hashing.recall or probes >= 1 << bits:
            break
        probes *= 2
        if probes * len(planes) > hashing.buckets:
            return top_k_blocks(both, k), 1.0
    return _with_hits(both, find(both.wanted, probes)), reached


def fit(both: Sides, compression: Compression = Compression()) -> Codebooks:
    """Codebooks by k-means on rows drawn by a hash of their number; all rows of a smaller table."""
    drawn = both.rows.orderBy(F.xxhash64(F.lit(compression.seed), "_c"), "_c").limit(compression.sample)
    vectors = _matrix(drawn.select("vec").toArrow().column("vec").combine_chunks(), both.dimensions)
    vectors = unit_rows(vectors) if both.metric == "cosine" else vectors
    rng = np.random.default_rng(compression.seed)
    books = []
    for some in _parts(vectors, compression.width):
        known = np.unique(some, axis=0)
        centres = known[rng.permutation(len(known))[:256]] if len(known) else np.zeros((1, compression.width))
        for _ in range(compression.rounds):
            own = _nearest(some, centres)
            sums = np.stack([np.bincount(own, some[:, d], len(centres)) for d in range(some.shape[1])], axis=1)
            members = np.bincount(own, minlength=len(centres))[:, None]
            centres = np.where(members > 0, sums / np.maximum(members, 1), centres)
        books.append(np.vstack([centres, np.repeat(centres[:1], 256 - len(centres), axis=0)]))
    return Codebooks(np.stack(books), both.dimensions, both.metric)


def compress(both: Sides, books: Codebooks) -> DataFrame:
    """``_c, _key, codes``: every corpus row as one byte per part. Keep it as a table to search it again."""
    shared = both.rows.sparkSession.sparkContext.broadcast(books)
    rows = _keyed(both)
    schema = StructType([rows.schema["_c"], rows.schema["_key"], *StructType.fromDDL("codes binary")])
    return rows.select("_c", "_key", "vec").mapInArrow(partial(_encode, shared=shared), schema)


def top_k_compressed(
    both: Sides, books: Codebooks, codes: DataFrame, k: int = 5, compression: Compression = Compression(),
    cell_values: int = CELL_VALUES,
) -> DataFrame:
    """As ``top_k_blocks``: goes through all compressed rows, and compares the best of them exactly.

    The best of a query are one row with their numbers. Vectors meet again in cells: no pair carries its vectors.
    """
    shared = both.rows.sparkSession.sparkContext.broadcast(books)
    wide = k * compression.candidates
    held_values = books.bytes_per_vector // 8 + 4
    best = _in_cells(
        both.wanted, codes.withColumnRenamed("codes", "vec"), both.dimensions, partial(_look_up, k=wide, shared=shared),
        cell_values, held_values=held_values, listed=True)
    if codes.count() <= _cell_rows(cell_values, held_values):
        near = best.select("_q", "field", F.col("hits._c").alias("near"))
    else:
        near = _merged(best.select("_q", "field", F.inline("hits")), wide, apart=True)
        near = near.groupBy("_q", "field").agg(F.collect_list("_c").alias("near"))
    looking = materialise(both.wanted.join(near, ["_q", "field"]), "near")
    scored = _in_cells(looking, _keyed(both), both.dimensions, partial(_compare, k=k, metric=both.metric), cell_values)
    return _with_hits(both, _merged(scored, k, apart=True))


def recall(exact: DataFrame, found: DataFrame) -> float:
    """The share of exact hits that were found; ties at the last place count by their score."""
    last = exact.groupBy("_q", "field").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("due"))
    good = found.select("_q", "field", "score").join(last, ["_q", "field"]).where("score >= least")
    n = good.groupBy("_q", "field").agg(F.least(F.count(F.lit(1)), F.first("due")).alias("n")).agg(F.sum("n")).first()[0]
    due = last.agg(F.sum("due")).first()[0]
    return (n or 0) / due if due else 1.0


# --- cells ---------------------------------------------------------------------------


def _keyed(both: Sides) -> DataFrame:
    return both.rows.select("_c", F.col(both.key).alias("_key"), "vec")


def _cell_rows(cell_values: int, values: int) -> int:
    """Corpus rows of a cell."""
    return max(1, cell_values // max(1, values))


def _in_cells(
    looking: DataFrame, held: DataFrame, values: int, search: Callable, cell_values: int = CELL_VALUES,
    held_values: int | None = None, listed: bool = False,
) -> DataFrame:
    """``_q, field, _c, _key, score`` found by ``search`` in each cell; with ``listed`` the last three as an array ``hits``.

    ``looking``: bucket, _q, field, vec. ``held``: bucket, _c, _key, vec; without ``bucket`` all are in one. A bucket of many rows is cut on both sides, and every
    part of one side meets every part of the other; so its size bounds no task. Queries are cut finer where the corpus side of a
    cell is large, by the products of a cell. The number of tasks follows from the products to be made. ``held_values`` is
    what the cell holds of a corpus row, where that is not the vector. With a column ``near`` of row numbers in ``looking`` a
    query goes only to the cells of these rows.
    """
    spark = held.sparkSession
    per, columns = _cell_rows(cell_values, held_values or values), looking.columns

    def most(work: float) -> float:
        """Multiply-adds of a cell: each slot gets a few cells, as long as they are worth a task."""
        return min(_CELL_WORK, max(_TASK_WORK, work / (4 * spark.sparkContext.defaultParallelism)))

    if "bucket" in columns:
        sizes = materialise(looking.groupBy("bucket").agg(F.count(F.lit(1)).alias("asking")).join(
            held.groupBy("bucket").agg(F.count(F.lit(1)).alias("holding")), "bucket"), "cell-sizes")
        work = (sizes.agg(F.sum(F.col("asking").cast("double") * F.col("holding"))).first()[0] or 0.0) * max(1, values)
        at_a_time = F.least(
            F.lit(4.0 * per), most(work) / max(1, values) / F.greatest(F.lit(1), F.least("holding", F.lit(per))))
        sizes = sizes.select(
            "bucket", F.ceil(F.col("asking") / F.greatest(F.lit(1.0), at_a_time)).cast("int").alias("is"),
            F.ceil(F.col("holding") / per).cast("int").alias("js"))
        held, looking = (lookup_join(side, sizes, "bucket", "inner") for side in (held, looking))
        tasks = math.ceil(work / _TASK_WORK)
    else:
        asking, holding = looking.count(), held.count()
        held, looking = _as_bytes(held), _as_bytes(looking)
        work = float(asking) * holding * max(1, values)
        at_a_time = max(1.0, min(4.0 * per, most(work) / max(1, values) / max(1, min(holding, per))))
        i_parts, j_parts = math.ceil(asking / at_a_time), math.ceil(holding / per)
        cuts = {"bucket": F.lit(0).cast("long"), "is": F.lit(i_parts), "js": F.lit(j_parts)}
        # Where one side is empty there is no cell.
        held, looking = (side.where(F.lit(asking > 0 and holding > 0)).withColumns(cuts) for side in (held, looking))
        tasks = min(math.ceil(work / _TASK_WORK), 4 * i_parts * j_parts)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), tasks)
    none = F.lit(None)
    kind = held.schema["_key"].dataType
    vec, asked = held.schema["vec"].dataType, looking.schema["vec"].dataType
    left = held.select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("is") - 1)).alias("i"),
        F.pmod(F.xxhash64("_c"), F.col("js")).cast("int").alias("j"), F.lit(0).alias("side"),
        "_key", "_c", F.lit(0).alias("field"), F.col("vec").alias("held"), none.cast(asked).alias("vec"))
    right = looking.select(
        "bucket", F.pmod(F.xxhash64("_q"), F.col("is")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("js") - 1)).alias("j"), F.lit(1).alias("side"),
        none.cast(kind).alias("_key"), F.col("_q").alias("_c"), "field", none.cast(vec).alias("held"), "vec",
        *(["js", "near"] if "near" in looking.columns else []))
    if "near" in looking.columns:
        left = left.withColumn("near", none.cast("array<long>"))
        right = right.withColumn(
            "near", F.filter("near", lambda c: F.pmod(F.xxhash64(c), F.col("js")) == F.col("j"))).drop("js").where(F.size("near") > 0)
    placed = left.unionByName(right).repartition(tasks, *_CELL)
    by_key = "bucket" in columns or kind not in _PLAIN_KEYS
    if by_key:
        ordered = placed.sortWithinPartitions(*_CELL, "side", "_key", "_c")
    else:  # a single number is sorted without comparing rows, and workers sort the corpus side
        cell = (F.col("i").cast("long") * j_parts + F.col("j")) * 2 + F.col("side")
        ordered = placed.withColumn("_place", cell).sortWithinPartitions("_place").drop("_place")
    hit = [StructField("_c", LongType()), StructField("_key", kind), StructField("score", DoubleType())]
    schema = StructType([
        *StructType.fromDDL("_q long, field int"), *([StructField("hits", ArrayType(StructType(hit)))] if listed else hit)])
    return ordered.mapInArrow(partial(_walk, search=search, by_key=by_key), schema)


def _walk(batches: Iterator[pa.RecordBatch], search: Callable, by_key: bool = True) -> Iterator[pa.RecordBatch]:
    """Gathers the corpus side of each cell, which comes first, and hands the queries to ``search`` as they come.

    ``by_key``: the corpus side comes in the order of its keys; else it is put in it here.
    """
    cell, held, ready = None, [], None
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in (*_CELL, "side")]
        changes = np.zeros(max(0, batch.num_rows - 1), dtype=bool)
        for column in columns:
            changes |= column[1:] != column[:-1]
        starts = np.concatenate(([0], np.flatnonzero(changes) + 1, [batch.num_rows]))
        for start, end in zip(starts, starts[1:]):
            if start == end:
                continue
            some = batch.slice(start, end - start)
            here = tuple(column[start] for column in columns[:-1])
            if here != cell:
                cell, held, ready = here, [], None
            if columns[-1][start] == 0:
                held.append(some.select(["_c", "_key", "held"]))
                continue
            if ready is None:
                corpus, held = pa.Table.from_batches(held).combine_chunks() if held else None, []
                if corpus is not None and not by_key:
                    corpus = corpus.take(pc.sort_indices(
                        corpus, sort_keys=[("_key", "ascending"), ("_c", "ascending")], null_placement="at_start"))
                ready, corpus = search(corpus), None
            yield from ready(some)


def _found(some: pa.RecordBatch, rows: np.ndarray, c: pa.Array, keys: pa.Array, columns: np.ndarray, scores: np.ndarray):
    at, found = pa.array(rows), pa.array(columns)
    return pa.RecordBatch.from_arrays(
        [some.column("_c").take(at), some.column("field").take(at), c.take(found), keys.take(found), pa.array(scores)],
        names=["_q", "field", "_c", "_key", "score"])


class _Vectors:
    """The corpus side of a cell, as rows of products."""

    def __init__(self, vectors: np.ndarray, metric: str):
        self.vectors, self.norms, self.dimensions = vectors, None, vectors.shape[1]
        if metric == "cosine":
            parts = (vectors[start : start + 4 * _TILE] for start in range(0, len(vectors), 4 * _TILE))
            norms = np.concatenate([np.empty((0, 1)), *(np.linalg.norm(some, axis=1, keepdims=True) for some in parts)])
            self.norms = np.where(norms == 0, 1.0, norms)

    def roughly(self) -> _Vectors:
        """With the rows in single precision as well."""
        self.rough = np.empty(self.vectors.shape, np.float32)
        with np.errstate(over="ignore"):
            for start in range(0, len(self), 4 * _TILE):
                self.rough[start : start + 4 * _TILE] = self[start : start + 4 * _TILE]
        self.longest = _longest(self.rough)
        return self

    def __len__(self) -> int:
        return len(self.vectors)

    def __getitem__(self, at) -> np.ndarray:
        return self.vectors[at] if self.norms is None else self.vectors[at] / self.norms[at]

    def single(self, at: slice) -> np.ndarray:
        return self.rough[at]


class _Codes:
    """The same of compressed vectors, which are decoded as they are needed."""

    def __init__(self, codes: np.ndarray, books: Codebooks):
        self.codes, self.books, self.dimensions = codes, books, books.dimensions
        with np.errstate(over="ignore"):
            self.rough = Codebooks(books.centres.astype(np.float32), books.dimensions, books.metric)
        self.longest = float(np.sqrt((self.rough.centres.astype(float) ** 2).sum(axis=2).max(axis=1).sum()))

    def __len__(self) -> int:
        return len(self.codes)

    def __getitem__(self, at) -> np.ndarray:
        return self.books.decode(self.codes[at])

    def single(self, at: slice) -> np.ndarray:
        return self.rough.decode(self.codes[at])


def _longest(vectors: np.ndarray) -> float:
    parts = (vectors[start : start + 4 * _TILE] for start in range(0, len(vectors), 4 * _TILE))
    return float(np.max([0.0, *(np.sqrt(np.einsum("ij,ij->i", some, some, dtype=float).max()) for some in parts)]))


def _best(some: pa.RecordBatch, corpus: pa.Table, rows: _Vectors | _Codes, k: int, metric: str, listed: bool = False):
    c, keys = (_column(corpus, n) for n in ("_c", "_key"))
    queries = _matrix(some.column("vec"), rows.dimensions)
    queries = unit_rows(queries) if metric == "cosine" else queries
    step = max(1, min(_BATCH_VALUES // _TILE, _BATCH_RESULTS // k))
    for start in range(0, len(queries), step):
        found, columns, scores = best_rows(queries[start : start + step], rows, k)
        out = _found(some, found + start, c, keys, columns, scores)
        yield _listed(out) if listed else out


def _listed(found: pa.RecordBatch) -> pa.RecordBatch:
    """The finds of each query, which follow each other, as one row."""
    query, field = (found.column(n).to_numpy() for n in ("_q", "field"))
    changes = np.flatnonzero((query[1:] != query[:-1]) | (field[1:] != field[:-1])) + 1
    starts = np.concatenate(([0] if len(query) else [], changes)).astype(np.int32)
    names = ["_c", "_key", "score"]
    hits = pa.StructArray.from_arrays([found.column(n) for n in names], names)
    ends = pa.array(np.append(starts, len(query)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [found.column("_q").take(pa.array(starts)), found.column("field").take(pa.array(starts)), pa.ListArray.from_arrays(ends, hits)],
        names=["_q", "field", "hits"])


def best_rows(queries: np.ndarray, rows: _Vectors | _Codes, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``best_pairs`` of the products of all ``queries`` and ``rows``, tile by tile.

    Products in single precision rule out what cannot come among the k best found so far; their error is bounded, and what
    they leave is scored in double precision. Of equal scores the earlier row is better, so a later one has to be above the k-th.
    """
    n = len(rows)
    with np.errstate(over="ignore"):
        rough = queries.astype(np.float32)
    sizes = np.sqrt(np.einsum("ij,ij->i", rough, rough, dtype=float))
    # A sum of d products is wrong by d units in the last place at most, and its factors were rounded.
    error = (queries.shape[1] + 8) * 2.0**-23 * sizes * rows.longest + 1e-7
    if not np.isfinite(error).all() or (error > 1e30).any():
        return _best_slowly(queries, rows, k)
    half = 0.5 * 10.0**-SCORE_DIGITS
    least = np.full(len(queries), -np.inf)  # the k-th score so far
    below = np.full((len(queries), 1), -np.inf, np.float32)
    kept = tuple(np.empty(0, t) for t in (np.int64, np.int64, float))
    waiting, held = [], 0
    for start in range(0, n, _TILE):
        at = slice(start, min(n, start + _TILE))
        width = at.stop - start
        hits = np.flatnonzero(rough @ rows.single(at).T >= below)
        if len(hits) > len(queries) * width // 16:
            row, column, score = _above(queries, rows[at], least, k)
        else:
            row, column = np.divmod(hits, width)
            score = _pair_scores(queries, row, rows, column + start)
            better = score > least[row]
            row, column, score = row[better], column[better], score[better]
        waiting.append((row, column + start, score))
        held += len(row)
        if held >= len(queries) * k // 2 or at.stop == n:
            kept, waiting, held = _first_k(*map(np.concatenate, zip(kept, *waiting)), k), [], 0
            counts = np.bincount(kept[0], minlength=len(queries))
            full = counts == k
            least[full] = kept[2][np.cumsum(counts)[full] - 1]
            below[:, 0] = least + 0.8 * half - error
    return kept


def _above(queries: np.ndarray, matrix: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs with scores over ``least``, of each query those that its k-th best score does not rule out."""
    found, width = [], len(matrix)
    for start in range(0, len(queries), 256):
        scores = queries[start : start + 256] @ matrix.T
        np.round(scores, SCORE_DIGITS, out=scores)
        scores += 0.0
        better = scores > least[start : start + 256, None]
        if k < width and np.count_nonzero(better) > better.size // 16:
            better &= scores >= np.partition(scores, width - k, axis=1)[:, width - k, None]
        row, column = np.nonzero(better)
        found.append((row + start, column, scores[row, column]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _pair_scores(queries: np.ndarray, row: np.ndarray, rows: _Vectors | _Codes, column: np.ndarray) -> np.ndarray:
    score = np.empty(len(row))
    step = max(1, _PAIR_VALUES // max(1, queries.shape[1]))
    for i in range(0, len(row), step):
        score[i : i + step] = np.einsum("ij,ij->i", queries[row[i : i + step]], rows[column[i : i + step]])
    return np.round(score, SCORE_DIGITS) + 0.0


def _first_k(row: np.ndarray, column: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row; of equal scores the first given."""
    order = _order(row, score)
    row, column, score = row[order], column[order], score[order]
    first = np.searchsorted(row, row)
    best = np.arange(len(row)) - first < k
    return row[best], column[best], score[best]


def _order(row: np.ndarray, score: np.ndarray) -> np.ndarray:
    """By row, then from the best rounded score down, else as given: one whole number for all three where they fit, which sorts much faster."""
    units = np.rint(score * 10.0**SCORE_DIGITS)
    n, top, low = len(row), units.max(initial=0), units.min(initial=0)
    if max(top, -low) < 2.0**52 and (top - low + 1) * (row.max(initial=0) + 1) * n < 2.0**62:
        places = (row * int(top - low + 1) + (top - units).astype(np.int64)) * n + np.arange(n)
        places.sort()
        return places % max(1, n)
    return np.lexsort((-score, row))


def _best_slowly(queries: np.ndarray, rows: _Vectors | _Codes, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For vectors with values that are missing, infinite or beyond single precision."""
    kept = tuple(np.empty(0, t) for t in (np.int64, np.int64, float))
    most = max(_TILE, _BATCH_VALUES // max(1, queries.shape[1]))
    for start in range(0, len(rows), most):
        matrix = rows[start : start + most]
        step = max(1, _BATCH_VALUES // len(matrix))
        found = [kept]
        for i in range(0, len(queries), step):
            row, column, score = best_pairs(queries[i : i + step] @ matrix.T, k)
            found.append((row + i, column + start, score))
        kept = _first_k(*map(np.concatenate, zip(*found)), k)
    return kept


def _search(corpus: pa.Table | None, k: int, metric: str):
    """Exact products with the corpus side of a cell, whose rows are in the order of their keys."""
    if corpus is None:
        return lambda some: iter(())
    rows = _Vectors(_matrix(_column(corpus, "held")), metric).roughly()
    return lambda some: _best(some, corpus, rows, k, metric)


def _look_up(corpus: pa.Table | None, k: int, shared):
    if corpus is None:
        return lambda some: iter(())
    books = shared.value
    codes = _column(corpus, "held").cast(pa.binary(books.bytes_per_vector))
    codes = np.frombuffer(codes.buffers()[1], np.uint8).reshape(-1, books.bytes_per_vector)[codes.offset :][: len(codes)]
    rows = _Codes(codes, books)
    return lambda some: _best(some, corpus, rows, k, books.metric, listed=True)


def _compare(corpus: pa.Table | None, k: int, metric: str):
    """Exact products of each query with the rows of the cell that are ``near`` to it."""
    if corpus is None:
        return lambda some: iter(())
    rows = _Vectors(_matrix(_column(corpus, "held")), metric)
    c, keys = (_column(corpus, n) for n in ("_c", "_key"))
    numbers = c.to_numpy()
    order = np.argsort(numbers)
    numbers = numbers[order]

    def ready(some: pa.RecordBatch):
        for start in range(0, some.num_rows, _TILE):
            part = some.slice(start, _TILE)
            near = part.column("near")
            row = np.repeat(np.arange(len(near)), near.value_lengths().to_numpy())
            wanted = near.flatten().to_numpy()
            at = np.minimum(np.searchsorted(numbers, wanted), len(numbers) - 1)
            known = numbers[at] == wanted  # codes may be of rows that the corpus no longer has
            row, column = row[known], order[at[known]]
            queries = _matrix(part.column("vec"), rows.dimensions)
            score = _pair_scores(unit_rows(queries) if metric == "cosine" else queries, row, rows, column)
            at = np.argsort(column, kind="stable")
            row, at, _ = _first_k(row[at], at, np.where(np.isnan(score), np.inf, score)[at], k)  # as Spark sorts what is no number
            yield _found(part, row, c, keys, column[at], score[at])

    return ready


def _merged(found: DataFrame, k: int, apart: bool = False) -> DataFrame:
    """The k best of each query and field over all cells; a row found in several of them counts once.

    ``apart``: no row is in two cells of a query.
    """
    once = found.repartition("_q", "field")
    once = once if apart else once.dropDuplicates(["_q", "field", "_c"])
    order = Window.partitionBy("_q", "field").orderBy(F.desc("score"), "_key", "_c")
    return once.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k).drop("_key")


def _with_hits(both: Sides, best: DataFrame) -> DataFrame:
    """The queries with a column per field; null where the query has no vector."""
    hit = F.struct(*(F.col(c) for c in both.kept), "score")
    full = materialise(best, "hits").join(both.rows.select("_c", *both.kept), "_c")
    lists = {
        name: F.transform(
            F.sort_array(F.collect_list(F.when(F.col("field") == i, F.struct("_place", hit.alias("hit"))))),
            lambda h: h["hit"])
        for i, name in enumerate(both.names)}
    gathered = full.groupBy("_q").agg(*(column.alias(f"_h_{name}") for name, column in lists.items()))
    done = both.asked.join(gathered, "_q", "left")
    kind = ArrayType(StructType([
        *(both.rows.schema[c] for c in both.kept), StructField("score", DoubleType())]))
    none = F.array().cast(kind)
    return done.withColumns({
        name: F.when(F.col(f"_v_{name}").isNotNull(), F.coalesce(F.col(f"_h_{name}").cast(kind), none))
        for name in both.names
    }).drop("_q", *(f"{p}{n}" for n in both.names for p in ("_v_", "_h_")))


# --- vectors in tasks ------------------------------------------------------------------


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else column.combine_chunks()


def _as_bytes(rows: DataFrame) -> DataFrame:
    """Vectors as bytes of doubles: Arrow takes these from Spark at once, but arrays element by element, for every copy of a row."""
    if not isinstance(rows.schema["vec"].dataType, ArrayType):
        return rows
    schema = StructType([StructField("vec", BinaryType()) if f.name == "vec" else f for f in rows.schema])
    return rows.mapInArrow(_bytes, schema)


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vec = batch.column("vec")
        flat = vec.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
        ends = 8 * np.concatenate(([0], np.cumsum(vec.value_lengths().to_numpy(zero_copy_only=False))))
        packed = pa.Array.from_buffers(
            pa.binary(), len(vec), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(flat))])
        yield batch.set_column(batch.schema.get_field_index("vec"), "vec", packed)


def _flat(column: pa.Array) -> np.ndarray:
    if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False)
    wide = column.cast(pa.large_binary())
    _, ends, values = wide.buffers()
    if not len(wide) or values is None:
        return np.empty(0)
    ends = np.frombuffer(ends, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    return np.frombuffer(values, np.uint8)[ends[0] : ends[-1]].view(float)


def _matrix(column: pa.Array, dimensions: int | None = None) -> np.ndarray:
    flat = _flat(column)
    return flat.reshape(len(column), dimensions or (len(flat) // len(column) if len(column) else 0))


def _parts(vectors: np.ndarray, width: int) -> list[np.ndarray]:
    missing = -vectors.shape[1] % width
    padded = np.pad(vectors, ((0, 0), (0, missing))) if missing else vectors
    return np.split(padded, padded.shape[1] // width, axis=1) if padded.shape[1] else []


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    off = (centres * centres).sum(axis=1)
    return np.concatenate([
        (off - 2 * vectors[start : start + 4096] @ centres.T).argmin(axis=1) for start in range(0, len(vectors), 4096)
    ] or [np.empty(0, np.int64)])


def _encode(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    books = shared.value
    for batch in batches:
        vectors = _matrix(batch.column("vec"), books.dimensions)
        codes = books.encode(unit_rows(vectors) if books.metric == "cosine" else vectors)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_c"), batch.column("_key"), pa.array([row.tobytes() for row in codes], pa.binary())],
            names=["_c", "_key", "codes"])


def _bucketed(rows: DataFrame, columns: list[str], shared, probes: int) -> DataFrame:
    """``rows`` once for each bucket that they lie in, or look into."""
    schema = StructType([StructField("bucket", rows.select(F.lit(0).cast("long").alias("b")).schema["b"].dataType),
                         *(rows.schema[c] for c in columns)])
    return rows.select(*columns).mapInArrow(partial(_hash, shared=shared, probes=probes), schema)


def _hash(batches: Iterator[pa.RecordBatch], shared, probes: int) -> Iterator[pa.RecordBatch]:
    tables, bits, dimensions = shared.value.shape
    near = min(bits, max(1, probes.bit_length() + 3)) if probes < 1 << bits else bits
    for batch in batches:
        vectors = _matrix(batch.column("vec"), dimensions)
        for table in range(tables):
            margins = vectors @ shared.value[table].T
            own = ((margins > 0) << np.arange(bits)).sum(axis=1)
            buckets, rows = own[:, None], np.arange(len(vectors))[:, None]
            if probes > 1 and bits:
                # Subsets of the planes nearest to the vector, by the sum of squared distances.
                planes = np.argsort(np.abs(margins), axis=1)[:, :near]
                flips = (np.arange(1 << near)[:, None] >> np.arange(near)) & 1
                cost = np.take_along_axis(margins, planes, axis=1) ** 2 @ flips.T
                chosen = np.argsort(cost, axis=1, kind="stable")[:, : min(probes, 1 << near)]
                mask = (1 << planes) @ flips.T
                buckets = own[:, None] ^ np.take_along_axis(mask, chosen, axis=1)
                rows = np.repeat(rows, buckets.shape[1], axis=1)
            at = pa.array(rows.ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array((buckets.ravel() | table << bits).astype(np.int64)), *(c.take(at) for c in batch.columns)],
                names=["bucket", *batch.schema.names])
