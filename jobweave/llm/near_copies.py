"""Near copies of documents by SimHash and BK-trees, where fingerprints may be many bits apart.

The fingerprints of all texts are searched as in ``simhash``: in BK-trees of shards by equal blocks of bits. The shingles themselves
confirm what the trees connect. At a Jaccard similarity of 0.8, though, fingerprints differ in about 10 of 64 bits, too many for such
shards. So what the trees have left apart is looked for once more: documents that share a band of MinHash values form a shard, and the
shingles decide on its pairs, however far their fingerprints are apart. In crowded shards the BK-tree finds those within a wider radius, which are
compared first: mostly they connect the shard, and only what they leave apart is compared pair by pair. A large group of near copies makes a
crowded shard of nearly every band, so a few bands go first: in the others only pairs that these have not connected are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobweave.joins import fits_broadcast
from jobweave.llm.arrow import group_starts, pieces, released, whole_groups
from jobweave.llm.common import WORD, replace_columns
from jobweave.llm.components import connected_components
from jobweave.llm.simhash import BITS, forest_components, links as fingerprint_links, shingle_hashes
from jobweave.storage import materialise

#: Documents of a shard whose pairs a task lists; those of a larger one are compared in blocks.
LISTED = 64
BLOCK = 128
#: Bytes of shingles in a block, about, and pairs of blocks that a task compares.
BLOCK_BYTES = 8 << 20
CELLS_PER_TASK = 4
#: Bands whose crowded shards are compared whole.
LEADING = 2


@dataclass(frozen=True)
class Settings:
    """A pair at the similarity shares a band with probability 1 - (1 - 0.8**4)**20 = 0.99997."""

    shingle: int = 5
    similarity: float = 0.8
    close: int = 3  # bits within which trees search all fingerprints
    radius: int = 20  # bits within which pairs of a crowded shard are compared first; it turns none down
    bands: int = 20
    band: int = 4
    seed: int = 3


def one_of_each(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``documents`` that come first in their group of near copies, by ``doc_id``.

    A group is what links reach; a link joins texts whose sets of word shingles have a Jaccard similarity of at least
    ``similarity``. Texts without a word (null and empty ones) are copies of each other. Null ids sort first; of texts that share
    an id one stays, as does one of repeated rows. An empty table stays empty; all columns are kept.
    """
    rows = replace_columns(documents, "_key", "_copy").withColumn("_key", _key())
    keys = rows.groupBy("_key").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    keys = materialise(keys, "copy-keys")
    roots = materialise(connected_components(near_links(rows, settings)).select(
        F.col("node").alias("_key"), "root"), "copy-roots")
    grouped = keys.join(roots, "_key", "left").withColumn("root", F.coalesce("root", "_key"))
    first = grouped.groupBy("root").agg(F.min(F.struct("first", "_key")).alias("kept"))
    kept = materialise(first.select(F.col("kept._key").alias("_key"), F.col("kept.first").alias("_copy")), "copies-kept")
    chosen = rows.join(F.broadcast(kept) if fits_broadcast(kept) else kept, "_key").where(
        F.col("doc_id").eqNullSafe(F.col("_copy")))
    again = materialise(chosen.groupBy("_key").count().where("count > 1").select("_key"), "copies-again")
    if not again.isEmpty():
        repeated = chosen.join(again, "_key", "left_semi").dropDuplicates(["_key"])
        chosen = chosen.join(again, "_key", "left_anti").unionByName(repeated)
    return chosen.select(*rows.drop("_key").columns)


def near_links(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``a, b``: links between different texts (``_key``) that connect each group."""
    prints = materialise(
        rows.select("_key", F.col("text").cast("string")).mapInArrow(
            partial(_sketch, settings=settings), "key long, simhash long, bands array<long>")
        .groupBy("key").agg(F.min("simhash").alias("simhash"), F.min("bands").alias("bands")),
        "copy-prints",
    )
    close = materialise(_close(prints, settings.close), "copies-close")
    shards = prints.select("key", "simhash", F.posexplode("bands").alias("band", "shard"))
    # Shards are counted first, so that no task holds one that a common text fills.
    crowds = shards.groupBy("band", "shard").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > LISTED)
    crowds = materialise(crowds.select("band", "shard"), "copy-crowds")
    few = F.broadcast(crowds) if fits_broadcast(crowds) else crowds
    ordered = shards.join(few, ["band", "shard"], "left_anti").select("band", "shard", "key", "simhash").repartition(
        "band", "shard").sortWithinPartitions("band", "shard", "key")
    pairs = materialise(ordered.mapInArrow(_pairs, "a long, b long").distinct(), "copy-candidates")
    crowded = materialise(shards.join(few, ["band", "shard"]).select("band", "shard", "key"), "copies-crowded")
    ends = pairs.unionByName(close).select(F.explode(F.array("a", "b")).alias("_key"))
    wanted = materialise(ends.unionByName(crowded.select(F.col("key").alias("_key"))).distinct(), "copies-wanted")
    sets = rows.select("_key", F.col("text").cast("string")).join(
        F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "_key", "left_semi")
    sets = materialise(
        sets.mapInArrow(partial(_sets, settings=settings), "key long, shingles binary")
        .groupBy("key").agg(F.first("shingles").alias("shingles")),
        "copy-shingles",
    )
    confirmed = materialise(_confirmed(close, sets, settings), "copies-confirmed")
    roots = materialise(connected_components(confirmed), "copies-connected")
    of = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    apart = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left").where(
        F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    found = confirmed.unionByName(_confirmed(apart, sets, settings))
    if not crowded.isEmpty():
        known = sets.join(prints.select("key", "simhash"), "key")
        found = found.unionByName(_crowds(crowded, _rooted(known, roots), settings))
    return materialise(found.distinct(), "copy-links")


def _close(prints: DataFrame, close: int) -> DataFrame:
    """``a, b``: texts that the trees connect, by stars of fingerprints and of the texts that share one."""
    first = materialise(prints.groupBy("simhash").agg(F.min("key").alias("first")), "copy-fingerprints")
    one = first.select(F.col("simhash").alias("a"), F.col("first").alias("x"))
    other = first.select(F.col("simhash").alias("b"), F.col("first").alias("y"))
    across = fingerprint_links(first.select("simhash"), close).join(one, "a").join(other, "b").select("x", "y")
    same = prints.join(first, "simhash").where("key <> first").select(F.col("first").alias("x"), F.col("key").alias("y"))
    return across.unionByName(same).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    a = sets.select(F.col("key").alias("a"), F.col("shingles").alias("x"))
    b = sets.select(F.col("key").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y").mapInArrow(
        partial(_verify, similarity=settings.similarity), "a long, b long")


def _rooted(known: DataFrame, roots: DataFrame) -> DataFrame:
    """``known`` with the ``root`` of each text, itself where nothing has connected it."""
    return known.join(roots, known["key"] == roots["node"], "left").withColumn("root", F.coalesce("root", "key")).drop("node")


def _key():
    """A text's hash; all texts without a word have the same."""
    return F.when(F.coalesce(F.col("text").rlike(WORD), F.lit(False)), F.xxhash64("text")).otherwise(F.lit(0))


def _crowds(crowded: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """Links of large shards: first all of a few bands, then of the others what these have left apart."""
    known = materialise(known, "copies-known")
    first = _cells(_apart(crowded.where(F.col("band") < LEADING), known), known, settings)
    first = materialise(first, "crowd-links")
    tied = known.select(F.col("key").alias("a"), F.col("root").alias("b")).where("a <> b")
    roots = materialise(connected_components(first.unionByName(tied)), "crowd-roots")
    known = materialise(_rooted(known.drop("root"), roots), "copies-known")
    return first.unionByName(_cells(_apart(crowded.where(F.col("band") >= LEADING), known), known, settings))


def _apart(crowded: DataFrame, known: DataFrame) -> DataFrame:
    """The shards whose texts are not all connected."""
    rooted = crowded.join(known.select("key", "root"), "key")
    apart = rooted.groupBy("band", "shard").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    apart = materialise(apart.select("band", "shard"), "crowds-apart")
    return crowded.join(F.broadcast(apart) if fits_broadcast(apart) else apart, ["band", "shard"], "left_semi")


def _cells(crowded: DataFrame, known: DataFrame, settings: Settings) -> DataFrame:
    """Every block of a shard meets every other in a task; blocks are cut by their number of texts and by bytes."""
    weighed = crowded.join(known.select("key", F.octet_length("shingles").alias("bytes")), "key")
    sizes = weighed.groupBy("band", "shard").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    sizes = materialise(sizes, "crowd-sizes")
    # Cells of few bytes may be much work, so their number decides, not adaptive execution.
    pairs = sizes.agg(F.sum(F.col("blocks").cast("long") * (F.col("blocks") + 1) / 2)).first()[0] or 1
    tasks = max(int(crowded.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(pairs) // CELLS_PER_TASK)
    cut = crowded.join(F.broadcast(sizes) if fits_broadcast(sizes) else sizes, ["band", "shard"]).withColumn(
        "own", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    cells = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "shard", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "key")
    full = cells.join(known, "key").select("band", "shard", "low", "high", "key", "simhash", "shingles", "root")
    ordered = full.repartition(tasks, "band", "shard", "low", "high").sortWithinPartitions("band", "shard", "low", "high", "key")
    return ordered.mapInArrow(partial(_search_sets, settings=settings), "a long, b long")


def _texts(piece: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in piece.column(1).cast(pa.binary()).to_pylist()]


def _shingles(text: bytes, settings: Settings) -> np.ndarray:
    """The different shingle hashes of a text, sorted."""
    hashes = b"".join(shingle_hashes(text, settings.shingle))
    return np.unique(np.frombuffer(hashes, dtype=np.uint64))


def _simhash(hashes: np.ndarray) -> bytes:
    """The fingerprint of a set of shingles: each counts once, as in the similarity."""
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes)).tobytes()


@released
def _sketch(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    rng = np.random.default_rng(settings.seed)
    count = settings.bands * settings.band
    factors = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    terms = rng.integers(0, 1 << 63, count, dtype=np.uint64)
    weights = rng.integers(0, 1 << 63, settings.band, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for batch in batches:
        for piece in pieces(batch):
            prints, bands = [], []
            for text in _texts(piece):
                hashes = _shingles(text, settings)
                prints.append(_simhash(hashes))
                least = np.full(count, np.iinfo(np.uint64).max)
                for start in range(0, len(hashes), 4096):
                    mixed = hashes[start : start + 4096, None] * factors + terms
                    np.minimum(least, (mixed ^ (mixed >> np.uint64(31))).min(axis=0), out=least)
                values = (least.reshape(settings.bands, settings.band) * weights).sum(axis=1, dtype=np.uint64)
                bands.append((values ^ (values >> np.uint64(29))).view(np.int64))
            flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
            ends = np.arange(len(bands) + 1, dtype=np.int32) * settings.bands
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(np.frombuffer(b"".join(prints), dtype=">i8").astype(np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["key", "simhash", "bands"],
            )


@released
def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of small shards."""
    for batch in whole_groups(batches, 2):
        key = batch.column(2).to_numpy()
        a, b = _all_pairs(group_starts(batch, 2))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(key[a], key[b])), pa.array(np.maximum(key[a], key[b]))], names=["a", "b"])


def _all_pairs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row with those after it in its group."""
    ends = np.repeat(starts[1:], np.diff(starts))
    later = ends - np.arange(len(ends)) - 1
    a = np.repeat(np.arange(len(ends)), later)
    return a, a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(later) - later, later)


@released
def _sets(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    seen: set = set()
    for batch in batches:
        for piece in pieces(batch):
            keys, sets = [], []
            for key, text in zip(piece.column(0).to_pylist(), _texts(piece)):
                if key not in seen:
                    seen.add(key)
                    keys.append(key)
                    sets.append(_shingles(text, settings).tobytes())
            if len(seen) > 500_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sets, pa.binary())], names=["key", "shingles"])


def _alike(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """Whether two sorted sets are similar; two empty ones are."""
    small, large = sorted((len(x), len(y)))
    if small < similarity * large:
        return False
    common = len(np.intersect1d(x, y, assume_unique=True))
    return common >= similarity * (small + large - common)


@released
def _verify(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            near = [
                _alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), similarity)
                for x, y in zip(piece.column(2).to_pylist(), piece.column(3).to_pylist())
            ]
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([piece.column(0).filter(keep), piece.column(1).filter(keep)], names=["a", "b"])


@released
def _search_sets(batches: Iterator[pa.RecordBatch], settings: Settings) -> Iterator[pa.RecordBatch]:
    """In each cell the tree's finds are compared first, then all pairs that these left apart; one link per member and group.

    Members that are known to be connected, by their ``root``, count as compared.
    """
    for batch in whole_groups(batches, 4):
        for start, end in zip(starts := group_starts(batch, 4), starts[1:]):
            cell = batch.slice(start, end - start)
            keys, known = cell.column(4).to_numpy(), cell.column(7).to_numpy()
            _, first, label = np.unique(known, return_index=True, return_inverse=True)
            root = first[label]
            if (root == root[:1]).all():
                continue
            sets = [np.frombuffer(s, np.uint64) for s in cell.column(6).to_pylist()]
            root = forest_components(
                cell.column(5).to_numpy().view(np.uint64), np.array([0, len(keys)]), settings.radius,
                confirm=lambda a, b: _alike(sets[a], sets[b], settings.similarity), root=root)
            root = _joined_by_sets(sets, root, settings.similarity)
            # A link for each member whose group has grown; where it was connected before, one of them is enough.
            tied = np.flatnonzero(root != first[label])
            yield pa.RecordBatch.from_arrays([pa.array(keys[tied]), pa.array(keys[root[tied]])], names=["a", "b"])


def _joined_by_sets(sets: list[np.ndarray], root: np.ndarray, similarity: float) -> np.ndarray:
    """Labels of a cell after every pair of its sets that is not connected yet has been compared.

    Of two that are not connected, one at least is outside of the largest group, so its members are not gone through.
    """
    if not len(sets) or (root == root[0]).all():
        return root
    sizes = np.array([len(s) for s in sets])
    some = np.flatnonzero(sizes)
    starts = np.cumsum(sizes[some]) - sizes[some]
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    at = np.concatenate(([0], np.cumsum(sizes)))
    labels, members = np.unique(root, return_counts=True)
    outside = some[root[some] != labels[members.argmax()]]
    root = root.copy()
    own = np.zeros(len(known), dtype=bool)
    for i in outside.tolist():
        if (root == root[i]).all():
            break
        own[:] = False
        own[flat[at[i] : at[i + 1]]] = True
        common = np.add.reduceat(own[flat], starts, dtype=np.int64)
        near = some[common >= similarity * (sizes[i] + sizes[some] - common)]
        if len(near):
            joined = np.unique(root[near])
            root[np.isin(root, joined)] = joined[0]
    return root
