"""Near-duplicates by SimHash, found in BK-trees.

Fingerprints of 64 bits are cut into ``radius + 2`` blocks. Two of them at most ``radius`` bits
apart agree on two blocks at least, so each pair of blocks shards the fingerprints, and close
ones meet in a shard. A task builds the BK-tree of its shard: a child hangs on its parent by their
integer distance, and a search follows only edges within the radius of its own distance.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from jobweave.llm.arrow import group_starts, pieces, released, runs, whole_groups
from jobweave.llm.common import replace_columns
from jobweave.llm.components import connected_components
from jobweave.storage import materialise

SEED = 42
BITS = 64
#: Fingerprints per tree; a shard of more is cut into several trees, each searched by all of the shard.
TREE = 8192
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_TEXT_BLOCK = 1 << 22
_PAIRS = 2_000_000


def near_duplicates(documents: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of each row of ``doc_id, text``.

    Fingerprints within ``radius`` bits are linked; the component is the smallest ``doc_id`` that
    links reach. Null and empty texts have fingerprint zero and link like any other, as do copies and
    repeated rows. A null ``doc_id`` never names a component, unless its component has no other. An empty table gives an
    empty result; further columns are ignored.
    """
    prints = materialise(
        fingerprints(documents.select(F.col("doc_id").cast("long"), "text"), shingle).select("doc_id", "simhash"),
        "simhash",
    )
    distinct = materialise(
        prints.groupBy("simhash").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "simhash-distinct"
    )
    roots = connected_components(links(distinct.select("simhash"), radius))
    linked = roots.join(distinct, roots["node"] == distinct["simhash"]).select("simhash", "root", "first")
    linked = materialise(linked, "simhash-linked")
    firsts = linked.groupBy("root").agg(F.min("first").alias("component"))
    components = linked.select("simhash", "root").join(firsts, "root").select("simhash", "component")
    copies = distinct.where("n > 1").join(linked.select("simhash"), "simhash", "left_anti")
    components = components.unionByName(copies.select("simhash", F.col("first").alias("component")))
    return prints.join(components, "simhash", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("simhash"), 16, "0")).alias("fingerprint"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """Add ``simhash`` (64 bits as a long) of each whole ``text``.

    A-Z count as lower case; words are runs of anything but ASCII white space; every run of ``shingle`` words
    joined by blanks counts, as often as it comes; shorter texts count as one. A bit is set if it is in
    over half of the shingles' XXH64 hashes. No word: zero.
    """
    rows = replace_columns(documents, "simhash")
    schema = rows.withColumn("simhash", F.lit(0).cast("long")).schema
    return rows.mapInArrow(
        partial(_fingerprint, place=rows.columns.index("text"), shingle=shingle), schema)


def links(distinct: DataFrame, radius: int = 3, tree: int = TREE) -> DataFrame:
    """``a, b``: links within ``radius`` bits that connect what belongs together, of distinct ``simhash``.

    Not every pair: each tree returns a star per group that it connects, so the rows grow with the
    fingerprints even where thousands of them are close.
    """
    masks = [sum(m) for m in combinations(_blocks(radius + 2), 2)]
    keyed = distinct.select(
        "simhash",
        F.posexplode(F.array(*(F.col("simhash").bitwiseAND(F.lit(_signed(m))) for m in masks))).alias("mask", "shard"),
    )
    # Shards of one fingerprint have nothing to search.
    sizes = materialise(
        keyed.groupBy("mask", "shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-shards"
    )
    cut = keyed.join(sizes, ["mask", "shard"]).withColumn("trees", F.ceil(F.col("n") / tree).cast("int"))
    own = F.pmod(F.xxhash64("simhash"), F.col("trees")).cast("int")
    cells = cut.withColumn("own", own).select(
        "mask", "shard", "simhash", "own", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)).alias("other")
    ).select(
        "mask", "shard", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "simhash"
    )
    ordered = cells.repartition("mask", "shard", "low", "high").sortWithinPartitions("mask", "shard", "low", "high")
    return ordered.mapInArrow(partial(_search, radius=radius), "a long, b long").distinct()


def _blocks(n: int) -> list[int]:
    """Masks of ``n`` blocks of bits, as equal as can be."""
    cuts = [BITS * i // n for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


@released
def _fingerprint(batches: Iterator[pa.RecordBatch], place: int, shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            texts = piece.column(place).cast(pa.binary()).to_pylist()
            values = np.frombuffer(b"".join(simhash(t or b"", shingle) for t in texts), dtype=">i8")
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(values.astype(np.int64))], names=[*piece.schema.names, "simhash"])


def simhash(text: bytes, shingle: int = 3) -> bytes:
    """The fingerprint of a text, eight bytes, highest bit first."""
    ones, total = np.zeros(BITS, dtype=np.int64), 0
    for hashes in shingle_hashes(text, shingle):
        bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(bits)
    return np.packbits(ones * 2 > total).tobytes() if total else bytes(8)


def shingle_hashes(text: bytes, shingle: int) -> Iterator[bytes]:
    """The hashes of all shingles of a text, eight bytes each, in blocks of bounded size."""
    held: list[bytes] = []
    any_yet = False
    start, text = 0, text.lower()
    while start < len(text):
        cut = _SPACE.search(text, start + _TEXT_BLOCK)
        end = cut.end() if cut else len(text)
        words = held + text[start:end].split()
        start = end
        if len(words) >= shingle:
            any_yet = True
            found = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
            yield b"".join(map(xxhash.xxh64_digest, found, repeat(SEED)))
            held = words[len(words) - shingle + 1 :] if shingle > 1 else []
        else:
            held = words
    if held and not any_yet:
        yield xxhash.xxh64_digest(b" ".join(held), SEED)


@released
def _search(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Stars of connected fingerprints, from the trees of all shards in each batch."""
    for batch in whole_groups(batches, 4):
        values = batch.column(4).to_numpy().view(np.uint64)
        starts = group_starts(batch, 4)
        root = forest_components(values, starts, radius)
        tied = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[tied].view(np.int64)), pa.array(values[root[tied]].view(np.int64))], names=["a", "b"])


def tree_links(values: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within the radius in each shard, both ways round; for small shards."""
    return _Forest(values, starts).search(np.arange(len(values)), radius, np.arange(len(values)))


def forest_components(
    values: np.ndarray, starts: np.ndarray, radius: int, confirm: Callable[[int, int], bool] | None = None,
    root: np.ndarray | None = None,
) -> np.ndarray:
    """For each fingerprint an index that all fingerprints connected with it in its shard share.

    ``confirm`` may turn down a link of two fingerprints; it is asked only for those not yet connected. ``root`` tells which are from the start.
    """
    tree = _Forest(values, starts)
    root = np.arange(len(values)) if root is None else root
    sizes = np.repeat(np.diff(starts), np.diff(starts))
    rank = np.arange(len(values)) - np.repeat(starts[:-1], np.diff(starts))
    queries = np.argsort(rank, kind="stable")
    load = np.cumsum(sizes[queries])
    at = 0
    while at < len(queries):
        upto = max(at + 1, int(np.searchsorted(load, (load[at - 1] if at else 0) + _PAIRS)))
        found = tree.search(queries[at:upto], radius, root)
        root = _union(root, *found) if confirm is None else _union_confirmed(root, *found, confirm)
        at = upto
    return root


def _union(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the groups of ``a`` and ``b``."""
    pairs = np.unique(np.sort(np.stack((root[a], root[b]), axis=1), axis=1), axis=0)
    parent = root.copy()
    for low, high in pairs.tolist():
        while parent[low] != low:
            low = parent[low]
        while parent[high] != high:
            high = parent[high]
        if low != high:
            parent[max(low, high)] = min(low, high)
    while not np.array_equal(parent, parent[parent]):
        parent = parent[parent]
    return parent


def _union_confirmed(root: np.ndarray, a: np.ndarray, b: np.ndarray, confirm: Callable[[int, int], bool]) -> np.ndarray:
    parent = root.copy()

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in zip(a.tolist(), b.tolist()):
        x, y = top(i), top(j)
        if x != y and confirm(i, j):
            parent[max(x, y)] = min(x, y)
    return np.array([top(i) for i in range(len(parent))])


class _Forest:
    """A BK-tree per shard, built and searched level by level for all shards at once."""

    def __init__(self, values: np.ndarray, starts: np.ndarray):
        self.values = values
        n = len(values)
        self.top = np.repeat(starts[:-1], np.diff(starts))  # the root of each value's tree
        self.parent = np.full(n, -1)
        self.edge = np.zeros(n, dtype=np.int64)
        self.levels = [starts[:-1]]
        waiting = np.setdiff1d(np.arange(n), starts[:-1], assume_unique=True)
        above = self.top[waiting]
        while len(waiting):
            distance = np.bitwise_count(values[waiting] ^ values[above]).astype(np.int64)
            key = above * (BITS + 1) + distance
            order = np.argsort(key, kind="stable")
            begins = runs(key[order])
            first = order[begins[:-1]]
            child = waiting[first]
            self.parent[child], self.edge[child] = above[first], distance[first]
            self.levels.append(child)
            below = np.empty(len(waiting), dtype=np.int64)
            below[order] = np.repeat(child, np.diff(begins))
            rest = np.ones(len(waiting), dtype=bool)
            rest[first] = False
            waiting, above = waiting[rest], below[rest]
        self.children = np.argsort(self.parent, kind="stable")[len(starts) - 1 :]
        counts = np.bincount(self.parent[self.children], minlength=n) if n else np.zeros(0, np.int64)
        self.begins = np.concatenate(([0], np.cumsum(counts)))

    def search(self, queries: np.ndarray, radius: int, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links of the queries to other groups. A subtree wholly in the query's group has none and is passed by."""
        mixed = self._mixed(root)
        node = self.top[queries]
        found_q, found_n = [], []
        while len(queries):
            open_ = mixed[node] | (root[node] != root[queries])
            queries, node = queries[open_], node[open_]
            distance = np.bitwise_count(self.values[queries] ^ self.values[node]).astype(np.int64)
            near = (distance <= radius) & (root[node] != root[queries])
            found_q.append(queries[near])
            found_n.append(node[near])
            count = self.begins[node + 1] - self.begins[node]
            from_ = np.repeat(np.arange(len(node)), count)
            ends = np.cumsum(count)
            child = self.children[np.arange(len(from_)) + np.repeat(self.begins[node] - (ends - count), count)]
            follow = np.abs(self.edge[child] - distance[from_]) <= radius
            queries, node = queries[from_[follow]], child[follow]
        return np.concatenate(found_q or [queries]), np.concatenate(found_n or [queries])

    def _mixed(self, root: np.ndarray) -> np.ndarray:
        """Whether the subtree of each node holds more than one group."""
        mixed = np.zeros(len(root), dtype=bool)
        for level in reversed(self.levels[1:]):
            up = self.parent[level]
            mixed[up[mixed[level] | (root[level] != root[up])]] = True
        return mixed
