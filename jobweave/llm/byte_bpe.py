"""Byte-level BPE encoding and decoding by ranks.

A text is cut into the matches of a pattern, and each is merged by itself. Over the byte positions of a match stands a
segment tree: a leaf holds the rank of the pair of tokens that begins at its position, and each inner node the least
of its leaves, the leftmost of equal ones, so the root names the next merge. A merge changes the pairs of the two live
neighbours and clears that of the swallowed token: three point updates, each up one path to the root.

Matches repeat, so a task keeps the ids of those it has seen lately. New short ones of a piece of text are merged together:
their trees are the rows of a matrix, and every step does one merge in each tree that has any left.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from jobweave.llm.arrow import pieces, released
from jobweave.llm.common import replace_columns

#: Matches that a worker remembers; the older half goes when there are more.
_REMEMBERED = 400_000
#: Bytes up to which matches are merged together.
_SHORT = 64
#: Longer texts are matched step by step.
_LONG = 1 << 20


@dataclass(frozen=True)
class Ranks:
    """Byte strings in order of their ranks, which are the ids, and the pattern of what is merged by itself."""

    tokens: tuple[bytes, ...]
    pattern: str


def load(ranks_file: str, pattern: str) -> Ranks:
    """Reads lines of a base64 token and its rank, on the driver; the file's size bounds what is broadcast."""
    with open(ranks_file, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    if sorted(ranks) != list(range(len(ranks))) or not {bytes([b]) for b in range(256)} <= set(ranks.values()):
        raise ValueError("ranks must run from 0 without a gap and hold every single byte")
    return Ranks(tuple(ranks[i] for i in range(len(ranks))), pattern)


def encode(rows: DataFrame, ranks: Ranks) -> DataFrame:
    """Replaces ``text`` by ``ids``, an array of the ids of the whole text, without special tokens.

    A match that is itself a token gets that token's id, any other is merged pair by pair, least rank first, leftmost
    first among equals. Null and empty texts have no ids. Strings like those of special tokens are ordinary text. Text of no
    match, if the pattern leaves any out, is dropped. Rows are independent: repeated ones get the same ids, and an empty table gives an empty
    result. A column ``ids`` of the input is replaced, all others are kept.
    """
    rows = replace_columns(rows, "ids")
    kept = [c for c in rows.columns if c != "text"]
    rows = rows.select(*kept, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])
    shared = rows.sparkSession.sparkContext.broadcast(ranks)
    return rows.mapInArrow(partial(_encode, shared=shared), schema)


def decode(rows: DataFrame, ranks: Ranks) -> DataFrame:
    """Adds ``decoded``, the bytes of each row's ``ids``; null ids give null.

    Ids outside of the ranks fail the job. A column ``decoded`` of the input is replaced.
    """
    rows = replace_columns(rows, "decoded")
    schema = T.StructType([*rows.schema, T.StructField("decoded", T.BinaryType())])
    shared = rows.sparkSession.sparkContext.broadcast(ranks)
    return rows.mapInArrow(partial(_decode, shared=shared, place=rows.columns.index("ids")), schema)


def merge(word: bytes, rank_of: dict[bytes, int]) -> list[int]:
    """The ids of one match."""
    if word in rank_of:
        return [rank_of[word]]
    size = len(word)
    width = 1 << (size - 1).bit_length()
    none = len(rank_of) * width  # above every rank and place
    tree = [none] * (2 * width)  # rank * width + place, so that the least is the leftmost of the least rank
    for place in range(size - 1):
        rank = rank_of.get(word[place : place + 2])
        if rank is not None:
            tree[width + place] = rank * width + place
    for node in range(width - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    after = list(range(1, size + 2))  # where the token that begins here ends
    before = list(range(-1, size))
    while tree[1] < none:
        place = tree[1] % width
        swallowed = after[place]
        end = after[swallowed]
        after[place], before[end] = end, place
        changed = [(swallowed, none), (place, none)]
        if end < size:
            changed[1] = place, _pair(word, place, after[end], rank_of, width, none)
        if place:
            changed.append((before[place], _pair(word, before[place], end, rank_of, width, none)))
        for leaf, value in changed:
            node = width + leaf
            while node and tree[node] != value:
                tree[node] = value
                value = min(value, tree[node ^ 1])
                node >>= 1
    ids, place = [], 0
    while place < size:
        ids.append(rank_of[word[place : after[place]]])
        place = after[place]
    return ids


def _pair(word: bytes, start: int, end: int, rank_of: dict[bytes, int], width: int, none: int) -> int:
    rank = rank_of.get(word[start:end])
    return none if rank is None else rank * width + start


class Pairs:
    """The token that two tokens make, for many pairs at once."""

    def __init__(self, ranks: Ranks):
        rank_of = {token: i for i, token in enumerate(ranks.tokens)}
        made = sorted(
            (rank_of[token[:cut]] << 32 | rank_of[token[cut:]], i)
            for i, token in enumerate(ranks.tokens) for cut in range(1, len(token))
            if token[:cut] in rank_of and token[cut:] in rank_of)
        self.none = len(rank_of)
        self.keys, self.ids = (np.array([m[k] for m in made] + [last], dtype=np.int64) for k, last in ((0, -1), (1, 0)))
        self.single = np.array([rank_of[bytes([b])] for b in range(256)])

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids, or ``none`` where the two make no token or one of them is missing (-1)."""
        keys = left << 32 | right
        at = np.searchsorted(self.keys[:-1], keys)
        return np.where((self.keys[at] == keys) & (left >= 0) & (right >= 0), self.ids[at], self.none)


def merge_together(words: list[bytes], pairs: Pairs) -> list[np.ndarray]:
    """The ids of each of ``words``, which are no tokens themselves: a row of trees, merged in step."""
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    width = 1 << max(1, int(sizes.max() - 1).bit_length())
    rows, none = np.arange(len(words)), pairs.none * width
    inside = np.arange(width) < sizes[:, None]
    token = np.full((len(words), width + 1), -1, dtype=np.int64)
    token[:, :-1][inside] = pairs.single[np.frombuffer(b"".join(words), dtype=np.uint8)]
    tree = np.full((len(words), 2 * width), none, dtype=np.int64)
    rank = pairs.of(token[:, :-1], token[:, 1:])
    tree[:, width:] = np.where(rank < pairs.none, rank * width + np.arange(width), none)
    for low in (1 << k for k in reversed(range(width.bit_length() - 1))):
        tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
    after = np.minimum(np.tile(np.arange(1, width + 2), (len(words), 1)), sizes[:, None])
    before = np.tile(np.arange(-1, width), (len(words), 1))

    def update(leaf: np.ndarray, value: np.ndarray) -> None:
        node = width + leaf
        tree[rows, node] = value
        while node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def pair(start: np.ndarray) -> None:
        """The pair that begins at ``start``; beyond the last token of a word there is none."""
        end = after[rows, start]
        rank = pairs.of(token[rows, start], np.where(end < sizes[rows], token[rows, end], -1))
        update(start, np.where(rank < pairs.none, rank * width + start, none))

    while True:
        rows = live = rows[tree[rows, 1] < none]
        if not len(live):
            break
        made, place = np.divmod(tree[rows, 1], width)
        swallowed = after[rows, place]
        end = after[rows, swallowed]
        token[rows, place], token[rows, swallowed] = made, -1
        after[rows, place], before[rows, end] = end, place
        update(swallowed, np.full(len(rows), none))
        pair(place)
        former = before[rows, place]
        rows, former = rows[former >= 0], former[former >= 0]
        if len(rows):
            pair(former)
        rows = live
    left = token[:, :-1] >= 0
    return np.split(token[:, :-1][left].astype(np.int32), np.cumsum(left.sum(axis=1))[:-1])


class _Encoder(dict):
    """The ids of each match as raw integers: those in use, and the generation before."""

    def __init__(self, ranks: Ranks):
        self.rank_of = {token: i for i, token in enumerate(ranks.tokens)}
        self.pairs = Pairs(ranks)
        self.pattern = regex.compile(ranks.pattern)
        self.older: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; matches of all short ones are merged together, those of a long one step by step."""
        words = [self.pattern.findall(text) if len(text) < _LONG else None for text in texts]
        self.learn([w for some in words if some for w in some])
        ids = [None if some is None else self.joined(some) for some in words]
        return [self.long(text) if some is None else some for text, some in zip(texts, ids)]

    def long(self, text: str) -> bytes:
        words = (m.group() for m in self.pattern.finditer(text))
        found = []
        while some := list(islice(words, 1 << 16)):
            self.learn(some)
            found.append(self.joined(some))
        return b"".join(found)

    def joined(self, words: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, words))

    def learn(self, words: list[str]) -> None:
        if len(self) > _REMEMBERED // 2:
            self.older = dict(self)
            self.clear()
        by_width: dict[int, list[str]] = {}
        for word in set(words).difference(self):
            raw = word.encode()
            if (ids := self.older.get(word)) is not None:
                self[word] = ids
            elif raw in self.rank_of:
                self[word] = np.array([self.rank_of[raw]], dtype=np.int32).tobytes()
            elif len(raw) > _SHORT:
                self[word] = np.array(merge(raw, self.rank_of), dtype=np.int32).tobytes()
            else:
                by_width.setdefault((len(raw) - 1).bit_length(), []).append(word)
        for some in by_width.values():
            for start in range(0, len(some), 1 << 14):
                part = some[start : start + (1 << 14)]
                for word, ids in zip(part, merge_together([w.encode() for w in part], self.pairs)):
                    self[word] = ids.tobytes()


@released
def _encode(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    encoder = _Encoder(shared.value)
    for batch in batches:
        for piece in pieces(batch):
            raw = encoder.encode(piece.column(piece.num_columns - 1).to_pylist())
            ends = np.cumsum([0, *map(len, raw)]) // 4
            ids = pa.array(np.frombuffer(b"".join(raw), dtype=np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), ids)
            yield pa.RecordBatch.from_arrays([*piece.columns[:-1], lists], names=[*piece.schema.names[:-1], "ids"])


@released
def _decode(batches: Iterator[pa.RecordBatch], shared, place: int) -> Iterator[pa.RecordBatch]:
    tokens = shared.value.tokens
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            piece = batch.slice(start, 256)
            texts = []
            for row in piece.column(place):
                texts.append(b"".join([tokens[i] for i in row.values.to_numpy().tolist()]) if row.is_valid else None)
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(texts, pa.binary())], names=[*piece.schema.names, "decoded"])
