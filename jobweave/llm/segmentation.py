"""SentencePiece encoding and decoding, with sampled segmentations.

A text's segmentations are the paths of a lattice of pieces. Perturbing the log probability of every
path by Gumbel noise and taking the top k samples k of them without replacement. The paths are not listed: a
search from the root keeps, for each open branch, the largest perturbed value in it, as an A* search does with
an exact bound, and follows the largest. The best path below a branch follows by drawing a piece at each node with its
probability; the siblings it passes become open branches, with values that may not exceed its own.

Pieces never reach over the start of a word, so a text's lattice is a chain of small ones. Those of
all different words of a batch are built together, position by position, in numpy.
"""

from __future__ import annotations

import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from jobweave.llm.arrow import pieces, released
from jobweave.llm.common import replace_columns

SPACE = "▁"
SAMPLED = ("sample", "ids", "log_prob", "perturbed", "log_inclusion")
#: Text that is segmented at once.
_BATCH = 700_000
#: Branches with a smaller log share of the probability cannot win: below what a double can draw.
_LEAST = -40.0
_BYTE = 0x110000
_UNITS = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as a trie in arrays: ``slots``/``states`` is a hash table of (state, symbol) to state."""

    shift: int
    slots: np.ndarray
    states: np.ndarray
    piece: np.ndarray  # of each state, or -1
    log_prob: np.ndarray  # of each piece
    known: np.ndarray  # of each code point, whether it is a piece
    data: bytes  # the texts of all pieces in a row
    at: np.ndarray
    longest: int


def load(model_file: str) -> Vocabulary:
    """The vocabulary of a SentencePiece model, read on the driver; its size bounds what is broadcast.

    Models of merges have ranks in place of probabilities. A piece then gets a probability by its
    rank, falling as 1 / (rank + 10), which holds for the words of natural texts. Characters that are no piece are
    written as the pieces of their UTF-8 bytes.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    texts, plain, of_byte = [""] * size, [], {}
    for i in range(size):
        if model.is_byte(i):
            of_byte[int(model.id_to_piece(i)[3:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            texts[i] = model.id_to_piece(i)
            plain.append(i)
    if len(of_byte) != 256 or any("\n" in texts[i][1:] or re.search(f"[^{SPACE}]{SPACE}", texts[i]) for i in plain):
        raise ValueError("this needs a model with byte pieces, whose pieces stay inside words and lines")
    ranked = sorted(plain, key=lambda i: (-model.get_score(i), i)) + sorted(of_byte.values())
    log_prob = np.zeros(size)
    log_prob[ranked] = -np.log(np.arange(len(ranked)) + 10.0)
    log_prob[ranked] -= np.log(np.exp(log_prob[ranked]).sum())
    symbols = {i: [ord(c) for c in texts[i]] for i in plain} | {i: [_BYTE + b] for b, i in of_byte.items()}
    children: dict[tuple[int, int], int] = {}
    piece = [-1]
    for i, path in symbols.items():
        state = 0
        for symbol in path:
            if (state, symbol) not in children:
                children[state, symbol] = len(piece)
                piece.append(-1)
            state = children[state, symbol]
        piece[state] = i
    bits = int(len(children) * 3).bit_length()
    slots, states = np.zeros(1 << bits, dtype=np.uint64), np.zeros(1 << bits, dtype=np.int64)
    for (state, symbol), to in children.items():
        key = state << 21 | symbol
        at = (key * int(_STEP) & (1 << 64) - 1) >> (64 - bits)
        while states[at]:
            at = (at + 1) & (1 << bits) - 1
        slots[at], states[at] = key, to
    known = np.zeros(sys.maxunicode + 1, dtype=bool)
    known[[ord(texts[i]) for i in plain if len(texts[i]) == 1]] = True
    raw = [texts[i].replace(SPACE, " ").encode() for i in range(size)]
    for b, i in of_byte.items():
        raw[i] = bytes([b])
    return Vocabulary(
        64 - bits, slots, states, np.array(piece), log_prob,
        known,
        b"".join(raw), np.concatenate(([0], np.cumsum([len(r) for r in raw]))), max(map(len, symbols.values())),
    )


def sample_segmentations(
    rows: DataFrame, vocabulary: Vocabulary, key: str, samples: int = 2, seed: int = 2, decoded: bool = False
) -> DataFrame:
    """For each row up to ``samples`` different segmentations of its whole ``text``, one row each.

    Adds ``sample`` (from 0, best perturbed value first), ``ids``, ``log_prob`` (of the segmentation), ``perturbed`` and
    ``log_inclusion``: the log probability that a sample with the same threshold holds it. ``text`` is dropped. The draw
    depends on the ``key`` column and ``seed`` alone: reruns agree, and rows that repeat a key and text get the same; a
    null key counts as 0, a key that is not a number by its hash. A null or empty text has one segmentation,
    without pieces, as has a text that leaves no choice: fewer rows, and certain inclusion. An empty table gives an empty
    result; columns named like the results are replaced. With ``decoded`` the column that ``decode`` adds comes with them:
    the ids are decoded where they were drawn, so that a task needs one worker and no second copy of its rows.
    """
    rows = replace_columns(rows, *SAMPLED, *["decoded"] * decoded)
    number = F.col(key) if isinstance(rows.schema[key].dataType, T.IntegralType) else F.xxhash64(key)
    rows = rows.withColumn("_seed", F.coalesce(number.cast("long"), F.lit(0)))
    kept = [c for c in rows.columns if c not in ("text", "_seed")]
    rows = rows.select(*kept, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), "_seed")
    schema = T.StructType([*(rows.schema[c] for c in kept), *T.StructType.fromDDL(
        "sample int, ids array<int>, log_prob double, perturbed double, log_inclusion double")])
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    sample = partial(_sample, shared=shared, samples=samples, seed=seed)
    if not decoded:
        return rows.mapInArrow(sample, schema)
    place = schema.names.index("ids")
    return rows.mapInArrow(
        lambda batches: _decode(sample(batches), shared=shared, place=place), schema.add("decoded", T.StringType()))


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds ``decoded``, the text of each row's ``ids``; bytes that are no UTF-8 become replacement characters.

    Null ids give a null text. Ids outside of the vocabulary fail the job. U+2581 stands for a blank in
    pieces, so a text that holds it comes back with a blank there.
    """
    rows = replace_columns(rows, "decoded")
    schema = T.StructType([*rows.schema, T.StructField("decoded", T.StringType())])
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)
    return rows.mapInArrow(partial(_decode, shared=shared, place=rows.columns.index("ids")), schema)


@released
def _decode(batches: Iterator[pa.RecordBatch], shared, place: int) -> Iterator[pa.RecordBatch]:
    vocabulary = shared.value
    blob, size = np.frombuffer(vocabulary.data, np.uint8), np.diff(vocabulary.at)
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            piece = batch.slice(start, 256)
            lists = piece.column(place)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
            n = size[ids]
            ends = np.concatenate(([0], np.cumsum(n)))
            out = blob[np.repeat(vocabulary.at[ids] - ends[:-1], n) + np.arange(ends[-1])].tobytes()
            nulls = lists.is_null().to_pylist()
            texts = [
                None if null else out[a:b].decode("utf-8", "replace")[1:]
                for null, a, b in zip(nulls, ends[at[:-1]].tolist(), ends[at[1:]].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(texts, pa.string())], names=[*piece.schema.names, "decoded"])


@released
def _sample(batches: Iterator[pa.RecordBatch], shared, samples: int, seed: int) -> Iterator[pa.RecordBatch]:
    vocabulary = shared.value
    for batch in batches:
        for piece in pieces(batch, _BATCH):
            n = piece.num_columns - 2
            texts, keys = piece.column(n).to_pylist(), piece.column(n + 1).to_numpy()
            for result in segment(texts, keys, vocabulary, samples, seed):
                rows = pa.array(result["row"])
                ids = pa.ListArray.from_arrays(pa.array(result["at"].astype(np.int32)), pa.array(result["ids"]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(piece.column(i).take(rows) for i in range(n)),
                        pa.array(np.full(len(rows), result["sample"], dtype=np.int32)), ids,
                        *(pa.array(result[name]) for name in ("log_prob", "perturbed", "log_inclusion")),
                    ],
                    names=[*piece.schema.names[:n], *SAMPLED],
                )


class Lattices:
    """The lattices of different units. Nodes are numbered by position, then unit; longer units come first."""

    def __init__(self, units: list[str], vocabulary: Vocabulary):
        symbols, size = _symbols(units, vocabulary)
        self.order = np.argsort(-size, kind="stable")
        begin = np.concatenate(([0], np.cumsum(size)))[:-1][self.order]
        size = size[self.order]
        self.rank = np.empty(len(units), dtype=np.int64)
        self.rank[self.order] = np.arange(len(units))
        longest = int(size.max(initial=0))
        # Number of units with at least p symbols: those with a node at p.
        reach = np.searchsorted(-size, -np.arange(longest + 1), side="right")
        base = np.concatenate(([0], np.cumsum(reach)))
        self.units = len(units)
        self.end = base[size] + np.arange(len(units))
        unit = np.repeat(np.arange(len(units)), size)
        place = np.arange(len(unit)) - np.repeat(np.cumsum(size) - size, size)
        symbol = symbols[np.repeat(begin, size) + place]
        found = self._walk(unit, place, symbol, size, base, vocabulary)
        self._fill(found, int(base[-1]), base, longest, vocabulary)

    @staticmethod
    def _walk(unit, place, symbol, size, base, vocabulary):
        """All pieces at all places: per number of symbols the start nodes, end nodes and pieces."""
        found = []
        left = size[unit] - place
        live = np.arange(len(unit))
        state = np.zeros(len(unit), dtype=np.int64)
        for depth in range(vocabulary.longest):
            fits = left[live] > depth
            live, state = live[fits], state[fits]
            state = _next(state, symbol[live + depth], vocabulary)
            on = state > 0
            live, state = live[on], state[on]
            piece = vocabulary.piece[state]
            whole = piece >= 0
            at = live[whole]
            found.append((
                base[place[at]] + unit[at], base[place[at] + depth + 1] + unit[at], piece[whole]))
            if not len(live):
                break
        return found

    def _fill(self, found, nodes, base, longest, vocabulary):
        """Edges by end node, longest piece first; their probabilities given that the node is passed."""
        count = np.zeros(nodes, dtype=np.int64)
        for _, end, _ in found:
            count[end] += 1  # pieces of one length end at different nodes
        self.begin = np.concatenate(([0], np.cumsum(count)))
        free = self.begin[1:].copy()
        self.start = np.empty(self.begin[-1], dtype=np.int32)
        self.piece = np.empty(self.begin[-1], dtype=np.int32)
        for start, end, piece in found:
            free[end] -= 1
            self.start[free[end]] = start
            self.piece[free[end]] = piece
        self.node = np.repeat(np.arange(nodes, dtype=np.int32), count)
        weight = vocabulary.log_prob[self.piece]
        total = np.zeros(nodes)
        self.log = np.empty(len(weight))
        for p in range(1, longest + 1):
            low, high = self.begin[base[p]], self.begin[base[p + 1]]
            value = total[self.start[low:high]] + weight[low:high]
            cut = self.begin[base[p] : base[p + 1]] - low
            most = np.repeat(np.maximum.reduceat(value, cut), count[base[p] : base[p + 1]])
            share = np.exp(value - most)
            sums = np.add.reduceat(share, cut)
            all_ = np.repeat(sums, count[base[p] : base[p + 1]])
            self.log[low:high] = np.log(share / all_)
            total[base[p] : base[p + 1]] = most[cut] + np.log(sums)
        self.share = np.exp(self.log)


def _symbols(units: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Characters of all units in a row, those that are no piece as bytes, and the count of each unit."""
    size = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
    points = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    strange = np.flatnonzero(~vocabulary.known[points])
    if not len(strange):
        return points, size
    width = np.ones(len(points), dtype=np.int64)
    width[strange] = 1 + (points[strange] > 0x7F) + (points[strange] > 0x7FF) + (points[strange] > 0xFFFF)
    to = np.concatenate(([0], np.cumsum(width)))
    out = np.empty(to[-1], dtype=np.int64)
    out[to[:-1]] = points
    for point in np.unique(points[strange]).tolist():
        at = to[:-1][strange[points[strange] == point]]
        for i, byte in enumerate(chr(point).encode()):
            out[at + i] = _BYTE + byte
    ends = np.concatenate(([0], np.cumsum(size)))
    return out, np.diff(to[ends])


def _next(state: np.ndarray, symbol: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """The state after a symbol, 0 if there is none."""
    key = state.astype(np.uint64) << np.uint64(21) | symbol.astype(np.uint64)
    slot = (key * _STEP >> np.uint64(vocabulary.shift)).astype(np.int64)
    to = vocabulary.states[slot]
    other = np.flatnonzero((to > 0) & (vocabulary.slots[slot] != key))
    mask = len(vocabulary.slots) - 1
    while len(other):
        slot[other] = (slot[other] + 1) & mask
        to[other] = vocabulary.states[slot[other]]
        other = other[(to[other] > 0) & (vocabulary.slots[slot[other]] != key[other])]
    return to


def _uniform(*parts: np.ndarray | int) -> np.ndarray:
    """Numbers in (0, 1) that depend on all parts alone."""
    mixed = np.uint64(0)
    for part in parts:
        mixed = (mixed ^ np.asarray(part).astype(np.uint64)) + _STEP
        mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mixed = mixed ^ (mixed >> np.uint64(31))
    return ((mixed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


@dataclass
class _Path:
    """One segmentation of each of some texts: edges of unit ``i`` are ``edge[at[i]:at[i+1]]``, last piece first."""

    texts: np.ndarray
    edge: np.ndarray
    at: np.ndarray


def segment(texts: list[str], keys: np.ndarray, vocabulary: Vocabulary, samples: int, seed: int) -> Iterator[dict]:
    """Per sample number: the ``row`` of each text that has it, and what was drawn, ``ids`` cut at ``at``."""
    names: dict[str, int] = defaultdict(count().__next__)
    unit: list[int] = []
    counts = np.zeros(len(texts), dtype=np.int64)
    for row, text in enumerate(texts):
        found = _UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else []
        counts[row] = len(found)
        unit += map(names.__getitem__, found)
    with np.errstate(over="ignore"):
        yield from _segment(
            Lattices(list(names), vocabulary), np.array(unit, dtype=np.int64), counts, keys, samples, seed)


def _segment(lattices, unit, counts, keys, samples, seed) -> Iterator[dict]:
    rank = lattices.rank[unit] if len(unit) else unit
    first = np.concatenate(([0], np.cumsum(counts)))
    row = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(row)) - first[row] if len(row) else row
    search = _Search(lattices, rank, first, row, within, keys.astype(np.int64), seed)
    alive = np.arange(len(counts))
    best = -np.log(-np.log(_uniform(keys.astype(np.int64), seed, 1)))
    path = search.sample(alive, 0)
    open_ = _none()
    done = []
    for sample in range(samples):
        log_prob, branches = search.branches(path, best[path.texts], sample, open_, samples - sample)
        done.append((path, log_prob, best[path.texts].copy()))
        # The largest open branch of each text leads to its next segmentation, and bounds the last.
        order = np.lexsort((-branches["value"], branches["row"]))
        branches = {k: v[order] for k, v in branches.items()}
        top = np.concatenate((branches["row"][:1] >= 0, branches["row"][1:] != branches["row"][:-1]))
        threshold = np.full(len(counts), -np.inf)
        threshold[branches["row"][top]] = branches["value"][top]
        if sample + 1 == samples or not top.any():
            break
        best[branches["row"][top]] = branches["value"][top]
        chosen = {k: v[top] for k, v in branches.items()}
        open_ = {k: v[~top] for k, v in branches.items()}
        path = search.follow(chosen, [d[0] for d in done], sample + 1)
        search.opened(chosen, len(counts))
    for sample, (path, log_prob, value) in enumerate(done):
        gap = log_prob - threshold[path.texts]
        with np.errstate(divide="ignore", over="ignore"):
            inclusion = np.where(gap < -30, gap, np.log(-np.expm1(-np.exp(gap))))
        piece = lattices.piece[path.edge]
        of = path.at
        # Inside a unit the last piece was drawn first.
        size = np.diff(of)
        reverse = np.repeat(of[:-1] + of[1:] - 1, size) - np.arange(len(piece))
        unit_ends = np.concatenate(([0], np.cumsum(counts[path.texts])))
        yield {
            "sample": sample, "row": path.texts, "ids": piece[reverse], "at": of[unit_ends],
            "log_prob": log_prob, "perturbed": value, "log_inclusion": inclusion,
        }


def _none() -> dict[str, np.ndarray]:
    whole = np.zeros(0, dtype=np.int64)
    return {"row": whole, "value": np.zeros(0), "path": whole, "unit": whole, "step": whole, "edge": whole}


class _Search:
    def __init__(self, lattices, rank, first, row, within, keys, seed):
        self.lattices, self.rank, self.first, self.row, self.within = lattices, rank, first, row, within
        self.keys, self.seed = keys, seed
        self._since: tuple[np.ndarray, np.ndarray] | None = None

    def opened(self, branch: dict, texts: int) -> None:
        """Up to where the siblings of the next paths are open already: the branch they start from."""
        unit, step = np.full(texts, -1), np.full(texts, -1)
        unit[branch["row"]], step[branch["row"]] = branch["unit"], branch["step"]
        self._since = unit, step

    def sample(self, texts: np.ndarray, number: int) -> _Path:
        """The best paths of whole texts."""
        units = _spans(self.first[texts], self.first[texts + 1])
        return self._join(texts, units, [self._walk(units, self.lattices.end[self.rank[units]], np.zeros(len(units), np.int64), number)])

    def follow(self, branch: dict, paths: list[_Path], number: int) -> _Path:
        """The best path below each branch: what led to it, the branch, and a new draw for the rest."""
        texts, at = branch["row"], branch["unit"]
        units = _spans(self.first[texts], self.first[texts + 1])
        fresh = units[units > np.repeat(at, self.first[texts + 1] - self.first[texts])]
        parts = [self._walk(fresh, self.lattices.end[self.rank[fresh]], np.zeros(len(fresh), np.int64), number)]
        parts.append((at, branch["step"], branch["edge"]))
        rest = self.lattices.start[branch["edge"]]
        inside = rest >= self.lattices.units
        parts.append(self._walk(at[inside], rest[inside], branch["step"][inside] + 1, number))
        for p, path in enumerate(paths):
            some = np.flatnonzero(branch["path"] == p)
            if not len(some):
                continue
            base = np.searchsorted(path.texts, texts[some])
            begins = np.concatenate(([0], np.cumsum(self.first[path.texts + 1] - self.first[path.texts])))[base]
            low = path.at[begins]
            high = path.at[begins + at[some] - self.first[texts[some]]] + branch["step"][some]
            edges = _spans(low, high)
            local = np.searchsorted(path.at, edges, side="right") - 1
            unit = local - np.repeat(begins, high - low) + np.repeat(self.first[texts[some]], high - low)
            parts.append((unit, edges - path.at[local], path.edge[edges]))
        return self._join(texts, units, parts)

    def branches(
        self, path: _Path, value: np.ndarray, number: int, open_: dict, most: int
    ) -> tuple[np.ndarray, dict]:
        """Log probability of each path; the open branches, with the ``most`` largest that leave this path."""
        log = self.lattices.log[path.edge]
        size = self.first[path.texts + 1] - self.first[path.texts]
        text_at = path.at[np.concatenate(([0], np.cumsum(size)))]
        total = np.concatenate(([0.0], np.cumsum(log)))
        before = total[:-1] - np.repeat(total[text_at[:-1]], np.diff(text_at))
        log_prob = total[text_at[1:]] - total[text_at[:-1]]
        units = _spans(self.first[path.texts], self.first[path.texts + 1])
        visited = np.flatnonzero(before > _LEAST)
        local = np.repeat(np.arange(len(units)), np.diff(path.at))[visited]
        step = visited - path.at[local]
        unit = units[local]
        if self._since is not None:  # what comes before the branch has been opened already
            since_unit, since_step = self._since[0][self.row[unit]], self._since[1][self.row[unit]]
            new = (unit > since_unit) | ((unit == since_unit) & (step > since_step))
            visited, step, unit = visited[new], step[new], unit[new]
        chosen = path.edge[visited]
        node = self.lattices.node[chosen]
        width = self.lattices.begin[node + 1] - self.lattices.begin[node]
        edge = _spans(self.lattices.begin[node], self.lattices.begin[node + 1])
        of = np.repeat(np.arange(len(visited)), width)
        other = edge != chosen[of]
        edge, of = edge[other], of[other]
        row = self.row[unit[of]]
        place = before[visited[of]] + self.lattices.log[edge]
        bound = value[np.searchsorted(path.texts, row)]
        draw = _uniform(self.keys[row], self.seed, 2 + number, self.within[unit[of]], step[of], edge - self.lattices.begin[node[of]] + 1)
        drawn = place - np.log(np.exp(place - bound) - np.log(draw))
        top = _largest(row, drawn, most)
        of = of[top]
        found = {
            "row": row[top], "value": drawn[top], "path": np.full(len(top), number),
            "unit": unit[of], "step": step[of], "edge": edge[top],
        }
        return log_prob, {k: np.concatenate((open_[k], found[k])) for k in found}

    def _walk(self, units: np.ndarray, node: np.ndarray, step: np.ndarray, number: int):
        """Draws edges from ``node`` back to the start of each unit: units, steps, edges."""
        out = []
        begin, share, start = self.lattices.begin, self.lattices.share, self.lattices.start
        seeds = self.keys[self.row[units]] if len(units) else units
        while len(units):
            edge = begin[node]
            last = begin[node + 1] - 1
            left = np.zeros(len(units))
            several = np.flatnonzero(last > edge)
            left[several] = _uniform(seeds[several], self.seed, 2 + number, self.within[units[several]], step[several])
            moving = several[left[several] >= share[edge[several]]]
            while len(moving):
                left[moving] -= share[edge[moving]]
                edge[moving] += 1
                moving = moving[(edge[moving] < last[moving]) & (left[moving] >= share[edge[moving]])]
            out.append((units, step, edge))
            node = start[edge]
            on = node >= self.lattices.units
            units, node, step, seeds = units[on], node[on], step[on] + 1, seeds[on]
        if not out:
            return units, step, units
        return tuple(np.concatenate(x) for x in zip(*out))

    def _join(self, texts: np.ndarray, units: np.ndarray, parts: list) -> _Path:
        unit, step, edge = (np.concatenate(x) for x in zip(*parts))
        count = np.bincount(unit, minlength=len(self.row) + 1)
        at = np.concatenate(([0], np.cumsum(count[units])))
        to = np.empty(len(count), dtype=np.int64)
        to[units] = at[:-1]
        out = np.empty(len(edge), dtype=np.int64)
        out[to[unit] + step] = edge
        return _Path(texts, out, at)


def _largest(row: np.ndarray, value: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` largest values of each row; rows are in order."""
    found = []
    left = np.arange(len(row))
    for _ in range(most):
        if not len(left):
            break
        begins = np.flatnonzero(np.concatenate(([True], row[left[1:]] != row[left[:-1]])))
        size = np.diff(np.append(begins, len(left)))
        at_most = value[left] == np.repeat(np.maximum.reduceat(value[left], begins), size)
        found.append(left[at_most])
        left = left[~at_most]
    return np.sort(np.concatenate(found)) if found else left


def _spans(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All integers of all half-open ranges, in order."""
    size = high - low
    return np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
