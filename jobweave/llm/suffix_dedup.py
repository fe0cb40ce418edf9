"""Removal of repeated passages by a depth-limited radix sort of suffixes.

Two strings of ``length`` bytes that are equal also agree on which of their k-mers has the smallest hash, so it
is enough to sort the suffixes that start at such anchors, with what stands left of them: one in about 180
positions. The first digit is the anchor's k-mer, the second the whole context that its windows span; both are
counted by Spark, and what is unique drops out. What is left is sorted by most-significant-digit passes
of eight bytes, to the right and to the left, through ``length`` bytes only. A window is
repeated exactly if it falls in a group of equals.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from jobweave.joins import fits_broadcast
from jobweave.llm.arrow import content, group_starts, pieces, released, runs, whole_groups
from jobweave.storage import materialise

KMER = 32
#: Contexts of one k-mer that a task sorts; those of more frequent ones are counted window by window.
GROUP = 4096
_CHUNK = 1 << 18
_PLACE = np.uint64((1 << 20) - 1)
_KEY = ["k1", "k2"]
ANCHORS = "kmer long, ctx long, k1 long, k2 long, pos int, lo int, hi int"
RUNS = "kmer long, ctx long, first int, last int"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def remove_repeats(documents: DataFrame, length: int = 400) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` (the bytes that stay) of each row of ``doc_id, text``.

    Removes every byte under a string of ``length`` bytes of the UTF-8 text that also starts elsewhere,
    in the same or another document. Null texts count as empty; texts shorter than
    ``length`` stay as they are; repeated rows and copies lose everything, if long enough. An
    empty table gives an empty result; null ids and further columns do not matter.
    """
    if length < 2 * KMER:
        raise ValueError(f"length must be at least {2 * KMER} bytes")
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumns(
        {"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")}
    )
    anchors = materialise(
        rows.select("text", *_KEY).mapInArrow(partial(_anchors, length=length), ANCHORS), "anchors"
    )
    anchors = anchors.withColumn("place", F.xxhash64(*_KEY, "pos"))
    contexts = materialise(
        anchors.groupBy("kmer", "ctx").agg(
            F.min("place").alias("place"), (F.min("place") != F.max("place")).alias("many")),
        "contexts",
    )
    # K-mers with several contexts, not all of them known to be repeated.
    open_ = materialise(
        contexts.groupBy("kmer").agg(F.count(F.lit(1)).alias("n"), F.bool_and("many").alias("known"))
        .where((F.col("n") > 1) & ~F.col("known")).select("kmer", (F.col("n") > GROUP).alias("large")),
        "open-kmers",
    )
    # The bytes of such a context are read at one of its places.
    places = contexts.join(open_, "kmer").join(anchors, ["kmer", "ctx", "place"])
    repeated = _repeated_windows(rows, places, length)
    copied = materialise(rows.groupBy(*_KEY).count().where("count > 1").select(*_KEY), "copied")
    verdict = _spans(anchors, contexts, repeated, copied, length)
    return join_measured(rows, verdict, _KEY).select("doc_id", "text", "copied", "spans").mapInArrow(
        partial(_cut, length=length), RESULT)


def join_measured(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Broadcasts ``lookup`` if its measured size allows; otherwise adaptive execution splits hot keys."""
    return rows.join(F.broadcast(lookup) if fits_broadcast(lookup) else lookup, on, how)


def _repeated_windows(rows: DataFrame, places: DataFrame, length: int) -> DataFrame:
    """Runs of repeated windows of contexts that share a k-mer, by how far their start is left of the anchor."""
    wanted = materialise(
        places.groupBy(*_KEY).agg(
            F.collect_set(F.struct("kmer", "ctx", "large", "pos", "lo", "hi")).alias("wanted")),
        "wanted",
    )
    parts = join_measured(rows.select("text", *_KEY), wanted, _KEY, "inner").mapInArrow(
        partial(_contexts, length=length), "kmer long, ctx long, large boolean, left int, data binary")
    hot = not wanted.where(F.exists("wanted", lambda w: w["large"])).isEmpty()
    if hot:
        parts = materialise(parts, "context-bytes")
    sorted_parts = parts.where(~F.col("large")).drop("large").repartition("kmer").sortWithinPartitions("kmer", "ctx")
    found = sorted_parts.mapInArrow(partial(_sort_groups, length=length), RUNS)
    if hot:
        windows = parts.where("large").mapInArrow(
            partial(_windows, length=length), "kmer long, ctx long, back int, window long")
        key = ["kmer", "back", "window"]
        several = windows.groupBy(*key).agg((F.min("ctx") != F.max("ctx")).alias("several")).where("several").drop("several")
        frequent = windows.join(several, key, "left_semi").select(
            "kmer", "ctx", F.col("back").alias("first"), F.col("back").alias("last"))
        found = found.unionByName(frequent)
    return found


def _spans(anchors: DataFrame, contexts: DataFrame, repeated: DataFrame, copied: DataFrame, length: int) -> DataFrame:
    """``k1, k2, copied, spans``: what to remove of each text that loses bytes."""
    none = F.lit(None).cast("int")
    whole = contexts.where("many").select("kmer", "ctx", none.alias("first"), none.alias("last"))
    found = materialise(whole.unionByName(repeated), "repeated")
    single = join_measured(anchors, copied, _KEY, "left_anti").join(found, ["kmer", "ctx"])
    spans = single.groupBy(*_KEY).agg(F.collect_set(F.struct(
        F.coalesce(F.col("pos") - F.col("last"), "lo").alias("start"),
        (F.coalesce(F.col("pos") - F.col("first"), "hi") + length).alias("end"),
    )).alias("spans"))
    nothing = F.lit(None).cast(spans.schema["spans"].dataType)
    return materialise(
        spans.withColumn("copied", F.lit(False)).unionByName(
            copied.withColumn("spans", nothing).withColumn("copied", F.lit(True))),
        "spans",
    )


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number per byte value, and the powers and inverse powers of the rolling hash."""
    state = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    state = (state ^ (state >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    state = (state ^ (state >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    base = 0xD6E8FEB86659FD93
    n = _CHUNK + 4096

    def powers(of: int) -> np.ndarray:
        steps = np.full(n, of, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    return state ^ (state >> np.uint64(31)), powers(base), powers(pow(base, -1, 1 << 64))


def rolling(data: np.ndarray, k: int) -> np.ndarray:
    """A hash of every run of ``k`` bytes."""
    of_byte, power, inverse = _tables()
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(of_byte[data] * power[: len(data)], out=total[1:])
    hashes = (total[k:] - total[:-k]) * inverse[: len(data) - k + 1]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(32))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every run of ``width`` values, from running minima inside blocks of that width."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = n - width + 1
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def find_anchors(data: np.ndarray, at: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``kmer, document, pos, lo, hi``: the anchors of all windows, and the starts of the windows of each."""
    for begin in range(0, len(data) - length + 1, _CHUNK):
        end = min(begin + _CHUNK, len(data) - length + 1)
        hashes = rolling(data[begin : end + length - 1], KMER)
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        place = (sliding_min(keys, length - KMER + 1) & _PLACE).astype(np.int64)
        inside = np.zeros(end - begin + 1, dtype=np.int64)
        long = np.flatnonzero(np.diff(at) >= length)
        np.add.at(inside, np.clip(at[long] - begin, 0, end - begin), 1)
        np.add.at(inside, np.clip(at[long + 1] - length + 1 - begin, 0, end - begin), -1)
        valid = np.concatenate(([False], np.cumsum(inside[:-1]) > 0, [False]))
        place = np.concatenate(([-1], place, [-1]))
        change = place[1:] != place[:-1]
        lo = np.flatnonzero(valid[1:] & (~valid[:-1] | change))
        hi = np.flatnonzero(valid[:-1] & (~valid[1:] | change)) - 1
        pos = place[lo + 1]
        document = np.searchsorted(at, begin + lo, side="right") - 1
        base = begin - at[document]
        yield hashes[pos], document, pos + base, lo + base, hi + base


@released
def _anchors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    seen: set = set()
    for batch in batches:
        for piece in pieces(batch):
            k1, k2 = (piece.column(i).to_numpy() for i in (1, 2))
            fresh = np.zeros(piece.num_rows, dtype=bool)
            for row, key in enumerate(zip(k1.tolist(), k2.tolist())):
                fresh[row] = key not in seen
                seen.add(key)
            if len(seen) > 100_000:
                seen.clear()
            texts = piece.column(0).filter(pa.array(fresh))
            k1, k2 = k1[fresh], k2[fresh]
            data, at = content(texts)
            raw = memoryview(data)
            for kmer, document, pos, lo, hi in find_anchors(data, at, length):
                start = at[document] + lo
                context = np.array(
                    [xxhash.xxh3_64_intdigest(raw[a:b], back) for a, b, back in zip(
                        start.tolist(), (at[document] + hi + length).tolist(), (pos - lo).tolist())],
                    dtype=np.uint64,
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(kmer.view(np.int64)), pa.array(context.view(np.int64)),
                        pa.array(k1[document]), pa.array(k2[document]),
                        *(pa.array(x.astype(np.int32)) for x in (pos, lo, hi)),
                    ],
                    names=["kmer", "ctx", "k1", "k2", "pos", "lo", "hi"],
                )


@released
def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts; a text's copies in the same task give them once."""
    seen: set = set()
    for batch in batches:
        for piece in pieces(batch):
            columns = {n: piece.column(i) for i, n in enumerate(piece.schema.names)}
            kmers, contexts, large, left, parts = [], [], [], [], []
            for row in range(piece.num_rows):
                key = columns["k1"][row].as_py(), columns["k2"][row].as_py()
                if key in seen:
                    continue
                seen.add(key)
                text = columns["text"][row].as_py().encode()
                for w in columns["wanted"][row].as_py():
                    kmers.append(w["kmer"])
                    contexts.append(w["ctx"])
                    large.append(w["large"])
                    left.append(w["pos"] - w["lo"])
                    parts.append(text[w["lo"] : w["hi"] + length])
            yield pa.RecordBatch.from_arrays(
                [pa.array(kmers, pa.int64()), pa.array(contexts, pa.int64()), pa.array(large, pa.bool_()),
                 pa.array(left, pa.int32()), pa.array(parts, pa.binary())],
                names=["kmer", "ctx", "large", "left", "data"],
            )


@released
def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """A hash of each window of each context."""
    for batch in batches:
        for piece in pieces(batch, 1 << 20):
            data, at = content(piece.column(4))
            left = piece.column(3).to_numpy()
            count = np.diff(at) - length + 1
            row = np.repeat(np.arange(piece.num_rows), count)
            start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            raw = memoryview(data)
            hashes = np.array(
                [xxhash.xxh3_64_intdigest(raw[a : a + length]) for a in (at[row] + start).tolist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(pa.array(row)), piece.column(1).take(pa.array(row)),
                 pa.array((left[row] - start).astype(np.int32)), pa.array(hashes.view(np.int64))],
                names=["kmer", "ctx", "back", "window"],
            )


@released
def _sort_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in whole_groups(batches, 1):
        starts = group_starts(batch, 2)[:-1]  # a context that came from several tasks counts once
        batch = batch.take(pa.array(starts))
        group = np.repeat(np.arange(len(group_starts(batch, 1)) - 1), np.diff(group_starts(batch, 1)))
        data, at = content(batch.column(3))
        row, first, last = repeated_windows(group, batch.column(2).to_numpy(), data, at, length)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
             pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
            names=["kmer", "ctx", "first", "last"],
        )


def repeated_windows(
    group: np.ndarray, left: np.ndarray, data: np.ndarray, at: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, first, last``: runs of windows, by bytes left of the anchor, that two contexts of a group share."""
    right = np.diff(at) - left
    ahead = _padded(data, at[:-1] + left, np.minimum(right, length), length, 1)
    back = _padded(data, at[:-1] + left - 1, np.minimum(left, length), length, -1)
    right_order, right_common = _radix_sort(group, ahead)
    left_order, left_common = _radix_sort(group, back)
    n = len(group)
    repeated = np.zeros((n, length), dtype=bool)
    class_left, class_right = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for offset in range(min(length, int(left.max(initial=-1)) + 1)):
        valid = np.flatnonzero((left >= offset) & (right >= length - offset))
        if len(valid) < 2:
            continue
        class_left[left_order] = np.cumsum(left_common < offset)
        class_right[right_order] = np.cumsum(right_common < length - offset)
        key = class_left[valid] * (n + 1) + class_right[valid]
        order = np.argsort(key, kind="stable")
        same = runs(key[order])
        repeated[valid[order], offset] = np.repeat(np.diff(same) > 1, np.diff(same))
    edges = np.diff(np.pad(repeated, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    return row, first, np.nonzero(edges == -1)[1] - 1


def _padded(data: np.ndarray, start: np.ndarray, count: np.ndarray, length: int, step: int) -> np.ndarray:
    """A row of bytes per context, read from ``start`` in direction ``step``, filled up with zeros to digits."""
    width = -(-length // 8) * 8
    out = np.zeros((len(start), width), dtype=np.uint8)
    row = np.repeat(np.arange(len(start)), count)
    column = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    out[row, column] = data[start[row] + step * column]
    return out


def _radix_sort(group: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows inside their groups, and how many bytes each shares with the one before it.

    Pass d orders by the d-th eight bytes, most significant first, and only rows that are still tied; a
    row alone in its class is in place. The first row of a group shares -1.
    """
    digits = rows.view(">u8").astype(np.uint64)
    order = np.arange(len(group))
    label = group.astype(np.int64)  # equal for rows that are tied so far; grows along ``order``
    for digit in range(digits.shape[1]):
        begins = runs(label)
        tied = np.flatnonzero(np.repeat(np.diff(begins) > 1, np.diff(begins)))
        if not len(tied):
            break
        value = digits[order[tied], digit]
        moved = np.lexsort((value, label[tied]))
        order[tied], value = order[tied][moved], value[moved]
        split = np.zeros(len(label), dtype=np.int64)
        # ``label`` is sorted, so it is the same before and after the move.
        split[tied[1:]] = (label[tied[1:]] == label[tied[:-1]]) & (value[1:] != value[:-1])
        split[1:] |= label[1:] != label[:-1]
        label = np.cumsum(split)
    common = np.full(len(order), -1, dtype=np.int64)
    differ = rows[order[1:]] != rows[order[:-1]]
    common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    common[np.flatnonzero(np.diff(group[order])) + 1] = -1
    return order, common


@released
def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            sizes, removed, counts, kept = [], [], [], []
            for row in range(piece.num_rows):
                text = piece.column(1)[row].as_py().encode()
                spans = piece.column(3)[row].as_py() or []
                if piece.column(2)[row].as_py() and len(text) >= length:
                    spans = [{"start": 0, "end": len(text)}]
                stay, at, n = [], 0, 0
                for start, end in sorted((s["start"], s["end"]) for s in spans):
                    if start > at or n == 0:
                        stay.append(text[at:start])
                        n += 1
                    at = max(at, end)
                stay.append(text[at:])
                left = b"".join(stay)
                sizes.append(len(text))
                removed.append(len(text) - len(left))
                counts.append(n)
                kept.append(left)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), *(pa.array(x, pa.int64()) for x in (sizes, removed, counts)), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

