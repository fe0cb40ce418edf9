"""Near-duplicate lines by a segment-partition edit join.

A line is cut into ``most + 1`` segments. A line at most ``most`` edits away keeps one of them whole,
at nearly the same place, so it is enough to look up the substrings that can match, by length, segment
and place. What is found is verified by banded bit-parallel edit distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from jobweave.joins import fits_broadcast
from jobweave.llm import edit_distance
from jobweave.llm.arrow import group_starts, pieces, released, whole_groups
from jobweave.llm.common import WORD, replace_columns
from jobweave.storage import materialise

#: Rows under one key whose pairs a task lists. More are compared in blocks, where they are.
LISTED = 64
BLOCK = 512
#: Pairs of blocks that a task compares, about.
CELLS_PER_TASK = 8
_SEED = 42


def drop_repeated_lines(documents: DataFrame, most: int = 2, least_chars: int = 20) -> DataFrame:
    """Each row with ``text`` cut, and ``n_lines``, ``n_removed``.

    Lines end at newlines. A line goes if the same line, or one at most ``most`` edits away, comes earlier: in
    a document with a smaller ``doc_id`` or before it in its own. So the first of similar lines stays, and a line stays
    too if only removed ones are close to it but none that is earlier. Of lines under
    ``least_chars`` code points only exact copies go: there a few edits make another line. Lines without a word (blank ones)
    are not judged and stay.

    Null ``doc_id`` sorts first; rows that repeat both id and text are one document and keep the same lines; rows that
    share only the id are ordered by a hash of the text. A null text stays null, with no line. A
    document that loses all its lines has the empty text. An empty table gives an empty result; columns named like the
    results are replaced.
    """
    if least_chars <= 2 * most:
        raise ValueError("least_chars must exceed two times the edits")
    rows = replace_columns(documents, "n_lines", "n_removed", "_k", "_removed", "_lines").withColumns({
        "_k": F.xxhash64("doc_id", "text", F.lit(1)),
        "_lines": F.split("text", "\n"),
    })
    places = materialise(
        rows.select("doc_id", "_k", F.posexplode("_lines").alias("no", "line"))
        .where(F.col("line").rlike(WORD))
        .select(line_id(F.col("line")).alias("line"), F.struct("doc_id", "_k", "no").alias("at")),
        "line-places",
    )
    firsts = materialise(
        places.groupBy("line").agg(F.min("at").alias("first"), (F.min("at") != F.max("at")).alias("again")), "line-firsts"
    )
    late = _late_lines(documents.select(F.col("text").cast("string")), firsts, most, least_chars)
    judged = firsts.join(late.withColumn("late", F.lit(True)), "line", "left").where(
        F.col("again") | F.col("late"))
    gone = places.join(judged, "line").where(F.col("late").isNotNull() | (F.col("at") != F.col("first")))
    removed = gone.groupBy(F.col("at.doc_id").alias("_d"), F.col("at._k").alias("_k")).agg(
        F.collect_set("at.no").alias("_removed")).drop("_d")
    removed = materialise(removed, "lines-removed")
    cut = rows.join(F.broadcast(removed) if fits_broadcast(removed) else removed, "_k", "left")
    stay = F.transform(
        F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_removed")),
        lambda i: F.get(F.col("_lines"), i),
    )
    return cut.withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")),
        "n_removed": F.coalesce(F.array_size("_removed"), F.lit(0)),
        "text": F.when(F.col("_removed").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n")),
    }).select(*(c for c in rows.columns if not c.startswith("_")), "n_lines", "n_removed")


def line_id(line: Column) -> Column:
    """63 bits of a line's hash, shifted up by one: the lowest bit tells its role."""
    return F.xxhash64(line).bitwiseAND(F.lit(-2))


def _late_lines(texts: DataFrame, firsts: DataFrame, most: int, least_chars: int) -> DataFrame:
    """``line``: lines that have an earlier one within ``most`` edits."""
    keys = texts.mapInArrow(partial(_keys, most=most, least=least_chars), "key long, line long")
    met = materialise(
        keys.repartition("key").sortWithinPartitions("key").mapInArrow(partial(_meet, listed=LISTED), "a long, b long, key long"), "line-pairs"
    )
    pairs = materialise(met.where("key is null").select("a", "b").distinct(), "line-candidates")
    crowded = met.where("key is not null").select("key", "a")
    wanted = pairs.select(F.col("a").alias("line")).unionByName(pairs.select(F.col("b").alias("line"))).unionByName(
        crowded.select(F.col("a").bitwiseAND(F.lit(-2)).alias("line"))).distinct()
    wanted = materialise(wanted, "lines-wanted")
    lines = texts.select(F.explode(F.split("text", "\n")).alias("content")).where(
        F.char_length("content") >= least_chars).withColumn("line", line_id(F.col("content")))
    lines = lines.join(F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "line", "left_semi")
    lines = materialise(lines.groupBy("line").agg(F.first("content").alias("content")), "line-texts")
    known = lines.join(firsts.select("line", "first"), "line")
    a = known.select(F.col("line").alias("a"), F.col("content").alias("x"), F.col("first").alias("fx"))
    b = known.select(F.col("line").alias("b"), F.col("content").alias("y"), F.col("first").alias("fy"))
    sided = pairs.join(a, "a").join(b, "b").select(
        F.when(F.col("fx") > F.col("fy"), F.col("a")).otherwise(F.col("b")).alias("line"), "x", "y")
    late = sided.mapInArrow(partial(_verify, most=most), "line long")
    if not crowded.isEmpty():
        late = late.unionByName(_late_in_crowds(materialise(crowded, "line-crowds"), known, most))
    return materialise(late.distinct(), "lines-late")


def _late_in_crowds(crowded: DataFrame, known: DataFrame, most: int) -> DataFrame:
    """Late lines under keys with many rows: blocks of the looked-up meet blocks of the looking-up lines."""
    sizes = crowded.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cut = crowded.join(sizes, "key").select(
        "key", F.col("a").bitwiseAND(F.lit(-2)).alias("line"), F.col("a").bitwiseAND(F.lit(1)).alias("role"), "blocks")
    cut = cut.unionByName(cut.where("role = 1").withColumn("role", F.lit(0).cast("long")))  # these look up, too
    own = F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int")
    cells = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    by_role = F.when(F.col("role") == 1, F.struct(F.col("own").alias("i"), F.col("other").alias("j"))).otherwise(
        F.struct(F.col("other").alias("i"), F.col("own").alias("j")))
    placed = cells.select("key", by_role.alias("cell"), "line", "role").select(
        "key", F.col("cell.i").cast("long").alias("i"), F.col("cell.j").cast("long").alias("j"), "line", "role")
    full = placed.join(known, "line").select(
        "key", "i", "j", "line", "role", "content", F.coalesce("first.doc_id", F.lit(-(2**63))).alias("doc"),
        F.col("first._k").alias("k"), F.col("first.no").cast("long").alias("no"))
    # Cells of few bytes may be much work, so their number decides, not adaptive execution.
    cells = sizes.agg(F.sum(F.col("blocks").cast("long") * F.col("blocks"))).first()[0] or 1
    tasks = max(int(full.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(cells / CELLS_PER_TASK))
    ordered = full.repartition(tasks, "key", "i", "j").sortWithinPartitions("key", "i", "j")
    return ordered.mapInArrow(partial(_compare_blocks, most=most), "line long")


@lru_cache(maxsize=4096)
def probes(size: int, most: int) -> tuple[tuple[int, int, int, int], ...]:
    """``start, end, seed, role`` of the substrings of a line of ``size``: role 1 is looked up, 0 looks up.

    Lines look up lines of their length or shorter. A segment can only have moved by the edits on its left and by
    those left for its right, which bounds its places. A line's own segments look up as well, so lines of
    one length need no second row for them.
    """
    found = [(*cut, size * (most + 1) + i, 1) for i, cut in enumerate(_segments(size, most))]
    for shorter in range(max(most + 1, size - most), size + 1):
        moved = size - shorter
        for i, (start, end) in enumerate(_segments(shorter, most)):
            low = max(0, start - i, start + moved - (most - i))
            high = min(size - (end - start), start + i, start + moved + (most - i))
            for place in range(low, high + 1):
                if moved or place != start:
                    found.append((place, place + end - start, shorter * (most + 1) + i, 0))
    return tuple(found)


def _segments(size: int, most: int) -> list[tuple[int, int]]:
    cuts = [size * i // (most + 1) for i in range(most + 2)]
    return list(zip(cuts, cuts[1:]))


@released
def _keys(batches: Iterator[pa.RecordBatch], most: int, least: int) -> Iterator[pa.RecordBatch]:
    """Keys of all segments and substrings; a line that the task has just seen gives them once."""
    seen: set = set()
    digest = xxhash.xxh3_64_intdigest
    for batch in batches:
        for piece in pieces(batch, 4 << 20):
            keys: list[int] = []
            lines: list[int] = []
            for text in piece.column(0).to_pylist():
                for line in text.split("\n") if text else ():
                    if len(line) < least:
                        continue
                    name = xxhash.xxh64_intdigest(line, _SEED) & ~1
                    if name in seen:
                        continue
                    seen.add(name)
                    some = probes(len(line), most)
                    keys += [digest(line[a:b], seed) for a, b, seed, _ in some]
                    lines += [name | role for _, _, _, role in some]
            if len(seen) > 500_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (keys, lines)], names=["key", "line"])


@released
def _meet(batches: Iterator[pa.RecordBatch], listed: int) -> Iterator[pa.RecordBatch]:
    """Pairs of lines under a key, at least one looked up; rows of crowded keys as they are, with the key."""
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
    crowd = None
    for batch in batches:
        keys, lines = (batch.column(i).to_numpy() for i in (0, 1))
        if not len(keys):
            continue
        keys, lines = np.concatenate((held[0], keys)), np.concatenate((held[1], lines))
        starts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))
        size = np.diff(starts)
        large = size > listed
        if crowd is not None and keys[0] == crowd:
            large[0] = True
        crowd = keys[-1] if large[-1] else None
        cut = len(keys) if large[-1] else int(starts[-2])
        held = keys[cut:], lines[cut:]
        yield _pairs(keys[:cut], lines[:cut], np.repeat(large, size)[:cut])
    yield _pairs(*held, np.zeros(len(held[0]), dtype=bool))


def _pairs(keys: np.ndarray, lines: np.ndarray, large: np.ndarray) -> pa.RecordBatch:
    """Lists the pairs of small groups: each row meets the rows after it in its group, step by step."""
    found_a, found_b = [], []
    small = np.flatnonzero(~large)
    k, v = keys[small], lines[small]
    step = 1
    at = np.arange(len(k) - 1)
    while len(at):
        at = at[at + step < len(k)]
        at = at[k[at] == k[at + step]]
        a, b = v[at], v[at + step]
        meet = ((a | b) & 1 == 1) & (a & ~1 != b & ~1)
        found_a.append(np.minimum(a & ~1, b & ~1)[meet])
        found_b.append(np.maximum(a & ~1, b & ~1)[meet])
        step += 1
    a = np.concatenate([*found_a, lines[large]]) if found_a else lines[large]
    b = np.concatenate([*found_b, lines[large]]) if found_b else lines[large]
    listed = len(a) - int(large.sum())
    key = pa.array(np.concatenate((np.zeros(listed, np.int64), keys[large])), mask=np.arange(len(a)) < listed)
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), key], names=["a", "b", "key"])


@released
def _verify(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch):
            near = edit_distance.within(piece.column(1).to_pylist(), piece.column(2).to_pylist(), most)
            yield pa.RecordBatch.from_arrays([piece.column(0).filter(pa.array(near))], names=["line"])


@released
def _compare_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """In each cell, the lines that have an earlier one of the other role within ``most`` edits."""
    for batch in whole_groups(batches, 3):
        starts = group_starts(batch, 3)
        late: set[int] = set()
        for start, end in zip(starts, starts[1:]):
            cell = batch.slice(start, end - start).to_pydict()
            rows = sorted(
                zip(cell["doc"], cell["k"], cell["no"], cell["line"], cell["role"], cell["content"]), key=lambda r: r[:4])
            late.update(_late_in_cell(rows, most))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(late), pa.int64())], names=["line"])


def _late_in_cell(rows: list[tuple], most: int) -> Iterator[int]:
    """Counts of characters rule most pairs out: an edit changes two of them by one at most."""
    sizes = np.array([len(r[5]) for r in rows])
    roles = np.array([r[4] for r in rows])
    names = np.array([r[3] for r in rows])
    counts = np.stack([
        np.bincount(np.frombuffer(r[5].encode("utf-32-le"), np.uint32) & 63, minlength=64) for r in rows]).astype(np.int32)
    done: set[int] = set()
    for i, row in enumerate(rows):
        if row[3] in done:
            continue
        earlier = np.flatnonzero(
            (roles[:i] != roles[i]) & (np.abs(sizes[:i] - sizes[i]) <= most) & (names[:i] != names[i]))
        earlier = earlier[np.abs(counts[earlier] - counts[i]).sum(axis=1) <= 2 * most]
        if len(earlier) and edit_distance.within([rows[j][5] for j in earlier], [row[5]] * len(earlier), most).any():
            done.add(row[3])
            yield row[3]
