"""How filters of a corpus interact: what each step of every order removes.

Which filters a document fails is a mask of five bits, and a mask decides the outcome of all 600 steps of the 120
orders. So every mask stands for one wide integer, in which each count of each step has a field of its own. The integers of a
part's documents are summed, and the fields of the sum are the counts. A field is as wide as the largest count that can
come up, so no sum reaches its neighbour.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobweave.llm.arrow import content, pieces, released
from jobweave.storage import materialise

FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SYMBOLS = b"#$%&*|"
REPEATED = 1 << FILTERS.index("E")


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and ``COUNTS``, for every ``lang`` (null: the empty string) and step of every order.

    A document fails A with under 200 words, B if under half of its words are different, C if over 3 % of its code points
    are capitals A-Z, D if it holds one of ``#$%&*|``, E if a document with a smaller ``doc_id`` has the same text. A null
    text is the empty one, which fails A only. Rows that repeat a ``doc_id`` are documents of their own and not earlier
    than each other; a null id is neither earlier nor later than any. A document is good (toxic) if any row of ``labels`` with its id
    has quality (toxic) 1. Texts are told apart by 128 bits. No document: no row. Other columns do not matter.
    """
    return unpack(outcomes(judged(documents, labels)))


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic, n``: how many documents of each kind a part has."""
    rows = documents.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string"))
    tested = materialise(rows.mapInArrow(_test, "doc_id long, part string, same binary, mask int"), "audit-masks")
    firsts = tested.groupBy("same").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    # Read from a table, so that adaptive execution can split the documents of a text that many share.
    firsts = materialise(firsts.where("first < last").select("same", "first"), "audit-copies")
    later = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    marked = tested.join(firsts, "same", "left").select(
        "doc_id", "part", (F.col("mask") + F.when(later, REPEATED).otherwise(0)).alias("mask"))
    known = labels.groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    known = materialise(known.where("doc_id is not null and good + toxic > 0"), "audit-labels")
    counted = marked.join(known, "doc_id", "left").groupBy(
        "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    return materialise(counted.agg(F.count(F.lit(1)).alias("n")), "audit-kinds")


def outcomes(kinds: DataFrame) -> DataFrame:
    """``part, width, packed``: the sum of the wide integers of each part's documents, and the bytes of a field.

    A part has at most 128 kinds of documents, so its sum is small work whatever its size.
    """
    most = kinds.agg(F.sum("n")).first()[0] or 0
    width = (len(ORDERS) * most).bit_length() // 8 + 1  # a document adds at most one for each order to a field
    return kinds.withColumn("width", F.lit(width)).groupBy("part").applyInArrow(
        _sum, "part string, width int, packed binary")


def unpack(summed: DataFrame) -> DataFrame:
    """The fields of each part's sum as rows."""
    counts = ", ".join(f"{name} long" for name in COUNTS)
    return summed.mapInArrow(_unpack, f"part string, filter_order string, step int, {counts}")


def packed(mask: int, good: int, toxic: int, width: int) -> int:
    """The integer of one document: its counts at step 1 of the first order, at step 2, and so on."""
    fields = []
    first_at = {name: 0 for name in FILTERS}
    for order in ORDERS:
        first = next((name for name in order if mask >> FILTERS.index(name) & 1), None)
        if first:
            first_at[first] += 1
    for order in ORDERS:
        gone = False
        for name in order:
            fails = mask >> FILTERS.index(name) & 1
            removed = fails and not gone
            redundant = fails and gone
            gone = gone or bool(fails)
            alone = mask == 1 << FILTERS.index(name)
            fields += [not gone, removed, redundant, alone, removed and good, removed and toxic, first_at[name]]
    return int.from_bytes(b"".join(int(f).to_bytes(width, "little") for f in fields), "little")


def _sum(table: pa.Table) -> pa.Table:
    total, width = 0, table.column("width")[0].as_py()
    for kind in table.select(["mask", "good", "toxic", "n"]).to_pylist():
        total += kind["n"] * packed(kind["mask"], kind["good"], kind["toxic"], width)
    size = width * len(ORDERS) * len(FILTERS) * len(COUNTS)
    part = table.column("part")[0].as_py()
    return pa.table({
        "part": pa.array([part], pa.string()), "width": pa.array([width], pa.int32()),
        "packed": pa.array([total.to_bytes(size, "little")], pa.binary())})


@released
def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = len(ORDERS) * len(FILTERS)
    for batch in batches:
        for row in batch.to_pylist():
            width = row["width"]
            raw = np.frombuffer(row["packed"], np.uint8).reshape(-1, width)
            wide = np.zeros((len(raw), 8), np.uint8)
            wide[:, :width] = raw
            counts = wide.view("<u8").astype(np.int64).reshape(steps, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["part"]] * steps), pa.array([o for o in ORDERS for _ in FILTERS]),
                 pa.array(list(range(1, len(FILTERS) + 1)) * len(ORDERS), pa.int32()),
                 *(pa.array(counts[:, k]) for k in range(len(COUNTS)))],
                names=["part", "filter_order", "step", *COUNTS])


@released
def _test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mask of A to D of each text, and a digest of the text."""
    for batch in batches:
        for piece in pieces(batch):
            column = piece.column(2).fill_null("")
            data, at = content(column)
            capitals, symbols, points = (_count(found, at) for found in (
                (data >= ord("A")) & (data <= ord("Z")), np.isin(data, list(SYMBOLS)), data & 0xC0 != 0x80))
            words, different, same = [], [], []
            for text in column.cast(pa.binary()).to_pylist():
                some = text.split()  # bytes split at the blanks of ASCII
                words.append(len(some))
                different.append(len(set(some)))
                same.append(hashlib.md5(text, usedforsecurity=False).digest())
            words, different = np.array(words, np.int64), np.array(different, np.int64)
            fails = [words < 200, 100 * different < 50 * words, 100 * capitals > 3 * points, symbols > 0]
            mask = sum(fail.astype(np.int32) << k for k, fail in enumerate(fails))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array(same, pa.binary()), pa.array(mask, pa.int32())],
                names=["doc_id", "part", "same", "mask"])


def _count(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    upto = np.concatenate(([0], np.cumsum(found, dtype=np.int64)))
    return upto[at[1:]] - upto[at[:-1]]
