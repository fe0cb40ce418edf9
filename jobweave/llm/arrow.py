"""Arrow batches inside tasks: pieces of bounded size, raw string buffers, streamed groups."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

#: Bytes of text that a task holds at once, besides a single longer text.
PIECE_BYTES = 4 * 1024 * 1024


def released(work: Callable) -> Callable:
    """``work`` on batches, which gives the memory that it held back to the machine when the task ends.

    Workers are kept for later tasks, and an idle one would go on holding it beside those of the next stage.
    """

    @wraps(work)
    def run(*args, **named):
        try:
            yield from work(*args, **named)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
            if trim is not None:
                trim(0)

    return run


def pieces(batch: pa.RecordBatch, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of at most ``limit`` bytes each, or of one row."""
    if batch.num_rows and batch.nbytes <= limit:
        yield batch
        return
    sizes = np.full(batch.num_rows, 8, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            sizes += np.diff(offsets(column))
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if batch.num_rows > start:
        yield batch.slice(start)


def offsets(column: pa.Array) -> np.ndarray:
    """Where each value of a string or binary column starts in its buffer, and where the last ends."""
    if column.buffers()[1] is None:
        return np.zeros(len(column) + 1, dtype=np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    raw = np.frombuffer(column.buffers()[1], dtype=kind)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def content(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values of a column in a row, and the offsets of the values in them."""
    at = offsets(column)
    data = column.buffers()[2] if len(column.buffers()) > 2 else None
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def runs(keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal neighbours, and the length of ``keys`` at the end."""
    if not len(keys):
        return np.zeros(1, dtype=np.int64)
    return np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Batches regrouped so that no run of equal integers in the first ``keys`` columns is cut.

    The rows must be sorted by these columns. Holds one batch and one group at a time.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for piece in pieces(batch):
            starts = group_starts(piece, keys)
            last = int(starts[-2])
            if held and any(
                not held[-1].column(k)[-1].equals(piece.column(k)[0]) for k in range(keys)
            ):
                yield _joined(held)
                held = []
            if last > 0:
                yield _joined([*held, piece.slice(0, last)])
                held = []
            held.append(piece.slice(last))
    if held:
        yield _joined(held)


def group_starts(batch: pa.RecordBatch, keys: int) -> np.ndarray:
    """Start of each group of equal keys, and the number of rows at the end."""
    changes = np.zeros(max(0, batch.num_rows - 1), dtype=bool)
    for k in range(keys):
        values = batch.column(k).to_numpy(zero_copy_only=False)
        changes |= values[1:] != values[:-1]
    return np.concatenate(([0], np.flatnonzero(changes) + 1, [batch.num_rows]))


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.Table.from_batches(held).combine_chunks().to_batches()[0]
