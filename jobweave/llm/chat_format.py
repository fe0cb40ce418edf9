"""Chat formatting by columnar byte assembly.

A task gets the turns of whole conversations in order. It computes the length of every
segment, the running offsets and the place of every byte in numpy, and copies headers and contents
into one preallocated buffer, which then is the data of an Arrow string column.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from jobweave.llm.arrow import content, pieces

FORMATTED = "conv_id long, part int, formatted string, loss array<struct<start: long, length: long>>"
DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)

#: ``<`` with any number of backslashes and ``|``: the start of a control string, escaped or not.
_OPENING = re.compile(rb"<\\*\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE_ESCAPE = re.compile(r"\\(.)")


@dataclass(frozen=True)
class Template:
    """Marks around a turn. Each must start with ``<|``: that is what is escaped inside texts."""

    start: str = "<|im_start|>"
    end: str = "<|im_end|>\n"
    learned_role: str = "assistant"
    part_bytes: int = 16 * 1024 * 1024


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation: ``conv_id, part, formatted, loss``.

    A turn is written as start mark, role, newline, text, end mark. ``loss`` holds the spans (in code points of
    the part) of the texts of the learned role. Inside roles and texts one backslash is put between ``<``
    and ``|``, also where backslashes stand there already, so no text can hold a mark and
    ``unescape`` restores it; in roles a newline and a backslash become ``\\n`` and ``\\\\``.

    Turns are ordered by turn, role, text, nulls first; ties and repeated rows all stay. Null texts
    and roles are empty, turns without a conversation form the conversation null. An empty table gives no row;
    further columns are ignored. A conversation longer than ``part_bytes`` comes in several parts, cut
    between turns, so the memory of a task is bounded by the longest text.
    """
    ordered = (
        turns.select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        )
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .select("conv_id", "role", "text")
    )
    return ordered.mapInArrow(partial(_format, template=template), FORMATTED)


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests of what can be read from formatted conversations; parts must be in order, as written."""
    return formatted.mapInArrow(partial(_read, template=template), DIGEST)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _format(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[pa.RecordBatch]:
    """Whole conversations. The last one of a batch may go on in the next, so it is held back."""
    held: list[pa.RecordBatch] = []
    part, open_id = 0, None
    for batch in batches:
        for piece in pieces(batch):
            starts = _starts(piece.column(0))
            last = int(starts[-2])
            if open_id is not None and not piece.column(0)[0].equals(open_id):
                if held:
                    yield _assemble(held, part, template)
                held, part = [], 0
            if last > 0:
                yield _assemble([*held, piece.slice(0, last)], part, template)
                held, part = [], 0
            held.append(piece.slice(last))
            open_id = piece.column(0)[last]
            if sum(x.nbytes for x in held) > template.part_bytes:
                yield _assemble(held, part, template)
                held, part = [], part + 1
    if held:
        yield _assemble(held, part, template)


def _starts(ids: pa.Array) -> np.ndarray:
    """Start of each conversation, and the number of rows at the end."""
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    nulls = ids.is_null().to_numpy(zero_copy_only=False)
    changes = (values[1:] != values[:-1]) | (nulls[1:] != nulls[:-1])
    return np.concatenate(([0], np.flatnonzero(changes) + 1, [len(values)]))


def _assemble(held: list[pa.RecordBatch], part: int, template: Template) -> pa.RecordBatch:
    """One formatted row per conversation in ``held``; the first one is its part number ``part``."""
    rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    roles = rows.column(1)
    learned = np.array(
        [r == template.learned_role for r in roles.to_pylist()], dtype=bool
    )
    if any("\n" in r or "\\" in r for r in roles.unique().to_pylist()):
        roles = pa.array([escape_role(r) for r in roles.to_pylist()], pa.string())
    start = np.frombuffer(template.start.encode(), np.uint8)
    end = np.frombuffer(template.end.encode(), np.uint8)
    role, role_at, role_added = _escapes(roles)
    text, text_at, text_added = _escapes(rows.column(2))
    role_size = np.diff(role_at) + np.diff(role_added[role_at])
    text_size = np.diff(text_at) + np.diff(text_added[text_at])
    turn_at = np.concatenate(([0], np.cumsum(len(start) + role_size + 1 + text_size + len(end))))
    role_to = turn_at[:-1] + len(start)
    text_to = role_to + role_size + 1
    out = np.empty(turn_at[-1], dtype=np.uint8)
    out[turn_at[:-1, None] + np.arange(len(start))] = start
    _scatter(out, role, role_at, role_added, role_to)
    out[text_to - 1] = ord("\n")
    _scatter(out, text, text_at, text_added, text_to)
    out[(text_to + text_size)[:, None] + np.arange(len(end))] = end

    begins = _starts(rows.column(0))
    points = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))  # code points before each byte
    which = np.flatnonzero(learned)
    conversation = np.searchsorted(begins, which, side="right") - 1
    from_point = points[text_to[which]]
    spans = pa.StructArray.from_arrays(
        [
            pa.array(from_point - points[turn_at[begins[conversation]]]),
            pa.array(points[(text_to + text_size)[which]] - from_point),
        ],
        names=["start", "length"],
    )
    span_at = np.searchsorted(which, begins).astype(np.int32)
    numbers = np.zeros(len(begins) - 1, dtype=np.int32)
    numbers[0] = part
    return pa.RecordBatch.from_arrays(
        [
            rows.column(0).take(pa.array(begins[:-1])),
            pa.array(numbers),
            pa.StringArray.from_buffers(
                len(begins) - 1, pa.py_buffer(turn_at[begins].astype(np.int32)), pa.py_buffer(out)
            ),
            pa.ListArray.from_arrays(pa.array(span_at), spans),
        ],
        names=["conv_id", "part", "formatted", "loss"],
    )


def _escapes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes and offsets of a column, and how many backslashes go in before each byte."""
    data, at = content(column)
    raw = data.tobytes()
    added = np.zeros(len(data) + 1, dtype=np.int64)
    if b"<" in raw:
        found = np.array([m.span() for m in _OPENING.finditer(raw)], dtype=np.int64).reshape(-1, 2)
        bars = found[:, 1] - 1
        inside = np.searchsorted(at, found[:, 0], side="right") == np.searchsorted(at, bars, side="right")
        added[bars[inside] + 1] = 1
        added = np.cumsum(added)
    return data, at, added


def _scatter(out, data, at, added, to) -> None:
    """Copies value i of ``data`` to ``out[to[i]:]``, with a backslash wherever ``added`` grows."""
    place = np.arange(len(data)) + np.repeat(to - at[:-1] - added[at[:-1]], np.diff(at))
    place += added[1:]
    out[place] = data
    out[place[np.diff(added) > 0] - 1] = ord("\\")


class _Reading:
    """Running digests of one conversation, over any number of parts."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turn_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[dict], template: Template) -> None:
        self.chars += len(formatted)
        for turn in formatted.split(template.end)[:-1]:
            role, _, text = turn[len(template.start) :].partition("\n")
            self.turns += 1
            self.turn_hash.update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
        for span in loss:
            text = unescape(formatted[span["start"] : span["start"] + span["length"]])
            self.loss_chars += len(text)
            self.loss_hash.update(text.encode())

    def row(self) -> dict:
        return {
            "conv_id": self.conv_id, "n_turns": self.turns, "turns_sha256": self.turn_hash.hexdigest(),
            "loss_chars": self.loss_chars, "loss_sha256": self.loss_hash.hexdigest(),
            "formatted_chars": self.chars,
        }


def _read(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ])
    reading = None
    for batch in batches:
        done = []
        for row in range(batch.num_rows):
            conv_id, part, formatted, loss = (batch.column(i)[row].as_py() for i in range(4))
            if part == 0:
                if reading:
                    done.append(reading.row())
                reading = _Reading(conv_id)
            reading.add(formatted, loss, template)
        yield pa.RecordBatch.from_pylist(done, schema=schema)
    if reading:
        yield pa.RecordBatch.from_pylist([reading.row()], schema=schema)
