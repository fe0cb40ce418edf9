"""Cutting long notes into chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from jobweave import fixed
from jobweave.functions.expressions import let
from jobweave.functions.tokens import rows_of

TokenCounter = Callable[[str], int]


def count_words(text: str) -> int:
    """The offline token counter; a model's tokenizer takes its place in a real run."""
    return len(text.split())


def _parts(text: str, separator: str) -> list[str]:
    """A text cut before each separator, which stays at the head of the part it starts."""
    if not separator:
        return list(text)
    head, *rest = text.split(separator)
    return [part for part in (head, *(separator + r for r in rest)) if part]


def _packed(parts: list[str], size: int, overlap: int, count: TokenCounter) -> Iterator[str]:
    """Neighbouring parts put together as far as they fit; the next chunk repeats up to ``overlap`` tokens.

    A chunk loses the blanks at its head, which may change what sub-words its first part has.
    """
    window: list[tuple[str, int]] = []
    first = used = 0  # tokens of the first part without its blanks, and of all others
    for part in parts:
        tokens = count(part)
        if window and first + used + tokens > size:
            yield "".join(p for p, _ in window)
            while window and (first + used > overlap or first + used + tokens > size):
                window.pop(0)
                first = count(window[0][0].lstrip()) if window else 0
                used -= window[0][1] if window else 0
        if window:
            used += tokens
        else:
            first, used = count(part.lstrip()), 0
        window.append((part, tokens))
    if window:
        yield "".join(p for p, _ in window)


def _chunks(
    text: str, size: int, overlap: int, separators: Sequence[str], count: TokenCounter
) -> Iterator[str]:
    """Chunks of one level: its small parts are packed with each other only; a large part is a level of its own."""
    level = next((i for i, s in enumerate(separators) if s in text), None)
    if level is None:
        yield text
        return
    finer = separators[level + 1 :]
    small: list[str] = []
    for part in _parts(text, separators[level]):
        if count(part) < size:
            small.append(part)
            continue
        yield from _packed(small, size, overlap, count)
        small = []
        yield from _chunks(part, size, overlap, finer, count) if finer else [part]
    yield from _packed(small, size, overlap, count)


def split_text(
    text: str,
    size: int,
    overlap: int,
    separators: Sequence[str] = fixed.CHUNK_SEPARATORS,
    count: TokenCounter = count_words,
) -> list[str]:
    """Chunks of at most ``size`` tokens, if a separator allows; neighbours share up to ``overlap`` tokens.

    The coarsest separator that the text has makes the first cut, and parts too large are cut again by
    the finer ones. Parts of different levels are not put together.
    """
    chunks = (chunk.strip() for chunk in _chunks(text, size, overlap, separators, count))
    return [chunk for chunk in chunks if chunk]


def chunk_recursive(
    df: DataFrame,
    text: str,
    size: int,
    overlap: int,
    separators: Sequence[str] = fixed.CHUNK_SEPARATORS,
    count: TokenCounter = count_words,
) -> DataFrame:
    """One row per chunk with ``chunk_no`` from 0; all other columns ride along on the JVM side.

    A worker holds the texts of one Arrow batch as they came, and the chunks of some of its rows only.
    """

    def split(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in rows_of(batches):
            cut = [None if t is None else split_text(t, size, overlap, separators, count) for t in texts]
            yield pa.array(cut, pa.list_(pa.string()))

    chunks = F.arrow_udf(split, "array<string>")(F.col(text))
    return df.select("*", F.posexplode(chunks).alias("chunk_no", "chunk"))


def word_windows(text: Column, size: int, overlap: int) -> Column:
    """Overlapping windows of ``size`` words as an array, without Python."""
    step = size - overlap
    tokens = F.filter(F.split(text, fixed.SPACE_RUN), lambda t: t != "")

    def windows(t: Column) -> Column:
        last = F.greatest(F.ceil((F.size(t) - F.lit(size)) / F.lit(step)), F.lit(0)).cast("int")
        cut = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.array_join(F.slice(t, i * step + 1, F.lit(size)), " "),
        )
        return F.when(F.size(t) > 0, cut)

    return let(tokens, windows)


def chunk_words(df: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    return df.select(
        "*", F.posexplode(word_windows(F.col(text), size, overlap)).alias("chunk_no", "chunk")
    )
