"""Counting a text's tokens as the model's own tokenizer does."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, functions as F

#: Rows of an Arrow batch whose values are Python objects at the same time.
ROWS = 256


def rows_of(batches: Iterator[pa.Array]) -> Iterator[list]:
    """The values of Arrow arrays, ``ROWS`` at a time, so that neither they nor what comes of them pile up by the batch."""
    for batch in batches:
        for start in range(0, len(batch), ROWS):
            yield batch.slice(start, ROWS).to_pylist()


@lru_cache(maxsize=4)
def _encoding(ranks_file: str, pattern: str):
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("tokens", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@dataclass(frozen=True)
class SubwordCounter:
    """The number of byte-pair tokens of a text, by a file of ranks and the pattern of its words.

    Give it as ``count_tokens`` of a ``JobConfig`` and, through ``token_column``, of its ``Sampling``. It pickles as the two texts, and
    a worker reads the file once; so the file must be where the workers can open it. Nothing is learned here: a
    count is of use only if it is that of the model that gets the text.
    """

    ranks_file: str
    pattern: str

    def __call__(self, text: str) -> int:
        return len(_encoding(self.ranks_file, self.pattern).encode_ordinary(text))

    def token_column(self, text: Column) -> Column:
        """The count of a text column; null for null."""

        def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in rows_of(batches):
                yield pa.array([None if t is None else self(t) for t in texts], pa.int64())

        return F.arrow_udf(counted, "long")(text)
