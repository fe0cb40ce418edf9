"""All settings of a run in one frozen object, so that it pickles into tasks unchanged."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from jobweave import fixed


@dataclass(frozen=True)
class Sampling:
    """What a text generation backend is asked for."""

    model: str = "Qwen/Qwen2.5-32B-Instruct"
    max_tokens: int = 8192
    temperature: float = 0.2
    top_p: float = 0.8
    repetition_penalty: float = 1.05
    context_tokens: int | None = 20000  # None: the model takes prompts of any length
    count_tokens: Callable[[Column], Column] | None = None  # of the model; words where none is given


@dataclass(frozen=True)
class ChatMarkers:
    """Text around each message and after the last one; every model brings its own."""

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_content: str = "<|im_end|>\n"
    generation: str = "<|im_start|>assistant\n"


@dataclass(frozen=True)
class Limits:
    """Bounds under which a table may be broadcast. Beyond them the exact shuffled way is taken."""

    broadcast_rows: int = 2_000_000
    broadcast_bytes: int = 256 * 1024 * 1024
    index_values: int = 16_000_000  # rows x dimensions of a broadcast vector matrix, or of a block
    salts: int = 32  # copies of the small side of a shuffled lookup


@dataclass(frozen=True)
class JobConfig:
    id_column: str = "id"
    title_column: str = "title"
    description_column: str = "description"
    score_threshold: float = 0.4
    truncate_labels: bool = True
    embedding_model: str = "Alibaba-NLP/gte-Qwen2-7B-instruct"
    dimensions: int = 256
    top_k: int = 5
    chunk_tokens: int = 512
    chunk_overlap_share: float = 0.1
    chunk_separators: tuple[str, ...] = fixed.CHUNK_SEPARATORS
    count_tokens: Callable[[str], int] | None = None  # of the embedding model; words where none is given
    shards: int = 3
    sampling: Sampling = field(default_factory=Sampling)
    chat: ChatMarkers = field(default_factory=ChatMarkers)
    limits: Limits = field(default_factory=Limits)

    @property
    def chunk_overlap(self) -> int:
        return int(self.chunk_tokens * self.chunk_overlap_share)
