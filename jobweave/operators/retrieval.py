"""Embedding, the label index, and exact nearest-label search."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from jobweave.config import JobConfig, Limits
from jobweave.functions.sections import extract_info
from jobweave.functions.text import word_text
from jobweave.operators.chunking import chunk_recursive, count_words
from jobweave.operators.models import Backend, model_column
from jobweave.operators.similarity import best_columns, unit_rows
from jobweave.operators.vector_search import sides, top_k_blocks
from jobweave.storage import materialise

_BATCH_VALUES = 4_000_000  # similarities held at a time in one task
_WORDS = 100_000  # words whose buckets a worker remembers from the batches before
_BATCH_ROWS = 512  # queries whose vectors and hits are held at a time in one task


# --- embedding -----------------------------------------------------------------


def hash_vectors(dimensions: int) -> Callable[[pd.Series], pd.Series]:
    """What ``hash_embed`` does to a batch of texts whose words stand between blanks."""
    buckets: dict[str, int] = {}

    def embed(texts: pd.Series) -> pd.Series:
        if len(buckets) > _WORDS:
            buckets.clear()

        def vector(text: str) -> np.ndarray:
            tokens = text.split()
            for token in tokens:
                if token not in buckets:
                    buckets[token] = int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % dimensions
            counts = np.bincount([buckets[t] for t in tokens], minlength=dimensions).astype(float)
            return counts / (np.sqrt(counts @ counts) or 1.0)

        return texts.map(vector, na_action="ignore")

    return embed


def hash_embed(text: Column, dimensions: int) -> Column:
    """The offline embedder: word counts in hash buckets, scaled to unit length.

    The bucket of a word is the first 32 bits of its md5 modulo ``dimensions``. It stands in for
    a model. Words are found on the JVM side; a text without words gives the zero vector.
    """
    return F.pandas_udf(hash_vectors(dimensions), "array<double>")(word_text(text))


def embed_column(text: Column, config: JobConfig, backend: Backend | None = None) -> Column:
    if backend is None:
        return hash_embed(text, config.dimensions)
    return model_column(backend, text, "array<double>")


# --- index ---------------------------------------------------------------------


def label_chunks(labels: DataFrame, config: JobConfig = JobConfig()) -> DataFrame:
    """Label notes cut to the useful sections, then chunked.

    ``info`` is what a prompt shows of a chunk, worked out once here rather than for each hit;
    ``doc`` identifies content and metadata together, ``place`` orders the chunks.
    """
    notes = F.col("description")
    if config.truncate_labels:
        notes = extract_info(notes, ["description", "tasks", "examples"])
    # A label without notes is found by its own text.
    chunks = chunk_recursive(
        labels.withColumn("description", F.coalesce(notes, F.col("label"))).where(F.col("description").isNotNull()),
        "description", config.chunk_tokens, config.chunk_overlap,
        config.chunk_separators, config.count_tokens or count_words,
    ).drop("description")
    metadata = [c for c in chunks.columns if c not in ("chunk_no", "pos")]
    return chunks.withColumns(
        {
            "info": extract_info(F.col("chunk"), ["description", "examples"]),
            "doc": F.md5(F.to_json(F.struct(*metadata))),
        }
    ).withColumn(
        "place", F.concat_ws("/", "code", F.lpad(F.col("chunk_no").cast("string"), 6, "0"), "doc")
    )


def build_label_index(
    labels: DataFrame, config: JobConfig = JobConfig(), embedder: Backend | None = None
) -> DataFrame:
    """Chunks of the labels with their vectors; write it once and share it between jobs."""
    return label_chunks(labels, config).withColumn(
        "embedding", embed_column(F.col("chunk"), config, embedder)
    )


def write_label_index(index: DataFrame, path: str) -> None:
    """Replace the stored index as a whole, so that a second build never adds to the first."""
    index.write.mode("overwrite").parquet(path)


@dataclass(frozen=True)
class IndexChange:
    """What an update did: chunks in the index, of these embedded anew, and chunks that went."""

    chunks: int
    embedded: int
    removed: int


def update_label_index(
    labels: DataFrame, path: str, config: JobConfig = JobConfig(), embedder: Backend | None = None, model: str | None = None
) -> IndexChange:
    """Makes the stored index that of ``labels``, and embeds only chunks whose text it does not hold yet.

    A vector is known by a hash of its chunk's text, the embedder's name (``model``, by default the configured one) and the
    dimensions. Chunks with new metadata keep their vector; vanished ones go. The new index is written aside and
    then takes the place of the old one. The counts are observed while it is written.
    """
    spark = labels.sparkSession
    name = model or (config.embedding_model if embedder else "hash")
    text_key = F.md5(F.concat_ws("\x01", F.lit(name), F.lit(str(config.dimensions)), "chunk"))
    chunks = materialise(label_chunks(labels, config).withColumn("text_key", text_key), "chunks")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    stored = spark.read.parquet(path) if files.exists(place) else None
    if stored is None or "text_key" not in stored.columns:
        known = spark.createDataFrame([], "text_key string, embedding array<double>")
        before = 0 if stored is None else stored.count()
        kept = 0
    else:
        known = materialise(stored.select("text_key", "embedding").dropDuplicates(["text_key"]), "known-vectors")
        before = stored.count()
        kept = stored.join(chunks.select("place").distinct(), "place", "left_semi").count()
    fresh = chunks.select("text_key", "chunk").dropDuplicates(["text_key"]).join(known, "text_key", "left_anti")
    fresh = materialise(fresh.select("text_key", embed_column(F.col("chunk"), config, embedder).alias("embedding")), "new-vectors")
    new = f"{path.rstrip('/')}-new-{uuid.uuid4().hex}"
    seen = Observation()
    chunks.join(known.unionByName(fresh), "text_key").observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(new)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}-old-{uuid.uuid4().hex}")
    if files.exists(place):
        files.rename(place, old)
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(new), place):
        raise OSError(f"cannot move {new} to {path}")
    files.delete(old, True)
    return IndexChange(seen.get["n"], fresh.count(), before - kept)


# --- search --------------------------------------------------------------------


def fits_task(corpus: DataFrame, vector: str, limits: Limits) -> bool:
    """Whether a corpus, payload included, may be broadcast, measured by one aggregation."""
    others = [F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) for c in corpus.columns if c != vector]
    values, payload = corpus.agg(
        F.coalesce(F.sum(F.size(vector)), F.lit(0)), F.coalesce(F.sum(sum(others, F.lit(0))), F.lit(0))
    ).first()
    return values <= limits.index_values and payload <= limits.broadcast_bytes


def top_k(
    queries: DataFrame,
    query_vectors: dict[str, Column],
    corpus: DataFrame,
    corpus_vector: str,
    key: str,
    payload: Sequence[str] = (),
    k: int = 5,
    metric: str = "cosine",
    limits: Limits = Limits(),
    hashed: dict[str, Column] | None = None,
    dimensions: int = 0,
) -> DataFrame:
    """Add, for each named query vector, the k nearest corpus rows as an ordered array.

    A corpus within the bounds by its measured size, as a label index is, is broadcast as a
    matrix; queries stay where they are and are multiplied batch by batch: no shuffle, and no
    pair leaves the task that scored it. A larger one never reaches the driver: blocks of queries meet blocks of the
    corpus on executors (``vector_search``). Ties go to the smaller key. Rows of either side
    without a vector have no hits and are not found. One worker searches all named vectors, some rows at a time. If
    these are vectors of ``hash_embed``, give their texts as ``hashed``: the worker then makes them for the rows at
    hand, and those of a whole batch are never held.
    """
    if metric not in ("cosine", "dot"):
        raise ValueError(f"unknown metric: {metric}")
    kept = list(dict.fromkeys([key, *payload]))
    rows = corpus.where(F.col(corpus_vector).isNotNull()).select(*kept, corpus_vector)
    hit_type = ArrayType(StructType(
        [StructField(n, corpus.schema[n].dataType) for n in kept] + [StructField("score", DoubleType())]
    ))
    if not fits_task(rows, corpus_vector, limits):
        both = sides(queries, query_vectors, rows, corpus_vector, key, kept, metric)
        return top_k_blocks(both, k, limits.index_values)
    embed = hash_vectors(dimensions) if hashed else None
    asked = {name: word_text(text) for name, text in hashed.items()} if hashed else query_vectors
    found = _search_matrix(rows, corpus_vector, kept, hit_type, k, metric, list(asked), embed)(*asked.values())
    return queries.withColumn("_found", found).withColumns({name: F.col("_found")[name] for name in asked}).drop("_found")


def _search_matrix(
    rows: DataFrame, vector: str, kept: list[str], hit_type: ArrayType, k: int, metric: str, names: list[str],
    embed: Callable[[pd.Series], pd.Series] | None,
):
    """A column function: the hits of named query vectors, or of texts to ``embed``, in a corpus that fits a task."""
    table = rows.orderBy(*kept).toArrow()
    flat = table[vector].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    matrix = flat.astype(float).reshape(table.num_rows, -1) if table.num_rows else np.empty((0, 0))
    if metric == "cosine" and len(matrix):
        matrix = unit_rows(matrix)
    shared = rows.sparkSession.sparkContext.broadcast((matrix, table.select(kept)))

    def search(vectors: pd.Series) -> list:
        corpus_matrix, payload = shared.value
        present = np.flatnonzero(vectors.notna().to_numpy())
        found: list = [None] * len(vectors)
        step = max(1, _BATCH_VALUES // max(1, len(corpus_matrix)))
        for start in range(0, len(present), step):
            part = present[start : start + step]
            batch = np.stack(vectors.iloc[part].to_list()).astype(float)
            if metric == "cosine":
                batch = unit_rows(batch)
            scores = batch @ corpus_matrix.T if len(corpus_matrix) else np.empty((len(part), 0))
            rounded, picks = best_columns(scores, k)
            chosen = payload.take(np.concatenate([*picks, np.empty(0, int)]).astype(int)).to_pylist()
            at = 0
            for place, row, pick in zip(part, rounded, picks):
                hits = chosen[at : at + len(pick)]
                at += len(pick)
                found[place] = [{**hit, "score": float(row[c])} for hit, c in zip(hits, pick)]
        return found

    def search_all(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            columns = (batch,) if isinstance(batch, pd.Series) else batch  # a single column comes by itself
            for start in range(0, len(columns[0]), _BATCH_ROWS):
                part = [c.iloc[start : start + _BATCH_ROWS] for c in columns]
                hits = [search(embed(p) if embed else p) for p in part]
                yield pd.DataFrame({n: pd.Series(h, dtype=object) for n, h in zip(names, hits)})

    return F.pandas_udf(search_all, StructType([StructField(n, hit_type) for n in names]))


def ordered_union(*hit_lists: Column) -> Column:
    """The lists one after another, null lists skipped, each hit kept at its first place."""
    present = F.filter(F.array(*hit_lists), lambda hits: hits.isNotNull())
    return F.array_distinct(F.flatten(present))
