"""Language of a text: word profiles per language, learned and applied by Spark."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from jobweave import fixed
from jobweave.config import Limits
from jobweave.functions.text import eol_to_space, word_text, words
from jobweave.joins import DEFAULT_LIMITS
from jobweave.operators.models import Backend, model_column
from jobweave.storage import materialise

#: Bytes of text in a chunk, about, where the profile is too large for a task.
CHUNK_BYTES = 16 << 20


def train_profile(texts: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Word counts per language from labelled texts: ``token, lang, n``."""
    return (
        texts.where(F.col(lang).isNotNull())
        .select(F.col(lang).alias("lang"), F.explode(words(F.col(text))).alias("token"))
        .groupBy("token", "lang")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def detect_language(
    df: DataFrame,
    text: str,
    profile: DataFrame,
    key: str = "id",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add ``lang, score``: the likeliest language and its share among all languages.

    The score of a language is the geometric mean of its smoothed word shares. ``profile`` is read
    several times, so give a stored one. Within the broadcast bounds every task holds it and
    scores its own rows, and nothing is shuffled; of a larger one each chunk of rows gets the words that it has.
    """
    rows, text_bytes, languages = profile.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("token")), F.lit(0)),
        F.count_distinct("lang"),
    ).first()
    at_most = text_bytes + 8 * rows * languages
    if rows <= limits.broadcast_rows and at_most <= limits.broadcast_bytes:
        return _detect_by_row(df, text, profile)
    return _detect_by_chunks(df, text, profile, key)


def _detect_by_row(df: DataFrame, text: str, profile: DataFrame) -> DataFrame:
    """Score each text in the task that has it, with the words looked up in a shared table."""
    rows = profile.select("token", "lang", "n").toArrow().combine_chunks()
    tokens, langs = (
        pc.dictionary_encode(rows[name].combine_chunks()) for name in ("token", "lang")
    )
    counts = np.zeros((len(tokens.dictionary) + 1, len(langs.dictionary)))  # last row: unseen words
    np.add.at(counts, (tokens.indices.to_numpy(), langs.indices.to_numpy()), rows["n"].to_numpy())
    names = langs.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    shares = np.log((counts + 1) / (counts.sum(axis=0) + len(tokens.dictionary)))[:, order]
    places = {token: place for place, token in enumerate(tokens.dictionary.to_pylist())}
    shared = df.sparkSession.sparkContext.broadcast((places, shares, [names[i] for i in order]))

    def score(texts: pd.Series) -> pd.DataFrame:
        index, log_shares, languages = shared.value
        found = _scored(texts, index, log_shares, languages)
        return pd.DataFrame(found, columns=["lang", "score"]).astype({"score": "float64"})

    result = F.pandas_udf(score, "struct<lang:string,score:double>")
    return df.withColumn("_found", result(word_text(eol_to_space(F.col(text))))).select(
        *df.columns, F.col("_found.lang").alias("lang"), F.col("_found.score").alias("score")
    )


def _detect_by_chunks(df: DataFrame, text: str, profile: DataFrame, key: str) -> DataFrame:
    """Texts meet the shares of just their own words, chunk by chunk.

    A chunk is some megabytes of texts. Only its different words are joined with the profile, whatever their number in the
    texts; a task then holds the words of one chunk and scores the rows as they come, all columns with them. The chunk
    hashes the key column together with the text, so neither copies of a text nor a repeated key make a large one.
    """
    totals = profile.groupBy("lang").agg(F.sum("n").alias("n")).orderBy("lang").collect()
    vocabulary = profile.agg(F.count_distinct("token")).first()[0]
    sizes = {row["lang"]: float(row["n"] + vocabulary) for row in totals}
    counts = profile.groupBy("token").pivot("lang", list(sizes)).agg(F.sum("n"))
    shares = F.array(*(
        F.log((F.coalesce(F.col(f"`{lang}`"), F.lit(0)) + 1) / F.lit(size)) for lang, size in sizes.items()))
    asked = materialise(df.withColumn("_hash", F.xxhash64(F.col(key), F.col(text))), "asked")
    size = asked.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = math.ceil(size / CHUNK_BYTES) or 1
    rows = asked.withColumn("_chunk", F.pmod("_hash", F.lit(chunks)))
    spoken = eol_to_space(F.col(text))
    own = rows.select("_chunk", F.explode(F.array_distinct(words(spoken))).alias("token")).distinct()
    known = own.join(counts.select("token", shares.alias("shares")), "token")
    whole = F.struct(*df.columns)
    left = known.select(
        "_chunk", F.lit(0).alias("side"), F.col("token").alias("words"), "shares", F.lit(None).cast(rows.select(whole).schema[0].dataType).alias("row"))
    right = rows.select(
        "_chunk", F.lit(1).alias("side"), word_text(spoken).alias("words"), F.lit(None).cast("array<double>").alias("shares"), whole.alias("row"))
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), chunks)
    ordered = left.unionByName(right).repartition(tasks, "_chunk").sortWithinPartitions("_chunk", "side")
    schema = StructType([*df.schema, *StructType.fromDDL("lang string, score double")])
    unseen = [-math.log(size) for size in sizes.values()]
    return ordered.mapInArrow(partial(_score_chunks, languages=list(sizes), unseen=unseen), schema)


def _score_chunks(batches: Iterator[pa.RecordBatch], languages: list[str], unseen: list[float]) -> Iterator[pa.RecordBatch]:
    """Gathers the words of each chunk, which come first, and scores its rows as they come."""
    here, places, shares, table = None, {}, [], np.array([unseen])
    for batch in batches:
        chunk, side = batch.column("_chunk").to_numpy(), batch.column("side").to_numpy()
        cuts = np.flatnonzero((chunk[1:] != chunk[:-1]) | (side[1:] != side[:-1])) + 1
        starts = np.concatenate(([0], cuts, [batch.num_rows]))
        for start, end in zip(starts, starts[1:]):
            if start == end:
                continue
            some = batch.slice(start, end - start)
            if chunk[start] != here:
                here, places, shares, table = chunk[start], {}, [], None
            if side[start] == 0:
                for token in some.column("words").to_pylist():
                    places[token] = len(places)
                shares.append(some.column("shares").flatten().to_numpy().reshape(-1, len(languages)))
                continue
            if table is None:
                table, shares = np.concatenate([*shares, [unseen]]) if languages else np.empty((1, 0)), []
            found = _scored(some.column("words").to_pylist(), places, table, languages)
            yield pa.RecordBatch.from_arrays(
                [*some.column("row").flatten(), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[*(field.name for field in some.schema.field("row").type), "lang", "score"])


def _scored(texts: Iterable[str | None], places: dict[str, int], shares: np.ndarray, languages: list[str]) -> list[tuple]:
    """The likeliest language and its share for each text of words; the last row of ``shares`` is that of unseen words."""
    none = len(shares) - 1
    found: list[tuple] = []
    for spoken in texts:
        tokens = spoken.split() if spoken else []
        if not tokens or not languages:
            found.append((None, None))
            continue
        found_at = np.fromiter(map(places.get, tokens, repeat(none)), np.int64, len(tokens))
        likelihood = np.exp(shares[found_at].mean(axis=0))
        best = len(languages) - 1 - int(np.argmax(likelihood[::-1]))
        found.append((languages[best], likelihood[best] / likelihood.sum()))
    return found


def detect_language_with(df: DataFrame, text: str, backend: Backend) -> DataFrame:
    """Add ``lang, score`` by an outside detector; blank and missing texts give null."""
    found = model_column(
        backend, eol_to_space(F.col(text)), "struct<lang:string,score:double>"
    )
    return df.withColumn("_found", found).select(
        *df.columns, F.col("_found.lang").alias("lang"), F.col("_found.score").alias("score")
    )


def relabel_weak(df: DataFrame, threshold: float = 0.4) -> DataFrame:
    """A score under the threshold makes the language undefined; a missing score keeps it."""
    return df.withColumn(
        "lang", F.when(F.col("score") < threshold, fixed.UNDEFINED).otherwise(F.col("lang"))
    )


def relabel_unlisted(df: DataFrame, languages: list[str] | None = None) -> DataFrame:
    """A missing or unlisted language becomes undefined."""
    listed = [code for _, code, _ in fixed.LANGUAGES] if languages is None else languages
    return df.withColumn(
        "lang", F.when(F.col("lang").isin(listed), F.col("lang")).otherwise(fixed.UNDEFINED)
    )
