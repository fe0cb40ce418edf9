"""Language identification by words first, then by ever shorter character n-grams.

A word of the model scores by its log frequency in each language. Any other word falls back to its
longest character n-grams that the model knows: the longest length with a known n-gram decides,
by the mean of the known ones. A text scores the mean of its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from jobweave.joins import lookup_join
from jobweave.llm.arrow import pieces, released
from jobweave.llm.common import replace_columns
from jobweave.storage import materialise

UNKNOWN = "und"
LETTERS = r"\p{L}[\p{L}\p{M}]*"
EDGE = "\u0001"
_WORDS = regex.compile(LETTERS)
_BLOCK = 1_000_000


@dataclass(frozen=True)
class Training:
    """Bounds of what is learned. ``rows`` per language are expected in the sample, picked by a hash of the row."""

    rows: int = 4000
    words: int = 60_000
    ngrams: int = 20_000
    longest: int = 5
    cells: int = 40_000_000


@dataclass(frozen=True)
class Model:
    """Scores by language: row i of ``scores[n]`` belongs to entry i of ``entries[n]``; n = 0 are words."""

    languages: tuple[str, ...]
    entries: tuple[tuple[str, ...], ...]
    scores: tuple[np.ndarray, ...]


def train(labelled: DataFrame, training: Training = Training()) -> Model:
    """A model of the columns ``text`` and ``lang``.

    Rows without text or lang teach nothing. The sample is a documented bound: languages with more
    than ``rows`` texts are thinned by a hash of all columns (give a key, so that copies are not drawn as one), whole
    texts are read. Counting is distributed; the driver gets at most
    ``words`` words and ``ngrams`` n-grams of each length, the most frequent ones (all that tie at the
    boundary stay out), and fewer if ``cells`` numbers do not hold them for all languages.
    """
    known = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select(
        F.col("text").cast("string"), F.col("lang").cast("string"), F.xxhash64(*labelled.columns).alias("row"))
    totals = materialise(known.groupBy("lang").agg(F.count(F.lit(1)).alias("texts")), "languages")
    languages = tuple(r["lang"] for r in totals.orderBy("lang").limit(training.cells).collect())
    if not languages:
        return Model((), (), ())
    share = F.pmod("row", F.lit(1 << 30)) / float(1 << 30)
    sample = lookup_join(known, totals, "lang").where(share < training.rows / F.col("texts"))
    words = materialise(
        sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"({LETTERS})"), F.lit(1))).alias("entry"))
        .groupBy("lang", "entry").agg(F.count(F.lit(1)).alias("n")),
        "language-words",
    )
    padded = F.concat(F.lit(EDGE), F.col("entry"), F.lit(EDGE))
    most = max(1, training.cells // len(languages) // (training.longest + 1))
    tables = [_frequent(words, min(training.words, most))]
    for length in range(1, training.longest + 1):
        grams = words.where(F.length("entry") + 2 >= length).select(
            "lang", "n",
            F.explode(F.transform(
                F.sequence(F.lit(1), F.length("entry") + 3 - length), lambda i: F.substr(padded, i, F.lit(length))
            )).alias("entry"),
        ).where(F.col("entry") != EDGE).groupBy("lang", "entry").agg(F.sum("n").alias("n"))
        tables.append(_frequent(materialise(grams, "language-grams"), min(training.ngrams, most)))
    return _model(languages, tables)


def predict(texts: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) to each row, from its whole ``text`` alone.

    The score is the share of the best language when the languages' mean word probabilities add up to one.
    A null text, one without a letter, or a model of no language gives ``und`` and 0. Ties go
    to the language that sorts first. Columns named like the results are replaced; an empty table stays empty.
    """
    rows = replace_columns(texts, "lang_pred", "score")
    schema = rows.withColumn("lang_pred", F.lit("")).withColumn("score", F.lit(0.0)).schema
    shared = rows.sparkSession.sparkContext.broadcast(model)
    place = rows.columns.index("text")
    return rows.mapInArrow(partial(_predict, shared=shared, place=place), schema)


def held_out(key: Column) -> Column:
    """Whether a row is kept from training: checksum of the key's text, modulo 4, is 2; null is not."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _frequent(counts: DataFrame, most: int) -> pa.Table:
    """Counts of the most frequent entries, at most ``most`` of them."""
    totals = counts.groupBy("entry").agg(F.sum("n").alias("total"))
    sizes = totals.groupBy("total").agg(F.count(F.lit(1)).alias("entries"))
    # The largest counts; there are at most ``most`` of them before the entries add up to it.
    least, held = 1, 0
    for row in sizes.orderBy(F.desc("total")).limit(most + 1).collect():
        held += row["entries"]
        if held > most:
            least = row["total"] + 1
            break
    kept = lookup_join(counts, totals.where(F.col("total") >= least), "entry", "inner")
    return kept.select("lang", "entry", "n").toArrow()


def _model(languages: tuple[str, ...], tables: list[pa.Table]) -> Model:
    place = {lang: i for i, lang in enumerate(languages)}
    entries, scores = [], []
    for table in tables:
        names = sorted(set(table.column("entry").to_pylist()))
        row = {name: i for i, name in enumerate(names)}
        counts = np.zeros((len(names), len(languages)))
        for lang, entry, n in zip(*(table.column(c).to_pylist() for c in ("lang", "entry", "n"))):
            counts[row[entry], place[lang]] = n
        # Half an occurrence for what a language has not shown.
        total = counts.sum(axis=0) + 0.5 * (len(names) + 1)
        entries.append(tuple(names))
        scores.append(np.log((counts + 0.5) / total).astype(np.float32))
    return Model(languages, tuple(entries), tuple(scores))


class _Scorer(dict):
    """Row number of a word in a growing table of scores; unseen words are scored once and kept."""

    MOST = 200_000

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.lookups = [dict(zip(names, range(len(names)))) for names in model.entries]
        self.blank = np.full(len(model.languages), np.log(0.5 / max(1, len(model.entries[0]))), np.float32)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.update(self.lookups[0])
        first = self.model.scores[0]
        self.table = np.empty((len(first) + self.MOST, len(self.model.languages)), np.float32)
        self.table[: len(first)] = first

    def __missing__(self, word: str) -> int:
        at = len(self)
        self.table[at] = self.backoff(word)
        self[word] = at
        return at

    def backoff(self, word: str) -> np.ndarray:
        padded = f"{EDGE}{word}{EDGE}"
        for length in range(len(self.lookups) - 1, 0, -1):
            lookup = self.lookups[length]
            found = [lookup[g] for i in range(len(padded) - length + 1) if (g := padded[i : i + length]) in lookup]
            if found:
                return self.model.scores[length][found].mean(axis=0)
        return self.blank

    def mean(self, text: str) -> np.ndarray | None:
        """Mean scores of all words of a text; long texts go in blocks, cut between words."""
        total, count = np.zeros(len(self.model.languages)), 0
        for words in _words(text):
            for start in range(0, len(words), 50_000):
                block = words[start : start + 50_000]
                if len(self) + len(block) > len(self.table):
                    self.reset()
                total += self.table[[self[w] for w in block]].sum(axis=0, dtype=np.float64)
                count += len(block)
        return total / count if count else None


def _words(text: str) -> Iterator[list[str]]:
    lowered = text.lower()
    if len(lowered) <= _BLOCK:
        yield _WORDS.findall(lowered)
        return
    found = (m[0] for m in _WORDS.finditer(lowered))
    while block := list(islice(found, 50_000)):
        yield block


@released
def _predict(batches: Iterator[pa.RecordBatch], shared, place: int) -> Iterator[pa.RecordBatch]:
    model = shared.value
    scorer = _Scorer(model) if model.languages else None
    for batch in batches:
        for piece in pieces(batch):
            languages, scores = [], []
            for text in piece.column(place).to_pylist():
                mean = scorer.mean(text) if scorer and text else None
                if mean is None:
                    languages.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    best = int(mean.argmax())
                    languages.append(model.languages[best])
                    scores.append(float(1 / np.exp(mean - mean[best]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                names=[*piece.schema.names, "lang_pred", "score"],
            )
