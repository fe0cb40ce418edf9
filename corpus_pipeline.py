"""The corpus pipeline: documents through five of the training-data operators.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last return the
columns of ``documents``. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobweave.llm import language_id, line_dedup, mixing, near_copies
from jobweave.llm.common import WORD, table
from jobweave.llm.queries import MIX, encoded
from jobweave.storage import materialise

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language must have this share of the evidence. An even split over four languages gives 0.25 each.
LEAST_SCORE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language, with that language; those without a letter or of no clear language go."""
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))))
    predicted = language_id.predict(docs.select(*COLUMNS), model)
    known = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return predicted.where(known).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that come earlier; those of which no word is left go."""
    cut = line_dedup.drop_repeated_lines(docs.select(*COLUMNS), most=2, least_chars=20)
    return cut.where(F.col("text").rlike(WORD)).withColumn(
        "n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, found by SimHash in BK-trees, and in bands what these leave apart."""
    return near_copies.one_of_each(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes, each output shard in random order."""
    return mixing.shuffled(mixing.mix(docs.select(*COLUMNS), MIX)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two segmentations of each row."""
    return encoded(docs.select(*COLUMNS), "doc_id", "lang", "source")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: SQL has no edit join, no fingerprints and no lattice; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; the result of each is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
