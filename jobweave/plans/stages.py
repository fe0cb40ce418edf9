"""The four stages as DataFrame functions, and as jobs between stage tables.

The functions build one lazy plan each; they run nothing but size checks of small tables and the
model calls, whose answers are stored at once. The jobs add reading, the empty check,
the shard cut and the partitioned write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession, functions as F

from jobweave.config import JobConfig
from jobweave.fixed import LANGUAGES
from jobweave.functions.prompts import (
    chat_text, classification_messages, translation_messages,
)
from jobweave.functions.sections import format_hits
from jobweave.functions.text import clean_ads
from jobweave.operators.coding import (
    apply_overrides, read_classifications, read_translations, submission,
)
from jobweave.operators.generation import AnswerStore, generate
from jobweave.operators.label_search import multi_field_hits
from jobweave.operators.language import (
    detect_language, detect_language_with, relabel_unlisted, relabel_weak,
)
from jobweave.operators.models import Backend
from jobweave.operators.report import Counted
from jobweave.operators.retrieval import IndexChange, update_label_index
from jobweave.operators.sharding import contiguous_shards
from jobweave.sources.tables import (
    missing_shards, read_ads, read_labels, read_stage, spread, with_language_name, write_stage, write_submission,
)
from jobweave.storage import scratch_removed

DEFAULT = JobConfig()


# --- stages as DataFrame functions ---------------------------------------------


def detect_stage(
    ads: DataFrame,
    profile: DataFrame | None = None,
    detector: Backend | None = None,
    overrides: DataFrame | None = None,
    config: JobConfig = DEFAULT,
) -> DataFrame:
    """Clean texts and add ``lang, score``. Give a word profile or an outside detector."""
    if (profile is None) == (detector is None):
        raise ValueError("give either a profile or a detector")
    ads = ads.drop("lang", "score", "description_clean", "title_clean")  # results take their place
    if overrides is not None:
        ads = apply_overrides(
            ads, overrides, config.id_column, config.description_column, config.limits
        )
    clean = clean_ads(ads, config.title_column, config.description_column)
    if profile is not None:
        found = detect_language(
            clean, "description_clean", profile, config.id_column, config.limits
        )
    else:
        found = detect_language_with(clean, "description_clean", detector)
    return relabel_unlisted(relabel_weak(found, config.score_threshold))


def translation_prompts(
    ads: DataFrame, title: str, description: str, config: JobConfig = DEFAULT
) -> DataFrame:
    """Add ``translation_prompt``, the whole conversation as one string."""
    ads = ads.drop("translation_prompt")
    named = with_language_name(ads, "_language")
    messages = translation_messages(F.col(title), F.col(description), F.col("_language"))
    return named.withColumn("translation_prompt", chat_text(messages, config.chat)).select(
        *ads.columns, "translation_prompt"
    )


def translate_stage(
    ads: DataFrame,
    title: str,
    description: str,
    translator: Backend | DataFrame,
    config: JobConfig = DEFAULT,
    store: AnswerStore | None = None,
    resources: ResourceProfile | None = None,
) -> DataFrame:
    """Add the raw answer and its English title, description and keywords."""
    prompted = translation_prompts(ads.drop("raw_translations"), title, description, config)
    answered = generate(
        prompted, "translation_prompt", "raw_translations", translator, config.sampling, store, resources, "_too_long")
    return read_translations(answered.drop("translation_prompt"), too_long=F.col("_too_long")).drop("_too_long")


def prompt_stage(
    ads: DataFrame,
    index: DataFrame,
    title: str = "title_en",
    description: str = "description_en",
    keywords: str = "keywords",
    config: JobConfig = DEFAULT,
    embedder: Backend | None = None,
    once: bool = False,
    hits: bool = False,
) -> DataFrame:
    """Add ``prompt``: the ad together with the labels nearest to it; ``hits`` keeps these as a column, too."""
    ads = ads.drop("prompt", "hits")
    found = multi_field_hits(ads, index, title, description, keywords, config, embedder, once)
    messages = classification_messages(
        F.col(title), F.col(description), format_hits(F.col("hits"))
    )
    prompted = found.withColumn("prompt", chat_text(messages, config.chat))
    return prompted if hits else prompted.drop("hits")


def classify_stage(
    prompts: DataFrame,
    labels: DataFrame,
    classifier: Backend | DataFrame,
    codes: DataFrame | None = None,
    config: JobConfig = DEFAULT,
    store: AnswerStore | None = None,
    resources: ResourceProfile | None = None,
) -> DataFrame:
    """Add the raw answer, its checked code and the code's label."""
    answered = generate(
        prompts.drop("raw_responses"), "prompt", "raw_responses", classifier, config.sampling, store, resources, "_too_long")
    return read_classifications(
        answered, labels, codes=codes, limits=config.limits, too_long=F.col("_too_long")).drop("_too_long")


# --- stages as jobs between tables -----------------------------------------------


@dataclass(frozen=True)
class Paths:
    ads: str
    labels: str
    detected: str
    translated: str
    index: str
    prompts: str
    predicted: str
    submission: str


def _part(
    spark: SparkSession, path: str, languages: Sequence[str], shard: int | None, config: JobConfig
) -> DataFrame | None:
    """The asked languages and shard of a stage table; None, with a message, when empty."""
    table = read_stage(spark, path, languages)
    if table.isEmpty():
        print(f"nothing to do for {', '.join(languages)}: the table {path} has no rows of them")
        return None
    table = spread(table)
    if shard is None:
        return table
    cut = contiguous_shards(table, config.shards, [config.id_column])
    return cut.where(F.col("shard") == shard).drop("shard")


def run_detect(
    spark: SparkSession,
    paths: Paths,
    profile: DataFrame | None = None,
    detector: Backend | None = None,
    overrides: DataFrame | None = None,
    limit: int | None = None,
    config: JobConfig = DEFAULT,
) -> None:
    ads = read_ads(spark, paths.ads, limit=limit)
    with scratch_removed(spark):
        done = detect_stage(ads, profile, detector, overrides, config)
        write_stage(done, paths.detected, ["lang"], replaces=[code for _, code, _ in LANGUAGES])


def _shard_of(shard: int | None, config: JobConfig) -> tuple[int, int]:
    return (1, 1) if shard is None else (shard, config.shards)


def run_translate(
    spark: SparkSession,
    paths: Paths,
    title: str,
    description: str,
    languages: Sequence[str],
    translator: Backend | DataFrame,
    shard: int | None = None,
    config: JobConfig = DEFAULT,
    store: AnswerStore | None = None,
    resources: ResourceProfile | None = None,
) -> DataFrame | None:
    """Translate the languages, or one shard of them; returns the rows that it wrote by language and outcome."""
    ads = _part(spark, paths.detected, languages, shard, config)
    if ads is None:
        return None
    with scratch_removed(spark):
        done = translate_stage(ads, title, description, translator, config, store, resources)
        done = done.withColumnRenamed("outcome", "translate_outcome")
        counted = Counted(languages, "translate_outcome")
        write_stage(
            counted.watch(done), paths.translated, ["lang", "job_desc_extracted"], _shard_of(shard, config), languages
        )
    return counted.report(ads)


def run_index(
    spark: SparkSession,
    paths: Paths,
    config: JobConfig = DEFAULT,
    embedder: Backend | None = None,
    model: str | None = None,
) -> IndexChange:
    """Bring the label index up to date for all prompt jobs; only chunks that are new to it are embedded."""
    with scratch_removed(spark):
        return update_label_index(read_labels(spark, paths.labels), paths.index, config, embedder, model)


def run_prompts(
    spark: SparkSession,
    paths: Paths,
    title: str,
    description: str,
    languages: Sequence[str],
    shard: int | None = None,
    config: JobConfig = DEFAULT,
    embedder: Backend | None = None,
) -> None:
    ads = _part(spark, paths.translated, languages, shard, config)
    if ads is not None:
        with scratch_removed(spark):
            index = spark.read.parquet(paths.index)
            done = prompt_stage(ads, index, title, description, config=config, embedder=embedder)
            write_stage(
                done, paths.prompts, ["lang", "job_desc_extracted"], _shard_of(shard, config), languages
            )


def run_classify(
    spark: SparkSession,
    paths: Paths,
    languages: Sequence[str],
    classifier: Backend | DataFrame,
    codes: DataFrame,
    shard: int | None = None,
    config: JobConfig = DEFAULT,
    store: AnswerStore | None = None,
    resources: ResourceProfile | None = None,
) -> DataFrame | None:
    """Classify the languages, or one shard of them; returns the rows that it wrote by language and outcome.

    ``codes`` are the valid codes: the taxonomy table may lack some, so it is not asked for them.
    """
    prompts = _part(spark, paths.prompts, languages, shard, config)
    if prompts is None:
        return None
    with scratch_removed(spark):
        labels = read_labels(spark, paths.labels)
        done = classify_stage(prompts, labels, classifier, codes, config, store, resources)
        counted = Counted(languages)
        write_stage(
            counted.watch(done), paths.predicted, ["lang", "job_desc_extracted", "codable"],
            _shard_of(shard, config), languages,
        )
    return counted.report(prompts)


def run_submission(
    spark: SparkSession, paths: Paths, config: JobConfig = DEFAULT, compat: bool = False, incomplete: bool = False
) -> None:
    """The submission of all predictions, whichever runs have written them.

    Refused while shards of a language are missing, unless ``incomplete`` asks for what is there.
    """
    missing = missing_shards(spark, paths.predicted, levels=3)
    if missing and not incomplete:
        named = "; ".join(f"{language}: {', '.join(labels)}" for language, labels in missing.items())
        raise ValueError(f"shards are missing from {paths.predicted}: {named}")
    predicted = read_stage(spark, paths.predicted)
    write_submission(submission(predicted, config.id_column, compat), paths.submission, config.id_column)


def run_all(
    spark: SparkSession,
    paths: Paths,
    translator: Backend | DataFrame,
    classifier: Backend | DataFrame,
    languages: Sequence[str],
    codes: DataFrame,
    profile: DataFrame | None = None,
    detector: Backend | None = None,
    overrides: DataFrame | None = None,
    title: str = "title_clean",
    description: str = "description_clean",
    embedder: Backend | None = None,
    config: JobConfig = DEFAULT,
    store: AnswerStore | None = None,
) -> None:
    """All stages for all languages in one application; each stage table is a restart point.

    There is no split by thirds and no wait between them: partitions and tasks do that.
    """
    run_detect(spark, paths, profile, detector, overrides, config=config)
    run_translate(spark, paths, title, description, languages, translator, config=config, store=store)
    run_index(spark, paths, config, embedder)
    run_prompts(
        spark, paths, "title_en", "description_en", languages, config=config, embedder=embedder
    )
    run_classify(spark, paths, languages, classifier, codes, config=config, store=store)
    run_submission(spark, paths, config)
