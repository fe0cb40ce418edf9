"""Text generation by a backend: each distinct prompt once, answers kept, and what is known not asked again."""

from __future__ import annotations

import inspect
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobweave.config import Sampling
from jobweave.operators.models import Backend, TEXTS_PER_TASK
from jobweave.storage import materialise

_ANSWERS = "key string, answer string"


def over_length(prompt: Column, sampling: Sampling) -> Column:
    """Whether a prompt leaves no room for its answer, by ``sampling.count_tokens`` or else by words, a lower bound."""
    if sampling.context_tokens is None:
        return F.lit(False)
    room = sampling.context_tokens - sampling.max_tokens
    if sampling.count_tokens is not None:
        return F.coalesce(sampling.count_tokens(prompt) > room, F.lit(False))
    return F.coalesce(F.size(F.split(F.trim(prompt), r"\s+")) > room, F.lit(False))


@dataclass(frozen=True)
class AnswerStore:
    """Answers that outlive a run, in a folder of batches, by a hash of prompt and settings.

    A batch is written aside and moved into the folder when it is whole, so a run that fails leaves the batches that it
    has finished, and the next one sends only what is missing. Runs may write at once; of two answers to one prompt the smaller
    counts, so all readers see the same. A null answer is kept as well: the model was asked.
    """

    path: str
    batch: int = 100_000  # prompts that one job sends

    def read(self, spark: SparkSession) -> DataFrame:
        """``key, answer``, one row per key."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        there = files.exists(folder) and len(files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/batch=*"))) > 0
        if not there:
            return spark.createDataFrame([], _ANSWERS)
        stored = spark.read.schema(_ANSWERS + ", batch string").parquet(self.path)
        return stored.groupBy("key").agg(F.min("answer").alias("answer"))

    def add(self, answers: DataFrame) -> None:
        spark = answers.sparkSession
        name = uuid.uuid4().hex
        answers.select("key", "answer").write.parquet(f"{self.path}/_new-{name}")
        to_path = spark._jvm.org.apache.hadoop.fs.Path
        new = to_path(f"{self.path}/_new-{name}")
        if not new.getFileSystem(spark._jsc.hadoopConfiguration()).rename(new, to_path(f"{self.path}/batch={name}")):
            raise OSError(f"cannot move {new} into {self.path}")


def generate(
    df: DataFrame,
    prompt: str,
    answer: str,
    backend: Backend | DataFrame,
    sampling: Sampling = Sampling(),
    store: AnswerStore | None = None,
    resources: ResourceProfile | None = None,
    too_long: str | None = None,
) -> DataFrame:
    """Add the backend's answer to each prompt.

    The rows are stored once, with the hash of their prompt; the distinct prompts and the rows that get the answers are
    read from there, so no prompt is rendered twice. Each distinct prompt is answered once and the answers are
    stored before anything reads them: a repeated task must not give a second, different answer. A
    prompt that is ``over_length`` is not sent and has a null answer; ``too_long`` names a column that tells which. A backend with a
    parameter ``sampling`` gets the settings when it is made.

    ``store`` keeps answers between runs. ``resources`` are what a model task needs (a GPU, say); they are used where
    the cluster manager knows such profiles. In place of a backend, a table ``prompt, answer`` gives
    answers that were made elsewhere; a prompt that it lacks has a null answer.
    """
    long = over_length(F.col(prompt), sampling)
    key = F.when(~long & F.col(prompt).isNotNull(), prompt_key(F.col(prompt), sampling))
    added = {"_key": key} | ({too_long: long} if too_long else {})
    asked = materialise(df.withColumns(added), "asked")
    if isinstance(backend, DataFrame):
        answers = backend.select(prompt_key(F.col("prompt"), sampling).alias("key"), "answer").groupBy("key").agg(
            F.min("answer").alias("answer"))
    else:
        distinct = _distinct(asked, prompt)
        if store is None:
            answers = materialise(_answered(distinct, backend, sampling, resources), "answers")
        else:
            answers = _resumed(distinct, backend, sampling, resources, store)
    # One prompt may be in a third of the rows. It has one answer, and adaptive skew handling splits the other side.
    answers = answers.select(F.col("key").alias("_key"), F.col("answer").alias(answer))
    return asked.join(answers, "_key", "left").drop("_key")


def prompt_key(prompt: Column, sampling: Sampling) -> Column:
    """What an answer is kept by: other settings give other answers."""
    settings = (sampling.model, sampling.max_tokens, sampling.temperature, sampling.top_p, sampling.repetition_penalty)
    return F.sha2(F.concat(F.lit(repr(settings) + "\0"), prompt), 256)


def _distinct(asked: DataFrame, prompt: str) -> DataFrame:
    """``key, prompt``: one exchange drops the copies and spreads the prompts over tasks of at most ``TEXTS_PER_TASK``.

    A few megabytes of prompts can be hours of work, and a lost task repeats its calls.
    """
    rows = asked.count()  # from the footers of the stored files
    tasks = max(asked.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / TEXTS_PER_TASK))
    return asked.where("_key is not null").select(F.col("_key").alias("key"), F.col(prompt).alias("prompt")).repartition(
        tasks, "key").dropDuplicates(["key"])


def _resumed(
    distinct: DataFrame, backend: Backend, sampling: Sampling, resources: ResourceProfile | None, store: AnswerStore
) -> DataFrame:
    """The answers of all prompts, after the missing ones have been sent batch by batch."""
    spark = distinct.sparkSession
    missing = materialise(distinct.join(store.read(spark), "key", "left_anti"), "missing")
    batches = math.ceil(missing.count() / store.batch)
    for batch in range(batches):
        part = missing.where(F.pmod(F.xxhash64("key"), F.lit(batches)) == batch)
        tasks = max(spark.sparkContext.defaultParallelism, math.ceil(store.batch / TEXTS_PER_TASK))
        store.add(_answered(part.repartition(tasks, "key"), backend, sampling, resources))
    return store.read(spark)


def _answered(
    prompts: DataFrame, backend: Backend, sampling: Sampling, resources: ResourceProfile | None
) -> DataFrame:
    """``key, answer`` of ``key, prompt``. The backend is made once in each task and sees whole batches."""
    if "sampling" in inspect.signature(backend).parameters:
        backend = partial(backend, sampling=sampling)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = backend()
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "answer": model(batch["prompt"])})

    return prompts.select("key", "prompt").mapInPandas(
        run, _ANSWERS, profile=usable_profile(prompts.sparkSession.sparkContext.master, resources))


def usable_profile(master: str, resources: ResourceProfile | None) -> ResourceProfile | None:
    """``resources``, if the master knows resource profiles; a local one does not."""
    return None if master.startswith("local") else resources
