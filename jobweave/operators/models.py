"""The border to models: a language detector, an embedder, a text generator.

A backend is a picklable factory without arguments. It is called once in each task and returns a
function from a batch of texts to a batch of results, so a model is loaded once per task and
sees whole Arrow batches. Only the text column crosses to Python, and every row keeps its own
result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from jobweave.joins import content_hash

#: Texts that one task sends to a model, at most.
TEXTS_PER_TASK = 1000

Model = Callable[[pd.Series], "pd.Series | pd.DataFrame"]
Backend = Callable[[], Model]


def model_column(backend: Backend, text: Column, result_type: str) -> Column:
    """The backend's result for each text. Struct types take a frame from the model.

    Marked as not repeatable, so that the optimizer never puts a second call into a plan.
    """
    if result_type.startswith("struct"):

        def run_struct(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            model = backend()
            for batch in batches:
                yield model(batch)

        return F.pandas_udf(run_struct, result_type).asNondeterministic()(text)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = backend()
        for batch in batches:
            yield model(batch)

    return F.pandas_udf(run, result_type).asNondeterministic()(text)


def distinct_texts(df: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with a ``<column>_key`` per text column, and the distinct texts of all of them.

    The second table is ``_text_key, _text``. Rows without a text get a key of their own that
    meets nothing, so that they spread over tasks as well. The number of tasks grows with the
    rows, ``TEXTS_PER_TASK`` each at most: a few megabytes of prompts can be hours of work, and a lost
    task repeats its calls. One exchange by key both drops the copies and spreads the texts.
    """
    alone = F.hex(content_hash(df))
    keyed = df.withColumns({f"{c}_key": F.coalesce(F.md5(F.col(c)), alone) for c in columns})
    texts = F.array(
        *(F.struct(F.md5(F.col(c)).alias("_text_key"), F.col(c).alias("_text")) for c in columns)
    )
    rows = df.select(F.lit(1)).count() * len(columns)  # reads no text
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / TEXTS_PER_TASK))
    distinct = (
        df.select(F.inline(texts))  # not from keyed: that would read every column
        .where(F.col("_text").isNotNull())
        .repartition(tasks, "_text_key")
        .dropDuplicates(["_text_key"])
    )
    return keyed, distinct


def join_by_text(keyed: DataFrame, column: str, results: DataFrame) -> DataFrame:
    """``keyed`` with the results of one text column, which are keyed by ``_text_key``.

    One text may be in a third of the rows. The results have a single row for it, and adaptive
    skew handling splits the other side.
    """
    key = f"{column}_key"
    return keyed.join(results.withColumnRenamed("_text_key", key), key, "left").drop(key)
