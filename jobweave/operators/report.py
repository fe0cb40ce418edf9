"""Counts that a run reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, functions as F

OUTCOMES = ("ok", "parse_error", "invalid_code", "too_long")


def outcome_report(df: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Rows by language and outcome (``ok``, ``parse_error``, ``invalid_code``, ``too_long``)."""
    return df.groupBy("lang", F.col(outcome).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def chunk_count(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count(F.lit(1)).alias("n_chunks"))


class Counted:
    """Rows by language and outcome, counted while a table is written: no job of its own, no second read.

    Wrap what is written in ``watch``; after the write, ``report`` has the counts of ``outcome_report``. Rows of a language that is not
    among ``languages`` are counted together under a null language.
    """

    def __init__(self, languages: Iterable[str], outcome: str = "outcome"):
        self.languages, self.outcome = list(dict.fromkeys(languages)), outcome
        self.seen = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        listed = F.coalesce(F.col("lang").isin(self.languages), F.lit(False))
        counts = []
        for o, outcome in enumerate(OUTCOMES):
            here = F.col(self.outcome) == outcome
            counts += [F.count_if(here & (F.col("lang") == lang)).alias(f"{i}/{o}") for i, lang in enumerate(self.languages)]
            counts.append(F.count_if(here & ~listed).alias(f"{len(self.languages)}/{o}"))
        return df.observe(self.seen, *counts)

    def report(self, df: DataFrame) -> DataFrame:
        """``lang, outcome, n`` of what was written; ``df`` only lends its session."""
        rows = []
        for name, n in self.seen.get.items():
            i, o = map(int, name.split("/"))
            if n:
                rows.append(([*self.languages, None][i], OUTCOMES[o], n))
        return df.sparkSession.createDataFrame(rows, "lang string, outcome string, n long")
