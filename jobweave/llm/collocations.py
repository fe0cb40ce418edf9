"""Collocations: phrases that occur far more often than their parts would together.

Only the longest windows are counted: every word with the words that follow it in its piece of text, padded where the
piece ends. What a shorter phrase counts is the sum over the windows that begin with it, so one ROLLUP over the columns of a window
gives the counts of all lengths.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from jobweave.llm.arrow import pieces, released
from jobweave.storage import materialise

#: What follows the last word of a piece. No word is empty.
PAD = ""
#: Windows that a task counts before it hands them on.
_FLUSH = 4_000_000
_END = b"\xff"  # in no UTF-8 text
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _END * 10 + b" ")


@dataclass(frozen=True)
class Settings:
    longest: int = 3
    least: int = 10  # occurrences of a candidate
    inside_percent: int = 50  # of a candidate's occurrences, from which on a longer candidate covers it
    top: int = 2000
    scale: int = 1_000_000
    slots: int = 16  # tasks over which the windows of one first word are spread


def mine(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and these into words at blanks and tabs. A
    candidate is a phrase of 2 to ``longest`` words that occurs ``least`` times. Its score is ``floor(scale * a * a / (l * r))`` at
    the cut where that is least, ties at the first such cut. Candidates inside a longer one that has at least
    ``inside_percent`` of their occurrences are dropped. Ties in the order go by occurrences, then by the phrase in UTF-8 order.

    ``lang`` null counts as ``und``. Null and empty texts have no word; repeated rows count each time. An empty table, or
    one without a candidate, gives an empty result. Other columns do not matter. Counts are exact: products are decimals of 38 digits.
    """
    counts = materialise(phrase_counts(windows(documents, settings), settings), "phrase-counts")
    scored = materialise(_scores(counts, settings), "phrase-scores")
    kept = _not_inside(scored, settings)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    # First the best of each part of a language, so that no task sees more than the best of every part.
    part = F.pmod(F.xxhash64("phrase"), F.lit(settings.slots))
    kept = kept.withColumn("_part", part).withColumn("_place", F.row_number().over(
        Window.partitionBy("lang", "_part").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")))
    kept = kept.where(F.col("_place") <= settings.top).drop("_part", "_place")
    best = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= settings.top)
    totals = counts.where("words = 0").select("lang", "n")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _columns(settings: Settings) -> list[str]:
    return [f"w{k}" for k in range(1, settings.longest + 1)]


def windows(documents: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``head, tail, n``: windows as each task has counted them, language and first word in ``head``, the others in ``tail``.

    Padding is left out of the tail, so what follows the last word of a piece is the empty text. Two columns take
    a fifth less of a shuffle than one for every word.
    """
    rows = documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(partial(_windows, longest=settings.longest), "head string, tail string, n long")


def phrase_counts(counted: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``lang, w1.., words, n``: phrases of ``words`` words that occur ``least`` times; with 0 words, all occurrences.

    Windows are shuffled once, by their first word and a slot of their second. There the rarest ends are folded: a window under
    ``least`` counts as its prefix, padded. That changes no count that is asked for, and leaves little for the ROLLUP.
    """
    names = _columns(settings)
    spread = F.pmod(F.xxhash64(F.substring_index("tail", " ", 1)), F.lit(settings.slots)).cast("int")
    placed = counted.withColumn("slot", spread).repartition("head", "slot")
    folded = placed.groupBy("head", "slot", "tail").agg(F.sum("n").alias("n"), F.lit(False).alias("more"))
    for k in range(settings.longest, 1, -1):
        words = F.when(F.col("tail") == PAD, 0).otherwise(F.char_length("tail") - F.char_length(F.replace("tail", F.lit(" "))) + 1)
        here = words == k - 1
        whole = (F.col("n") >= settings.least) | F.col("more")
        prefix = F.struct(
            F.substring_index("tail", " ", k - 2).alias("tail"), F.when(whole, F.lit(0)).otherwise(F.col("n")).alias("n"),
            whole.alias("more"))
        itself = F.struct("tail", "n", F.lit(False).alias("more"))
        rows = F.when(~here, F.array(F.struct("tail", "n", "more"))).when(whole, F.array(itself, prefix)).otherwise(F.array(prefix))
        folded = folded.select("head", "slot", F.inline(rows)).groupBy("head", "slot", "tail").agg(
            F.sum("n").alias("n"), F.max("more").alias("more"))
    first = F.substring_index("head", "\t", -1)  # no word holds a tab, a language may
    tail = F.split("tail", " ")
    folded = materialise(folded.select(
        F.left("head", F.char_length("head") - F.char_length(first) - 1).alias("lang"), first.alias("w1"),
        *(F.coalesce(F.get(tail, F.lit(i)), F.lit(PAD)).alias(name) for i, name in enumerate(names[1:])), "n"), "phrase-windows")
    rolled = folded.sparkSession.sql(
        f"select lang, {', '.join(f'coalesce({w}, {{pad}}) as {w}' for w in names)},"
        f" {len(names)} - bit_count(grouping_id(lang, {', '.join(names)})) as words, sum(n) as n"
        f" from {{folded}} group by lang, rollup({', '.join(names)})",
        folded=folded, pad=PAD)
    ends_in_word = F.col("words") == sum((F.col(w) != PAD).cast("int") for w in names)
    return rolled.where(ends_in_word & ((F.col("n") >= settings.least) | (F.col("words") == 0)))


def _scores(counts: DataFrame, settings: Settings) -> DataFrame:
    """Candidates with the counts of the parts at their weakest cut."""
    names = _columns(settings)
    known = counts.where("words > 0").select("lang", F.array(*names).alias("at"), "words", "n")
    known = materialise(known.select("lang", F.slice("at", F.lit(1), F.col("words")).alias("at"), "words", "n"), "phrase-known")
    cuts = known.where("words > 1").select(
        "lang", F.col("at").alias("phrase"), F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select(
        "*", F.slice("phrase", F.lit(1), F.col("k")).alias("first"),
        F.slice("phrase", F.col("k") + 1, F.size("phrase") - F.col("k")).alias("rest"))
    left = known.select("lang", F.col("at").alias("first"), F.col("n").alias("l"))
    right = known.select("lang", F.col("at").alias("rest"), F.col("n").alias("r"))
    wide = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    a, l, r = (F.col(c).cast("decimal(16,0)") for c in "alr")
    score = F.call_function("div", (a * a).cast("decimal(31,0)") * F.lit(settings.scale).cast("decimal(7,0)"), l * r)
    weakest = wide.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return weakest.select(
        "lang", F.array_join("phrase", " ").alias("phrase"), F.col("phrase").alias("at"), "a", "cut.l", "cut.r", "cut.score")


def _not_inside(scored: DataFrame, settings: Settings) -> DataFrame:
    """Candidates that no longer candidate covers."""
    size = F.size("at")
    parts = F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("at", i, m))))
    covers = scored.where(size > 2).select("lang", F.col("a").alias("longer"), F.explode(parts).alias("at"))
    covers = covers.groupBy("lang", "at").agg(F.max("longer").alias("longer"))
    covered = F.coalesce(100 * F.col("longer") >= settings.inside_percent * F.col("a"), F.lit(False))
    return scored.join(covers, ["lang", "at"], "left").where(~covered)


@released
def _windows(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[pa.RecordBatch]:
    """Words become numbers, lead columns are the numbers one and more places on, and equal windows are counted."""
    most = (1 << 63 // longest) - 1
    held: dict[str, tuple[dict[bytes, int], list[np.ndarray]]] = {}
    rows = 0
    for batch in batches:
        for piece in pieces(batch):
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(piece.column(0).to_pylist(), piece.column(1).cast(pa.binary()).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                number, codes = held.setdefault(lang, ({_END: 0}, []))
                data = _END.join(texts).lower().translate(_BREAKS)
                some = data.replace(_END, b" " + _END + b" ").split(b" ")
                codes.append(np.array([number.setdefault(w, len(number)) for w in some if w] + [0], dtype=np.int64))
                rows += len(codes[-1])
                if len(number) > most // 2:
                    rows = _FLUSH
            if rows >= _FLUSH:
                for lang, (number, codes) in held.items():
                    yield from _counted(lang, number, codes, longest)
                held, rows = {}, 0
    for lang, (number, codes) in held.items():
        yield from _counted(lang, number, codes, longest)


def _counted(lang: str, number: dict[bytes, int], codes: list[np.ndarray], longest: int) -> Iterator[pa.RecordBatch]:
    words = sorted(number.keys() - {_END})
    place = np.zeros(len(number), dtype=np.int64)  # the pad, then the words in order, so that like windows lie together
    place[[number[w] for w in words]] = np.arange(1, len(words) + 1)
    lead = np.concatenate([place[c] for c in codes] + [np.zeros(longest, dtype=np.int64)])
    bits = len(words).bit_length()
    last = len(lead) - longest
    columns, ended = [lead[:last]], np.zeros(last, dtype=bool)
    for k in range(1, longest):
        ended |= lead[k : last + k] == 0
        columns.append(np.where(ended, 0, lead[k : last + k]))
    begins = columns[0] > 0
    if bits * longest <= 63:
        keys, n = np.unique(sum(c[begins] << bits * (longest - 1 - k) for k, c in enumerate(columns)), return_counts=True)
        columns = [keys >> bits * (longest - 1 - k) & (1 << bits) - 1 for k in range(longest)]
    else:  # one text of millions of different words
        keys, n = np.unique(np.stack([c[begins] for c in columns], axis=1), axis=0, return_counts=True)
        columns = [keys[:, k] for k in range(longest)]
    texts = pa.array([PAD, *(w.decode() for w in words)], pa.string())
    heads = pa.array([PAD, *(f"{lang}\t{w.decode()}" for w in words)], pa.string())
    for start in range(0, len(n), 50_000):
        some = slice(start, start + 50_000)
        tail = pc.binary_join_element_wise(*(texts.take(pa.array(c[some])) for c in columns[1:]), " ")
        tail = pc.utf8_rtrim(tail, characters=" ")  # no word holds a blank, so only padding goes
        yield pa.RecordBatch.from_arrays(
            [heads.take(pa.array(columns[0][some])), tail, pa.array(n[some])], names=["head", "tail", "n"])
