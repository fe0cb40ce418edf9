import math

import pandas as pd
import pytest

from jobweave.operators import language
from jobweave import fixed
from jobweave.config import Limits
from jobweave.operators.language import (
    detect_language, detect_language_with, relabel_unlisted, relabel_weak, train_profile,
)

LABELLED = [
    ("the nurse and the doctor", "en"), ("the driver", "en"), ("der fahrer und die ärztin", "de"),
    ("la infirmière et le médecin", "fr"),
]
ADS = [
    ("1", "the driver"), ("2", "der Fahrer"), ("3", "le médecin, et"), ("4", "zzz qqq"), ("5", ""),
    ("6", None), ("7", "123 456"), (None, "the nurse"), ("1", "the driver"), ("1", "und die"),
]


@pytest.fixture(scope="module")
def profile(spark):
    return train_profile(spark.createDataFrame(LABELLED, "text string, lang string")).cache()


def by_hand(text):
    words = {}
    for line, lang in LABELLED:
        for word in line.split():
            words.setdefault(lang, []).append(word)
    vocabulary = {w for ws in words.values() for w in ws}
    tokens = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not tokens:
        return None, None
    p = {
        lang: math.exp(sum(math.log((ws.count(t) + 1) / (len(ws) + len(vocabulary))) for t in tokens) / len(tokens))
        for lang, ws in words.items()
    }
    best = max(p, key=lambda lang: (p[lang], lang))
    return best, p[best] / sum(p.values())


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=1, salts=3)])
def test_detection(spark, profile, limits):
    df = spark.createDataFrame(ADS, "id string, text string")
    got = detect_language(df, "text", profile, "id", limits).collect()
    assert len(got) == len(ADS)
    for row in got:
        lang, score = by_hand(row["text"])
        assert row["lang"] == lang
        assert row["score"] is None if score is None else row["score"] == pytest.approx(score)


def test_small_profile_needs_no_shuffle(spark, profile):
    df = spark.createDataFrame(ADS, "id string, text string")
    plan = detect_language(df, "text", profile)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_outside_detector(spark):
    def backend():
        def detect(texts: pd.Series) -> pd.DataFrame:
            return pd.DataFrame({"lang": texts.map(lambda t: t and t[:2]), "score": 0.9})

        return detect

    df = spark.createDataFrame([("1", "fr\nx"), ("2", None)], "id string, text string")
    got = {r["id"]: (r["lang"], r["score"]) for r in detect_language_with(df, "text", backend).collect()}
    assert got["1"] == ("fr", 0.9) and got["2"][0] is None


def test_relabelling(spark):
    cases = [("en", 0.39, "un"), ("en", 0.4, "en"), ("en", None, "en"), ("en", math.nan, "en"),
             ("no", 0.9, "un"), ("un", 0.9, "un"), (None, None, "un")]
    df = spark.createDataFrame([(c[0], c[1], c[2]) for c in cases], "lang string, score double, want string")
    for row in relabel_unlisted(relabel_weak(df)).collect():
        assert row["lang"] == row["want"]


def test_language_list():
    assert len(fixed.LANGUAGES) == 25 == len({code for _, code, _ in fixed.LANGUAGES})


def test_chunks_score_as_rows_do(spark, monkeypatch):
    """Many small chunks, copies, a repeated key, other columns, and texts without words."""
    monkeypatch.setattr(language, "CHUNK_BYTES", 40)
    texts = [f"the nurse {i} works at night" if i % 2 else f"die Pflege {i} bei der Nacht und the end" for i in range(40)]
    rows = [(i % 30, t, [i], None) for i, t in enumerate(texts)] + [(7, texts[7], [7], "x")] * 3 + [(50, None, None, None), (51, " 12 ", [], "y")]
    df = spark.createDataFrame(rows, "id long, text string, more array<int>, note string")
    known = spark.createDataFrame(
        [("the", "en", 5), ("nurse", "en", 2), ("night", "en", 1), ("die", "de", 4), ("pflege", "de", 2), ("nacht", "de", 1), ("end", "de", 1)],
        "token string, lang string, n long")

    def found(limits):
        done = language.detect_language(df, "text", known, limits=limits)
        return sorted((str(tuple(r)[:4]), r["lang"], None if r["score"] is None else round(r["score"], 9)) for r in done.collect())

    by_chunk = found(Limits(broadcast_rows=1))
    assert by_chunk == found(Limits()) and len(by_chunk) == 45
