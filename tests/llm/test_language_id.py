import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobweave.llm import language_id
from jobweave.llm.common import table

SF = "/root/testdata/sf0.01"
TEXTS = [
    ("the cat and the dog", "en"), ("the house of the man", "en"), ("der hund und die katze", "de"),
    ("das haus und der mann", "de"), (None, "en"), ("no language", None),
]


def score_by_hand(text, training=language_id.Training()):
    """Mean log frequency per language, words first, then ever shorter parts of words."""
    langs = ("de", "en")
    words = {lang: Counter(w for t, x in TEXTS if t and x == lang for w in t.split()) for lang in langs}
    tables = [words]
    for n in range(1, training.longest + 1):
        grams = {lang: Counter() for lang in langs}
        for lang in langs:
            for word, count in words[lang].items():
                padded = f"\1{word}\1"
                for i in range(len(padded) - n + 1):
                    if padded[i : i + n] != "\1":
                        grams[lang][padded[i : i + n]] += count
        tables.append(grams)

    def score(level, entry):
        entries = {e for lang in langs for e in tables[level][lang]}
        return [
            math.log((tables[level][lang][entry] + 0.5) / (sum(tables[level][lang].values()) + 0.5 * (len(entries) + 1)))
            for lang in langs
        ]

    rows = []
    for word in text.split():
        if any(word in words[lang] for lang in langs):
            rows.append(score(0, word))
            continue
        padded = f"\1{word}\1"
        for n in range(training.longest, 0, -1):
            known = [padded[i : i + n] for i in range(len(padded) - n + 1)
                     if any(padded[i : i + n] in tables[n][lang] for lang in langs)]
            if known:
                scores = [score(n, g) for g in known]
                rows.append([sum(s[i] for s in scores) / len(scores) for i in range(2)])
                break
        else:
            rows.append([math.log(0.5 / max(1, len({w for lang in langs for w in words[lang]})))] * 2)
    mean = [sum(r[i] for r in rows) / len(rows) for i in range(2)]
    best = max(range(2), key=lambda i: mean[i])
    return langs[best], 1 / sum(math.exp(m - mean[best]) for m in mean)


def test_like_scoring_by_hand(spark):
    model = language_id.train(spark.createDataFrame(TEXTS, "text string, lang string"))
    assert model.languages == ("de", "en")
    texts = ["the hunter", "das hunden", "xqz", "mannhaus catdog", "The END und"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in language_id.predict(df, model).collect():
        lang, score = score_by_hand(row["text"].lower())
        assert row["lang_pred"] == lang and row["score"] == pytest.approx(score, abs=1e-5)


def test_edges(spark):
    model = language_id.train(spark.createDataFrame(TEXTS, "text string, lang string"))
    rows = [(1, None), (2, ""), (3, "123 $$ !"), (4, "the " * 300_000), (None, "the"), (4, "the")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("SCORE", F.lit("x"))
    got = language_id.predict(df, model).collect()
    assert [(r["lang_pred"], r["score"]) for r in got[:3]] == [("und", 0.0)] * 3
    assert all(r["lang_pred"] == "en" for r in got[3:]) and got[3]["score"] == pytest.approx(got[4]["score"], abs=1e-6)
    nothing = language_id.train(spark.createDataFrame([], "text string, lang string"))
    assert {r["lang_pred"] for r in language_id.predict(df, nothing).collect()} == {"und"}
    assert language_id.predict(df.limit(0), model).count() == 0


def test_bounds_of_the_model(spark):
    rows = [(" ".join(chr(97 + i % 26) * (1 + i % 7) for i in range(n, n + 40)), "x") for n in range(300)]
    training = language_id.Training(rows=50, words=20, ngrams=10)
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"), training)
    assert all(len(e) <= (20 if i == 0 else 10) for i, e in enumerate(model.entries))


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents").withColumn("held", language_id.held_out(F.col("doc_id")))
    model = language_id.train(docs.where("not held"))
    done = language_id.predict(docs.where("held").select("lang", "text"), model)
    right, n = done.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count(F.lit(1))).first()
    assert n > 200 and right / n >= 0.98
    assert language_id.held_out(F.lit(None)) is not None
