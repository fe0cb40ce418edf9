import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings as settings_of, strategies as st

from jobweave.llm import collocations as C


def brute(documents, plan):
    counts, totals = {}, Counter()
    for lang, text in documents:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", lowered):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, plan.longest + 1):
                for i in range(len(words) - size + 1):
                    key = lang, tuple(words[i : i + size])
                    counts[key] = counts.get(key, 0) + 1
    out = []
    candidates = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= plan.least}
    for (lang, phrase), a in candidates.items():
        cuts = []
        for k in range(1, len(phrase)):
            l, r = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((plan.scale * a * a // (l * r), k, l, r))
        inside = any(
            other == lang and len(longer) > len(phrase) and 100 * b >= plan.inside_percent * a
            and any(longer[i : i + len(phrase)] == phrase for i in range(len(longer)))
            for (other, longer), b in candidates.items())
        if not inside:
            score, _, l, r = min(cuts)
            out.append((lang, -score, -a, " ".join(phrase).encode(), l, r))
    rows, rank = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        rank[lang] += 1
        if rank[lang] <= plan.top:
            rows.append((lang, rank[lang], phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(rows)


def mined(spark, documents, plan):
    rows = spark.createDataFrame([(*d, "x", 1) for d in documents], "lang string, text string, w1 string, n int")
    return sorted(map(tuple, C.mine(rows, plan).collect()))


TEXTS = [
    ("en", "The quick fox. the QUICK fox! The quick\tfox, a fox\nthe quick  fox" * 6), ("en", None), ("en", ""), (None, "a a a a a a a a a a a a"),
    ("fr", "É é É é É é É é É é É é É é é x é x"), ("en", "the quick the quick the quick the quick"), ("de", " , ; : "), ("a\tb", "x y x y x y x y x y x y x y"),
]


@pytest.mark.parametrize("plan", [
    C.Settings(), C.Settings(least=2), C.Settings(least=3, longest=2), C.Settings(least=2, longest=4, slots=3), C.Settings(least=2, top=1),
    C.Settings(least=1, inside_percent=100),
])
def test_against_brute_force(spark, plan):
    assert mined(spark, TEXTS * 2, plan) == brute(TEXTS * 2, plan)


@settings_of(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.text("abAB .\t\n", max_size=120)), max_size=6))
def test_any_texts(spark, documents):
    plan = C.Settings(least=2, slots=2)
    assert mined(spark, documents, plan) == brute(documents, plan)


def test_counts_beyond_64_bits(spark):
    big = 3 * 10**9
    windows = spark.createDataFrame(
        [("en\ta", "b", big), ("en\tb", "", big), ("en\ta", "c", 7)], "head string, tail string, n long")
    scored = C._scores(C.phrase_counts(windows, C.Settings()), C.Settings()).collect()
    assert [(r["phrase"], r["a"], r["l"], r["r"], r["score"]) for r in scored] == [
        ("a b", big, big + 7, big, 1_000_000 * big * big // ((big + 7) * big))]


def test_windows_flushed_early_and_of_many_words(spark, monkeypatch):
    monkeypatch.setattr(C, "_FLUSH", 5)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array(["a b c d e"] * 3)], names=["lang", "text"])
    out = [r for b in C._windows(iter([batch, batch]), 3) for r in b.to_pylist()]
    total = Counter()
    for r in out:
        total[r["head"], r["tail"]] += r["n"]
    assert total == {("en\ta", "b c"): 6, ("en\tb", "c d"): 6, ("en\tc", "d e"): 6, ("en\td", "e"): 6, ("en\te", ""): 6}
    number = {C._END: 0} | {f"w{i}".encode(): i + 1 for i in range(9)}
    import numpy as np

    wide = list(C._counted("en", number, [np.array([1, 2, 3, 0])], 20))  # 20 columns do not fit one key
    assert [(r["head"], r["tail"]) for r in wide[0].to_pylist()] == [("en\tw0", "w1 w2"), ("en\tw1", "w2"), ("en\tw2", "")]
