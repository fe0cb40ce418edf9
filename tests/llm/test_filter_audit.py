from itertools import permutations

import pytest

from jobweave.llm import filter_audit as A

WORDS = " ".join(f"w{i}" for i in range(200))
DOCUMENTS = [  # doc_id, lang, text
    (1, "en", WORDS), (2, "en", WORDS), (3, "fr", WORDS), (3, "fr", WORDS), (4, None, None), (5, "en", ""), (6, "", "short $"),
    (7, "en", "a " * 250), (8, "en", WORDS.upper()), (9, "fr", "a\x0bb c " * 100 + WORDS), (None, "en", WORDS), (10, "en", "É" * 3 + "A"),
    (11, "en", " ".join(["x", "y"] * 100)), (12, "de", "A" * 3 + "b" * 97), (13, "de", "A" * 4 + "b" * 96),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (7, 1, 0), (8, None, 1), (99, 1, 1), (None, 1, 1)]


def failed(doc_id, text):
    text = text or ""
    words = [w for w in __import__("re").split("[\x20\x09-\x0D]+", text) if w]
    fails = ""
    fails += "A" if len(words) < 200 else ""
    fails += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    fails += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text) else ""
    fails += "D" if set("#$%&*|") & set(text) else ""
    earlier = [d for d, _, other in DOCUMENTS if d is not None and doc_id is not None and d < doc_id and (other or "") == text]
    return fails + ("E" if earlier else "")


def brute():
    out = {}
    good = {d for d, q, _ in LABELS if q == 1 and d is not None}
    toxic = {d for d, _, t in LABELS if t == 1 and d is not None}
    for part in {lang or "" for _, lang, _ in DOCUMENTS}:
        docs = [(d, failed(d, t)) for d, lang, t in DOCUMENTS if (lang or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        rows = {}
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, name in enumerate(order, 1):
                gone = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                total[name] += len(gone)
                rows[part, order, step] = [
                    len(left), len(gone), sum(name in f for _, f in docs) - len(gone), sum(f == name for _, f in docs),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        out |= {key: (*row, total[key[1][key[2] - 1]]) for key, row in rows.items()}
    return out


def tables(spark, documents, labels):
    extra = [(*row, "x") for row in documents]
    return (spark.createDataFrame(extra, "doc_id long, lang string, text string, mask string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_every_count_of_every_step(spark):
    found = A.audit(*tables(spark, DOCUMENTS, LABELS)).collect()
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found} == brute()


def test_no_document(spark):
    assert A.audit(*tables(spark, [], LABELS)).count() == 0
    assert A.audit(*tables(spark, DOCUMENTS[:1], [])).count() == 600


@pytest.mark.parametrize("n", [1, 2**20, 2**40, 2**55 // 120])
def test_sums_reach_no_other_field(spark, n):
    kinds = spark.createDataFrame([("p", 0b10111, 1, 1, n), ("p", 0, 1, 0, n)], "part string, mask int, good int, toxic int, n long")
    rows = A.unpack(A.outcomes(kinds)).collect()
    assert len(rows) == 600 and all(r["kept"] + r["removed"] + r["redundant"] >= n for r in rows)
    for r in rows:
        own = r["filter_order"][r["step"] - 1]
        assert r["shapley"] == (0 if own == "D" else 30 * n)
        assert r["removed"] == r["good_lost"] == r["toxic_lost"] and r["unique_fails"] == 0
        assert r["kept"] in (n, 2 * n) and r["redundant"] in (0, n)


def test_a_very_long_text(spark):
    text = "word " * 600_000
    out = A.audit(*tables(spark, [(1, "en", text)], [])).where("step = 1 and filter_order like 'B%'").first()
    assert out["removed"] == 1 and out["unique_fails"] == 1
