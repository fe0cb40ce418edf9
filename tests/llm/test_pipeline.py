import random
import re

import corpus_pipeline
from jobweave.storage import materialise

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, extra int"
WORDS = {
    "en": "the of and to in that is was for with his house water people morning river would their about under".split(),
    "de": "der die und das nicht mit auch eine werden haus wasser menschen fluss unter heute morgen wird über nach sich".split(),
}


def documents():
    rng = random.Random(8)
    text = lambda lang, n: "\n".join(
        " ".join(rng.choice(WORDS[lang]) for _ in range(12)) for _ in range(n))
    rows = [(i, text("en" if i % 3 else "de", 6), "en" if i % 3 else "de", f"s{i % 4}", 0, 1) for i in range(120)]
    clean = {r[0] for r in rows}
    rows.append((200, rows[5][1], "en", "s1", 0, 1))  # a copy
    words = rows[7][1].replace("\n", "\n").split(" ")
    for place in range(3, len(words), 17):
        words[place] += "xx"
    rows.append((201, " ".join(words), "en", None, 0, 1))  # a near copy, a word of every line changed
    rows += [(202, None, None, "s1", 0, 1), (203, "", "en", "s1", 0, 1), (204, "12 34 -- 56", "en", "s2", 0, 1)]
    return rows, clean


def by_stage(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, ""), name)
        yield name, docs


def test_stages(spark):
    rows, clean = documents()
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = {}
    for name, done in by_stage(spark, docs):
        kept[name] = done.collect()
        if name != "sentencepiece":
            assert done.columns == corpus_pipeline.COLUMNS
    ids = {name: {r["doc_id"] for r in found} for name, found in kept.items()}
    assert ids["language_id"] == clean | {200, 201}
    assert all(r["lang"] == ("en" if r["doc_id"] % 3 else "de") for r in kept["language_id"] if r["doc_id"] < 200)
    assert clean <= ids["line_dedup"] and 200 not in ids["line_dedup"]
    assert clean <= ids["simhash"]
    seen = {}
    for r in sorted(kept["line_dedup"], key=lambda r: r["doc_id"]):
        for line in r["text"].split("\n"):
            assert len(line) < 20 or seen.setdefault(line, r["doc_id"]) == r["doc_id"]
        assert r["n_chars"] == len(r["text"])
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"]))
    total = sum(map(size, kept["simhash"]))
    assert abs(sum(map(size, kept["mixing"])) - 1.5 * total) <= 0.02 * total
    assert max(sum(r["doc_id"] == i for r in kept["mixing"]) for i in ids["mixing"]) <= 2
    assert len(kept["sentencepiece"]) == 2 * len(kept["mixing"]) and all(r["round_trip"] for r in kept["sentencepiece"])


def test_copies_go_by_similarity(spark):
    rows, clean = documents()
    docs = spark.createDataFrame([r for r in rows if r[1]], SCHEMA)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert {r["doc_id"] for r in kept} == {r[0] for r in rows if r[1]} - {200} - similar_to(rows)


def similar_to(rows):
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or {tuple(words)}

    by_id = {r[0]: r[1] for r in rows if r[1]}
    x, y = shingles(by_id[7]), shingles(by_id[201])
    return {201} if len(x & y) >= 0.8 * len(x | y) else set()


def test_empty_table_passes_through(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert [done.count() for _, done in by_stage(spark, docs)] == [0] * 5
