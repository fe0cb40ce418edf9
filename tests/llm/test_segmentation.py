import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from jobweave.llm import queries, segmentation  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["the thing", "", "a", "hello wörld  and\n\nx 雲\U0001f600\t", " lead and trail  ", "x" * 3000, None, "in", "\n", "é" * 5]


@pytest.fixture(scope="module")
def vocabulary():
    return segmentation.load(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def draw(texts, vocabulary, samples, seed=1):
    rows = {}
    for result in segmentation.segment(texts, np.arange(len(texts)), vocabulary, samples, seed):
        for i, row in enumerate(result["row"].tolist()):
            ids = tuple(result["ids"][result["at"][i] : result["at"][i + 1]].tolist())
            rows[row, result["sample"]] = (ids, *(result[k][i] for k in ("log_prob", "perturbed", "log_inclusion")))
    return rows


def all_paths(unit, library):
    if not unit:
        yield ()
    for end in range(1, len(unit) + 1):
        piece = library.piece_to_id(unit[:end])
        if piece > 258:
            for rest in all_paths(unit[end:], library):
                yield (piece, *rest)


def test_samples_follow_the_distribution_without_replacement(vocabulary, library):
    weights = {p: sum(vocabulary.log_prob[i] for i in p) for p in all_paths("▁erth▁b", library)}
    total = math.log(sum(map(math.exp, weights.values())))
    share = {p: math.exp(w - total) for p, w in weights.items()}
    n = 20_000
    drawn = draw(["erth b"] * n, vocabulary, 3)
    first = Counter(drawn[i, 0][0] for i in range(n))
    pairs = Counter((drawn[i, 0][0], drawn[i, 1][0]) for i in range(n))
    for path, p in share.items():
        assert abs(first[path] / n - p) < 5 * math.sqrt(p / n) + 1e-3
    for (a, b), count in pairs.items():
        p = share[a] * share[b] / (1 - share[a])
        assert a != b and abs(count / n - p) < 5 * math.sqrt(p / n) + 1e-3
    estimate = 0.0
    for (row, sample), (ids, log_prob, perturbed, inclusion) in drawn.items():
        assert log_prob == pytest.approx(math.log(share[ids]), abs=1e-9)
        assert sample == 0 or perturbed <= drawn[row, sample - 1][2]
        estimate += math.exp(log_prob - inclusion) / n
    assert estimate == pytest.approx(1, abs=0.01)


def test_rows(spark, vocabulary, library):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "x")], "doc_id long, text string, IDS string")
    sampled = segmentation.sample_segmentations(df, vocabulary, "doc_id", samples=4, seed=3)
    decoded = segmentation.decode(sampled, vocabulary)
    rows = decoded.collect()
    assert decoded.columns == ["doc_id", "sample", "ids", "log_prob", "perturbed", "log_inclusion", "decoded"]
    per_text = Counter(r["doc_id"] for r in rows)
    assert per_text[1] == per_text[6] == 1 and per_text[0] == 8 and per_text[3] == 4
    for r in rows:
        assert r["decoded"] == (TEXTS[r["doc_id"]] or "") == library.decode(r["ids"])
        assert r["log_inclusion"] <= 1e-12
    ids = {(r["doc_id"], tuple(r["ids"])) for r in rows}
    assert len(ids) == len(rows) - 4  # the repeated row draws the same again
    assert sorted(map(str, sampled.collect())) == sorted(map(str, sampled.repartition(3).collect()))


def test_decoded_where_they_are_drawn(spark, vocabulary):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, Decoded string")
    once = segmentation.sample_segmentations(df, vocabulary, "doc_id", samples=3, decoded=True)
    twice = segmentation.decode(segmentation.sample_segmentations(df, vocabulary, "doc_id", samples=3), vocabulary)
    assert once.columns == twice.columns and sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    assert segmentation.sample_segmentations(df.limit(0), vocabulary, "doc_id", decoded=True).count() == 0


def test_the_query_has_one_step_in_python(spark, capsys):
    df = spark.createDataFrame([(1, "the thing")], "doc_id long, text string")
    queries.encoded(df, "doc_id").explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


def test_keys_and_empty_tables(spark, vocabulary):
    df = spark.createDataFrame([(None, "the thing"), ("k", "the thing")], "key string, text string")
    assert segmentation.sample_segmentations(df, vocabulary, "key").count() == 4
    assert segmentation.sample_segmentations(df.limit(0), vocabulary, "key").count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in segmentation.decode(none, vocabulary).orderBy("doc_id").collect()] == [None, ""]
    blanks = segmentation.sample_segmentations(
        spark.createDataFrame([(1, "a▁b")], "doc_id long, text string"), vocabulary, "doc_id", 1)
    assert segmentation.decode(blanks, vocabulary).select(F.col("decoded")).first()[0] == "a b"
