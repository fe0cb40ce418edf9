import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from jobweave.llm import byte_bpe as B

RANKS = B.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
PUBLIC = tiktoken.Encoding(
    "public", pat_str=RANKS.pattern, mergeable_ranks={t: i for i, t in enumerate(RANKS.tokens)}, special_tokens={})
TEXTS = [
    "", " ", "a", "\n\n  x", "Hello there, it's <|endoftext|> 12345!", "don't DON'T", "naïve Übermut — 東京 🙂👩‍👩‍👧",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "\x00\x01﻿ ", "x" * 63, "y" * 64, "z" * 65, "=-" * 4000,
]


def random_texts(n):
    draw = random.Random(3)
    alphabet = "etaoin shrdlu ETA .,'\n\t0123é東🙂́=-_"
    return ["".join(draw.choice(alphabet) for _ in range(draw.choice((3, 30, 300, 3000)))) for _ in range(n)]


def encoded(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    return {r["k"]: r for r in B.decode(B.encode(rows, RANKS), RANKS).collect()}


def test_ids_are_those_of_the_public_library(spark):
    texts = TEXTS + random_texts(60)
    found = encoded(spark, [*texts, None])
    for k, text in enumerate(texts):
        assert found[k]["ids"] == PUBLIC.encode_ordinary(text)
        assert bytes(found[k]["decoded"]) == text.encode()
    assert found[len(texts)]["ids"] == [] and bytes(found[len(texts)]["decoded"]) == b""


def test_one_tree_and_many_give_the_same():
    draw = random.Random(5)
    words = [bytes(draw.choice(b"abcdeth ing\xc3\xa9") for _ in range(draw.randint(2, 64))) for _ in range(2000)]
    rank_of = {t: i for i, t in enumerate(RANKS.tokens)}
    words = [w for w in words if w not in rank_of]
    together = B.merge_together(words, B.Pairs(RANKS))
    assert [ids.tolist() for ids in together] == [B.merge(w, rank_of) for w in words]


def test_equal_ranks_merge_from_the_left():
    ranks = B.Ranks((*(bytes([b]) for b in range(256)), b"aa", b"ab", b"aaa"), r".+")
    rank_of = {t: i for i, t in enumerate(ranks.tokens)}
    assert B.merge(b"aaaab", rank_of) == [256, 256, 98]
    assert B.merge_together([b"aaaab"], B.Pairs(ranks))[0].tolist() == [256, 256, 98]
    assert B.merge(b"aaaaab", rank_of) == [256, 256, 257]


def test_a_text_over_the_step_length(spark, monkeypatch):
    text = "some words of a long text " * 4000
    monkeypatch.setattr(B, "_LONG", 1000)
    encoder = B._Encoder(RANKS)
    import numpy as np

    assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == PUBLIC.encode_ordinary(text)


def test_forgotten_matches_are_merged_again(monkeypatch):
    import numpy as np

    monkeypatch.setattr(B, "_REMEMBERED", 20)
    encoder = B._Encoder(RANKS)
    texts = random_texts(30) * 2
    for text in texts:
        assert np.frombuffer(encoder.encode([text])[0], np.int32).tolist() == PUBLIC.encode_ordinary(text)


def test_other_columns_stay_and_clashing_ones_go(spark):
    rows = spark.createDataFrame([(1, "a b", "old", "x")], "doc_id long, text string, IDS string, decoded string")
    out = B.decode(B.encode(rows, RANKS), RANKS)
    assert out.columns == ["doc_id", "ids", "decoded"] and bytes(out.first()["decoded"]) == b"a b"
    assert B.encode(rows.limit(0), RANKS).count() == 0
    none = spark.createDataFrame([(1, None)], "k int, ids array<int>")
    assert B.decode(none, RANKS).first()["decoded"] is None


def test_ranks_are_checked(tmp_path):
    import base64

    file = tmp_path / "ranks"
    file.write_bytes(b"".join(base64.b64encode(bytes([b])) + f" {b + 1}\n".encode() for b in range(256)))
    with pytest.raises(ValueError):
        B.load(str(file), ".")
