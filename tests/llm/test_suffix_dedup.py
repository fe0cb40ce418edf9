import random
from collections import Counter

import pytest

from jobweave.llm import suffix_dedup

LENGTH = 64


def by_hand(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not before for before, g in zip([False, *gone], gone))
        out.append((len(b), sum(gone), spans, kept))
    return out


def texts():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(1, 9)))
    fresh = lambda n: "".join(word() + str(rng.random()) for _ in range(n))
    passages = ["".join(word() for _ in range(n)) for n in (11, 14, 20, 60)]
    exact = "x".join(str(rng.random()) for _ in range(9))[:LENGTH]
    found = [fresh(3) + rng.choice(passages) + fresh(2) + rng.choice(passages)[rng.randint(0, 9) :] for _ in range(40)]
    found += [f"{fresh(1)}{exact}{fresh(1)}", f"{fresh(1)}{exact}", exact[:-1] + "#" + fresh(2)]
    found += [fresh(9)] * 3 + ["", None, "short", "short", "z" * 63, "z" * 64, "y" * 65, "ab" * 300, fresh(4) + "z" * 200]
    return found


@pytest.mark.parametrize("group", [1, 4096])
def test_like_brute_force(spark, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rows = texts()
    df = spark.createDataFrame(
        [(i if i % 9 else None, t, "n_bytes") for i, t in enumerate(rows)], "doc_id long, text string, k1 string")
    got = suffix_dedup.remove_repeats(df.repartition(5), LENGTH).collect()
    wanted = sorted((str(i if i % 9 else None), *w) for i, w in enumerate(by_hand(rows, LENGTH)))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got) == wanted


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(empty).count() == 0
    long = "".join(chr(97 + (i * i) % 26) for i in range(700_000))
    df = spark.createDataFrame([(1, long)], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(df).first()["n_removed"] == by_hand([long[:52]], 400)[0][1] + 700_000
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(empty, 10)
