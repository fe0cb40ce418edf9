import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from jobweave.llm import near_copies, simhash
from jobweave.llm.common import table

SF = "/root/testdata/sf0.001"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def print_by_hand(text, k=3):
    w = words(text)
    shingles = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in combinations(nodes, 2):
        if linked(a, b):
            x, y = sorted((top(a), top(b)))
            parent[y] = x
    return {n: top(n) for n in nodes}


TEXTS = ["", " \t\n", "One", "one", "Ünï ÇA", "a b c", "A B C", "a b c d", "a b c d e f g " * 40, "x\x1cy z", "a b c d"]


def test_fingerprints(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "doc_id long, text string")
    for row in simhash.fingerprints(df).collect():
        assert row["simhash"] % (1 << 64) == print_by_hand(row["text"])
    long = "word%d " * 3
    text = " ".join(f"w{i % 977}" for i in range(1_200_000))
    assert int.from_bytes(simhash.simhash(text[:30_000].encode()), "big") == print_by_hand(text[:30_000])
    blocks = b"".join(simhash.shingle_hashes(text.encode(), 3))
    assert len(blocks) == 8 * (1_200_000 - 2) and long


def test_documents_like_brute_force(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").unionByName(
        spark.createDataFrame([(5000 + i, t) for i, t in enumerate([*TEXTS, None, None])], "doc_id long, text string"))
    prints = {r["doc_id"]: print_by_hand(r["text"]) for r in docs.collect()}
    wanted = groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    got = simhash.near_duplicates(docs).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == wanted
    assert all(r["fingerprint"] == f"{prints[r['doc_id']]:016x}" for r in got)


@pytest.mark.parametrize("tree", [2, 8, 8192])
def test_links_of_close_fingerprints(spark, tree):
    rng = np.random.default_rng(tree)
    values = []
    for _ in range(6):
        base = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(20):
            value = base
            for bit in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                value ^= 1 << bit
            values.append(value - (1 << 64) if value >> 63 else value)
    values = sorted(set(values))
    links = simhash.links(spark.createDataFrame([(v,) for v in values], "simhash long"), 3, tree).collect()
    near = lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 3
    pairs = {frozenset((r["a"], r["b"])) for r in links}
    assert groups(values, near) == groups(values, lambda a, b: frozenset((a, b)) in pairs)


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "lone words here now"), (7, "lone words here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("simhash", F.lit(1))
    got = sorted((str(r["doc_id"]), r["component_id"]) for r in simhash.near_duplicates(df).collect())
    assert got == [("1", 1), ("1", 1), ("7", 7), ("None", 1), ("None", 7)]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def similar(a, b):
    def sets(t):
        w = words(t)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())

    x, y = sets(a), sets(b)
    return len(x & y) >= 0.8 * len(x | y)


@pytest.mark.parametrize("listed", [2, 64])
def test_near_copies_like_brute_force(spark, listed, monkeypatch):
    monkeypatch.setattr(near_copies, "LISTED", listed)
    monkeypatch.setattr(near_copies, "BLOCK", 3)
    rng = np.random.default_rng(5)
    texts = []
    for base in range(6):
        original = [f"b{base}w{i}" for i in rng.integers(0, 500, 60)]
        for _ in range(8):
            copy = list(original)
            for place in rng.integers(0, 60, rng.integers(0, 5)):
                copy[place] = f"x{rng.integers(0, 10**6)}"
            texts.append(" ".join(copy))
    texts += ["", "  ", None, "short", "short", "other"]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, _key string")
    wanted = groups(range(len(texts)), lambda a, b: similar(texts[a], texts[b]))
    kept = near_copies.one_of_each(df)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({v for v in wanted.values()})
    again = near_copies.one_of_each(df.unionByName(df))
    assert again.count() == len(set(wanted.values()))
    assert near_copies.one_of_each(df.limit(0)).count() == 0


@pytest.mark.parametrize("listed", [2, 64])
def test_repeated_shingles_do_not_part_near_copies(spark, listed, monkeypatch):
    """The fingerprint of a text with a shingle that comes often is far from its copy's; the sets are nearly equal."""
    monkeypatch.setattr(near_copies, "LISTED", listed)
    rng = np.random.default_rng(9)
    texts = []
    for _ in range(4):
        text = " ".join(f"w{i}" for i in rng.integers(0, 10**6, 404))
        texts += [text, text + " na" * 60, text + " na" * 61]
    assert all(similar(texts[i], texts[i + 1]) for i in range(0, 12, 3))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.one_of_each(df).collect()) == [0, 3, 6, 9]


@pytest.mark.parametrize("listed", [2, 64])
def test_fingerprints_turn_no_pair_down(spark, listed, monkeypatch):
    monkeypatch.setattr(near_copies, "LISTED", listed)
    rng = np.random.default_rng(10)
    original = [f"w{i}" for i in rng.integers(0, 10**6, 300)]
    texts = [" ".join([*original, *(f"x{copy}y{i}" for i in range(10))]) for copy in range(4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = near_copies.one_of_each(df, near_copies.Settings(radius=0))
    assert [r["doc_id"] for r in kept.collect()] == [0]


def test_trees_find_near_copies_before_bands(spark, monkeypatch):
    """Fingerprints within the bits are linked by BK-trees over all texts, also where no band brings a pair together."""
    def none(batches):
        for _ in batches:
            yield from ()

    monkeypatch.setattr(near_copies, "_pairs", none)
    rng = np.random.default_rng(12)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 10**6, 2000)) for _ in range(5)]
    texts += [t + " once more" for t in texts[:3]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in near_copies.one_of_each(df).collect()) == [0, 1, 2, 3, 4]
    prints = spark.createDataFrame([(1, 0), (2, 0), (3, 7), (4, 15), (5, 1 << 40)], "key long, simhash long")
    linked = near_copies.connected_components(near_copies._close(prints, 3)).collect()
    assert {(r["node"], r["root"]) for r in linked} == {(n, 1) for n in (1, 2, 3, 4, 5)}
