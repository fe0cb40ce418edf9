import numpy as np
import pytest
from pyspark.sql import functions as F

from jobweave.llm import ann, embedding_dedup
from jobweave.llm.vectors import usable

SCHEMA = "vec_id long, embedding array<float>, label string, name string"
BAD = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7, [1.0, 2.0]]


def points(n=300, clumps=3, size=40, dimension=8, seed=1):
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(dimension) * rng.uniform(0.5, 2) for _ in range(n)]
    for _ in range(clumps):
        center = rng.standard_normal(dimension)
        rows += [center + 0.15 * rng.standard_normal(dimension) for _ in range(size)]
    rows += [rows[0], rows[0], rows[1] * 3.0]
    return np.array(rows, dtype=np.float32)


def frame(spark, vectors, bad=True):
    rows = [(i, v.tolist(), "x", "y") for i, v in enumerate(vectors)]
    if bad:
        rows += [(10_000 + i, v, "x", "y") for i, v in enumerate(BAD)]
    return spark.createDataFrame(rows, SCHEMA)


def test_usable(spark):
    df = frame(spark, points(5, 0), bad=True)
    assert {r["vec_id"] for r in usable(df).collect()} == set(range(8))


@pytest.mark.parametrize("rows,columns", [(4096, 16), (16, 3)])
def test_nearest_neighbours(spark, rows, columns):
    vectors = points()
    exact = vectors.astype(np.float64)
    df = frame(spark, vectors)
    settings = ann.Settings(rows=rows, columns=columns, sample=200, audited=20)
    asked = df.where(F.col("vec_id") % 7 == 0)
    found = {}
    for r in ann.search(df, asked, 10, settings).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    wanted = [i for i in range(len(vectors)) if i % 7 == 0]
    assert sorted(found) == wanted
    for q in wanted:
        score = exact @ exact[q]
        true = sorted((-score[i], i) for i in range(len(exact)) if i != q)[:10]
        got = found[q]
        assert [g[0] for g in got] == list(range(1, 11))
        assert [(-g[2], g[1]) for g in got] == sorted((-g[2], g[1]) for g in got)
        assert all(g[2] == pytest.approx(score[g[1]], abs=1e-12) for g in got)
        hits += len({g[1] for g in got} & {i for _, i in true})
    assert hits / (10 * len(wanted)) >= 0.9


def test_few_candidates_and_empty_tables(spark):
    df = frame(spark, points(4, 0))
    got = ann.search(df, df.where("vec_id = 0"), 20).collect()
    assert len(got) == 6 and all(r["vec_id"] != 0 for r in got)
    assert ann.search(df.limit(0), df, 20).count() == 0
    assert ann.search(df, df.limit(0), 20).count() == 0
    assert ann.search(df, df.where("vec_id >= 10000"), 20).count() == 0


def links_by_hand(vectors, threshold):
    unit = vectors.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    parent = list(range(len(vectors)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in zip(*np.nonzero(near)):
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    return near.sum(axis=1), [top(i) for i in range(len(vectors))]


@pytest.mark.parametrize("block", [1024, 7])
def test_near_duplicate_vectors(spark, block):
    vectors = points()
    settings = embedding_dedup.Settings(width=4, widest=8, tables=3, bucket=40, block=block)
    got = {r["vec_id"]: r for r in embedding_dedup.link_vectors(frame(spark, vectors), 0.9, settings).collect()}
    links, roots = links_by_hand(vectors, 0.9)
    assert len(got) == len(vectors) + len(BAD)
    found = sum(got[i]["n_links"] for i in range(len(vectors)))
    assert all(got[i]["n_links"] <= links[i] for i in range(len(vectors)))  # none below the threshold
    assert found >= 0.98 * links.sum()
    assert sum(got[i]["component_id"] == roots[i] for i in range(len(vectors))) >= 0.98 * len(vectors)
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
    for i in range(len(BAD)):
        assert (got[10_000 + i]["n_links"], got[10_000 + i]["component_id"]) == (0, 10_000 + i)


def test_no_vectors_and_repeated_ids(spark):
    df = frame(spark, points(3, 0))
    assert embedding_dedup.link_vectors(df.limit(0)).count() == 0
    assert {r["n_links"] for r in embedding_dedup.link_vectors(df.where("vec_id >= 10000")).collect()} == {0}
    rows = [(5, [1.0, 0.0], "", ""), (5, [1.0, 0.0], "", ""), (None, [1.0, 0.0], "", ""), (9, [0.0, 1.0], "", "")]
    got = embedding_dedup.link_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"], r["kept"]) for r in got) == [
        ("5", 2, 5, True), ("5", 2, 5, True), ("9", 0, 9, True), ("None", 2, 5, False)]


def scattered_pairs(n, pairs, cosine=0.91, dimension=64, seed=3):
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, dimension))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    for i in range(pairs):
        aside = rows[2 * i + 1] - (rows[2 * i + 1] @ rows[2 * i]) * rows[2 * i]
        rows[2 * i + 1] = cosine * rows[2 * i] + np.sqrt(1 - cosine**2) * aside / np.linalg.norm(aside)
    return rows.astype(np.float32)


def test_few_links_in_a_large_table(spark):
    """A small sample has no link at all, which says nothing about the search."""
    vectors = scattered_pairs(3000, 40)
    settings = embedding_dedup.Settings(bucket=8, audited=16)
    got = embedding_dedup.link_vectors(frame(spark, vectors, bad=False), 0.9, settings)
    assert {r["vec_id"]: r["component_id"] for r in got.where("n_links > 0").collect()} == {
        i: i - i % 2 for i in range(80)}


def test_search_that_falls_short_fails_with_the_figure(spark):
    settings = embedding_dedup.Settings(bucket=8, audited=64, evidence=3, audits=1, recall=1.01)
    with pytest.raises(RuntimeError, match=r"partitions the search reaches [01]\.\d+ of"):
        embedding_dedup.link_vectors(frame(spark, scattered_pairs(400, 100), bad=False), 0.9, settings)


@pytest.mark.parametrize("n,probability", [(5_000, 0.98), (200_000, 0.98), (1_000_000, 0.98)])
def test_partitions_follow_the_size(n, probability):
    settings = embedding_dedup.Settings()
    planes = int(np.ceil(np.log2(n / settings.bucket)))
    share = (1 - np.arccos(0.9) / np.pi) ** planes
    assert 1 - (1 - share) ** embedding_dedup.partitions(n, 0.9, settings) >= probability


@pytest.mark.parametrize("audited", [512, 20])
def test_clusters_wider_than_a_list(spark, audited):
    """Lists hold only members of the own cluster; the links between the clusters count all the same."""
    rng = np.random.default_rng(4)
    centers = scattered_pairs(2, 1, cosine=0.95).astype(np.float64)
    noise = rng.standard_normal((200, 64)) * np.sqrt(0.01 / 64)
    vectors = (np.repeat(centers, 100, axis=0) + noise).astype(np.float32)
    links, roots = links_by_hand(vectors, 0.9)
    assert set(links) == {199} and set(roots) == {0}
    settings = embedding_dedup.Settings(audited=audited, evidence=10)
    got = embedding_dedup.link_vectors(frame(spark, vectors, bad=False), 0.9, settings).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(199, 0)}
