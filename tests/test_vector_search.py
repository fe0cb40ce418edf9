import numpy as np
import pytest
from pyspark.sql import functions as F

from jobweave.operators import vector_search as V

SCHEMA = "n string, v array<double>"


def made(seed, rows, dimensions=16, groups=12):
    """Vectors around some centres, as embeddings lie."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dimensions))
    return centres[rng.integers(0, groups, rows)] + 0.4 * rng.normal(size=(rows, dimensions))


def sides(spark, queries, corpus, metric="cosine"):
    q = spark.createDataFrame([(f"q{i:04}", v.tolist() if v is not None else None) for i, v in enumerate(queries)], SCHEMA)
    c = spark.createDataFrame([(f"c{i:04}", v.tolist() if v is not None else None) for i, v in enumerate(corpus)], SCHEMA)
    return V.sides(q, {"hits": F.col("v")}, c, "v", "n", metric=metric)


def brute(queries, corpus, k, metric):
    q, c = np.array(queries), np.array(corpus)
    if metric == "cosine":
        q, c = (x / np.where((n := np.linalg.norm(x, axis=1, keepdims=True)) == 0, 1, n) for x in (q, c))
    scores = np.round(q @ c.T, 6) + 0.0
    return {f"q{i:04}": [(f"c{j:04}", row[j]) for j in np.argsort(-row, kind="stable")[:k]] for i, row in enumerate(scores)}


def hits(found):
    return {r["n"]: None if r["hits"] is None else [(h["n"], h["score"]) for h in r["hits"]] for r in found.collect()}


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("cell_values", [16, 500, V.CELL_VALUES])
def test_blocks_find_what_comparing_all_finds(spark, metric, cell_values):
    queries, corpus = made(1, 30), np.vstack([made(1, 40), np.zeros((1, 16)), made(1, 40)[:5]])  # with ties
    found = hits(V.top_k_blocks(sides(spark, queries, corpus, metric), k=4, cell_values=cell_values))
    wanted = brute(queries, corpus, 4, metric)
    for name, some in wanted.items():
        assert [h[0] for h in found[name]] == [h[0] for h in some]
        assert np.allclose([h[1] for h in found[name]], [h[1] for h in some], atol=2e-6)


def test_missing_vectors_and_empty_tables(spark):
    some = made(2, 3)
    assert hits(V.top_k_blocks(sides(spark, [some[0], None], [None, some[1]])))["q0001"] is None
    assert [h[0] for h in hits(V.top_k_blocks(sides(spark, [some[0]], [None, some[1]])))["q0000"]] == ["c0001"]
    assert hits(V.top_k_blocks(sides(spark, some, []))) == {f"q000{i}": [] for i in range(3)}
    assert hits(V.top_k_blocks(sides(spark, [], some))) == {}
    assert hits(V.top_k_hashed(sides(spark, some, []))[0]) == {f"q000{i}": [] for i in range(3)}
    for metric in ("cosine", "dot"):
        both = sides(spark, some, some[:0], metric)
        books = V.fit(both)
        assert hits(V.top_k_compressed(both, books, V.compress(both, books))) == {f"q000{i}": [] for i in range(3)}


def test_repeated_rows_are_hits_of_their_own(spark):
    vector = made(3, 1)[0]
    found = hits(V.top_k_blocks(sides(spark, [vector], [vector] * 7), k=5, cell_values=32))
    assert found["q0000"] == [(f"c000{i}", 1.0) for i in range(5)]


def test_hashing_reaches_its_recall_with_exact_scores(spark):
    queries, corpus = made(4, 60), made(4, 1500)
    both = sides(spark, queries, corpus)
    found, audited = V.top_k_hashed(both, k=5, hashing=V.Hashing(rows=64, audited=60))
    found, wanted = hits(found), brute(queries, corpus, 5, "cosine")
    right = sum(score >= wanted[n][-1][1] - 2e-6 for n, some in found.items() for _, score in some)
    assert audited >= 0.95 and right / 300 >= 0.95
    exact = brute(queries, corpus, 1500, "cosine")
    assert all(abs(dict(exact[n])[name] - score) < 2e-6 for n, some in found.items() for name, score in some)


def test_a_bucket_that_holds_most_rows_is_cut(spark):
    same = np.tile(made(5, 1), (300, 1)) + 1e-3 * made(6, 300)
    queries = same[:20]
    both = sides(spark, queries, same)
    placed = V._keyed(both).withColumn("bucket", F.lit(7).cast("long"))
    asked = both.wanted.withColumn("bucket", F.lit(7).cast("long"))
    from functools import partial

    found = V._merged(V._in_cells(asked, placed, 16, partial(V._search, k=3, metric="cosine"), 16 * 20), 3)
    exact = V.exact_hits(both, 3)
    assert sorted(map(tuple, found.select("_q", "_place", "score").collect())) == sorted(
        map(tuple, exact.select("_q", "_place", "score").collect()))


def test_compressed_vectors_find_nearly_all(spark):
    queries, corpus = made(7, 50, 18), made(7, 1200, 18)  # 18 dimensions are no multiple of the width
    both = sides(spark, queries, corpus)
    books = V.fit(both)
    codes = V.compress(both, books)
    assert books.bytes_per_vector == 5 and codes.count() == 1200
    found, wanted = hits(V.top_k_compressed(both, books, codes, k=5)), brute(queries, corpus, 5, "cosine")
    right = sum(score >= wanted[n][-1][1] - 2e-6 for n, some in found.items() for _, score in some)
    assert right / 250 >= 0.95


def test_probes_are_the_nearest_buckets():
    import pyarrow as pa

    class Shared:
        value = np.eye(6)[None]  # one table whose planes are the axes

    vector = np.array([0.9, -0.1, 0.2, -0.8, 0.7, -0.6])
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([vector.tolist()])], names=["_q", "vec"])
    own = sum(1 << i for i, x in enumerate(vector) if x > 0)
    for probes in (1, 2, 4, 64):
        found = [b for out in V._hash(iter([batch]), Shared, probes) for b in out.column("bucket").to_pylist()]
        cost = sorted((sum(vector[i] ** 2 for i in range(6) if (own ^ b) >> i & 1), b) for b in range(64))
        assert len(found) == probes and set(found) == {b for _, b in cost[:probes]}


def test_best_pairs_are_the_best_columns():
    from jobweave.operators.similarity import best_columns, best_pairs

    rng = np.random.default_rng(8)
    for rows, n, k, digits in ((0, 300, 2, 3), (5, 1, 3, 3), (7, 63, 5, 1), (9, 640, 5, 2), (9, 700, 9, 7), (4, 900, 20, 0)):
        scores = np.round(rng.normal(size=(rows, n)), digits)
        rounded, picks = best_columns(scores, k)
        wanted = [(i, c, rounded[i, c]) for i, pick in enumerate(picks) for c in pick]
        assert list(zip(*(x.tolist() for x in best_pairs(scores, k)))) == wanted


def test_vectors_in_no_groups_are_compared_in_blocks(spark, monkeypatch):
    probed = []
    hashed = V._bucketed
    monkeypatch.setattr(V, "_bucketed", lambda rows, columns, shared, probes: probed.append(probes) or hashed(rows, columns, shared, probes))
    corpus = np.random.default_rng(9).normal(size=(900, 32))
    found, audited = V.top_k_hashed(sides(spark, corpus[:40], corpus), k=4, hashing=V.Hashing(rows=4, buckets=24))
    assert audited == 1.0 and max(probed) == 4
    assert {n: [h[0] for h in some] for n, some in hits(found).items()} == {
        n: [h[0] for h in some] for n, some in brute(corpus[:40], corpus, 4, "cosine").items()}


def test_queries_are_cut_by_the_work_of_a_cell(spark, monkeypatch):
    monkeypatch.setattr(V, "_CELL_WORK", 16 * 100 * 10)
    both = sides(spark, made(1, 60), made(1, 100))
    found = V._in_cells(both.wanted, V._keyed(both), 16, counted_cells(), V.CELL_VALUES)
    assert 1 < found.agg(F.max("_c")).first()[0] < 30


def counted_cells():
    """A search that finds how many queries a cell has."""
    def search(corpus):
        import pyarrow as pa

        seen = [0]

        def ready(some):
            seen[0] += some.num_rows
            yield pa.RecordBatch.from_arrays(
                [some.column("_c").slice(0, 1), some.column("field").slice(0, 1), pa.array([seen[0]]), pa.array([""]), pa.array([0.0])],
                names=["_q", "field", "_c", "_key", "score"])

        return ready

    return search


def test_decoded_vectors_score_as_the_looked_up_parts():
    rng = np.random.default_rng(10)
    books = V.Codebooks(rng.normal(size=(3, 256, 4)), 10, "dot")
    codes = rng.integers(0, 256, (50, 3)).astype(np.uint8)
    queries = rng.normal(size=(6, 10))
    parts = np.pad(queries, ((0, 0), (0, 2))).reshape(6, 3, 4)
    wanted = sum((parts[:, p] @ books.centres[p].T)[:, codes[:, p]] for p in range(3))
    assert np.allclose(queries @ books.decode(codes).T, wanted)


@pytest.mark.parametrize("metric", ["cosine", "dot"])
def test_tiles_find_the_best_pairs(metric, monkeypatch):
    from jobweave.operators.similarity import best_pairs, unit_rows

    monkeypatch.setattr(V, "_TILE", 64)
    rng = np.random.default_rng(11)
    rows = np.vstack([rng.normal(size=(700, 10)), np.zeros((3, 10)), np.tile(rng.normal(size=(1, 10)), (300, 1)), rng.integers(-1, 2, (400, 10))])
    rows = rows[rng.permutation(len(rows))] * (1 if metric == "cosine" else 30)
    unit = unit_rows if metric == "cosine" else np.asarray
    queries = unit(np.vstack([rows[::7], 1e-3 * rng.normal(size=(9, 10))]))
    codes = rng.integers(0, 256, (900, 3)).astype(np.uint8)
    books = V.Codebooks(rng.normal(size=(3, 256, 4)).round(1), 10, metric)
    for side, matrix in ((V._Vectors(rows.astype(float), metric).roughly(), unit(rows)), (V._Codes(codes, books), books.decode(codes))):
        for k in (1, 5, 70, 2000):
            found, wanted = V.best_rows(queries, side, k), best_pairs(np.round(queries @ matrix.T, 6), k)
            assert all(np.array_equal(x, y) for x, y in zip(found[:2], wanted)) and np.allclose(found[2], wanted[2], atol=2e-6)


def test_tiles_leave_odd_vectors_to_the_slow_way():
    rows = np.random.default_rng(12).normal(size=(90, 6))
    queries = rows[:4].copy()
    queries[1, 2], queries[2] = np.nan, 1e200
    for side in (V._Vectors(rows, "dot").roughly(), V._Vectors(rows * 1e50, "dot").roughly()):
        row, column, _ = V.best_rows(queries, side, 3)
        for i in (0, 2, 3):
            assert column[row == i].tolist() == np.argsort(-(side[:] @ queries[i]), kind="stable")[:3].tolist()
        assert 1 not in row


def test_candidates_are_one_row_a_query(spark, monkeypatch):
    """They were a row each, and carried both vectors to be compared."""
    kept, stored = {}, V.materialise
    monkeypatch.setattr(V, "materialise", lambda df, name: kept.setdefault(name, stored(df, name)))
    both = sides(spark, made(13, 40), made(13, 600))
    books = V.fit(both)
    hits(V.top_k_compressed(both, books, V.compress(both, books)))
    near = kept["near"].collect()
    assert len(near) == 40 and all(len(set(r["near"])) == 100 for r in near)


def test_cells_of_codes_change_no_hit(spark):
    both = sides(spark, made(14, 30, 18), np.vstack([made(14, 300, 18)] * 2))  # each row twice
    books = V.fit(both)
    codes = V.compress(both, books)
    whole = hits(V.top_k_compressed(both, books, codes, k=4))
    assert hits(V.top_k_compressed(both, books, codes, k=4, cell_values=900)) == whole
    exact = brute(made(14, 30, 18), np.vstack([made(14, 300, 18)] * 2), 4, "cosine")
    assert sum(a[0] == b[0] for n in exact for a, b in zip(whole[n], exact[n])) >= 0.9 * 30 * 4


def test_codes_of_rows_that_are_gone_are_passed_over(spark):
    both = sides(spark, made(16, 5), made(16, 50))
    books = V.fit(both)
    codes = V.compress(both, books)
    wanted = hits(V.top_k_compressed(both, books, codes, k=3))
    more = codes.unionByName(codes.withColumn("_c", F.col("_c") + (1 << 50)))
    assert hits(V.top_k_compressed(both, books, more, k=3)) == wanted


def test_ties_go_to_the_smaller_key_of_any_kind(spark):
    vectors = np.tile(made(15, 3), (20, 1))
    for kind in ("long", "string", "double", "decimal(9,2)"):
        q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors[:3])], "n int, v array<double>")
        c = spark.createDataFrame([(99 - i, v.tolist()) for i, v in enumerate(vectors)], "n int, v array<double>")
        both = V.sides(q, {"hits": F.col("v")}, c.withColumn("n", F.col("n").cast(kind)), "v", "n")
        books = V.fit(both)
        for found in (V.top_k_blocks(both, 4, 160), V.top_k_compressed(both, books, V.compress(both, books), 4, cell_values=160)):
            for r in found.collect():
                assert [float(h["n"]) for h in r["hits"]] == [40 + (2 - r["n"]) + 3 * i for i in range(4)]
