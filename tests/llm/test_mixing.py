from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from jobweave.llm.mixing import Mix, mix, numbered, shuffled

SCHEMA = "doc_id long, source string, text string, size int, target string"


def documents(spark):
    rows = []
    for i in range(600):
        source = ["b", "a", "é", None][i % 4] if i % 3 else "hot"
        rows.append((i, source, " ".join(["w"] * ((i * 7919) % 40)), 0, "clash"))
    rows += [(9000, "z", None, 0, ""), (9001, "z", "  \t\n", 0, ""), (None, "b", "x y", 0, ""), (5, "b", "same id", 0, "")]
    rows += [(9002, "a", "one two", 0, "")] * 3
    return spark.createDataFrame(rows, SCHEMA)


def targets_by_hand(sizes, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        level = (total - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in order if s not in capped)
        above = {s for s in order if s not in capped and level * weight[s] > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= above


def test_targets_and_takes(spark):
    rows = mix(documents(spark)).collect()
    assert len(rows) == 607
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r["size"] == len((r["text"] or "").split())
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * len(r["draws"])
        assert len(r["draws"]) <= 2 and all(0 <= s < 8 for s in r["draws"])
    wanted = targets_by_hand(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= 3, source


def test_reruns_and_order_agree(spark):
    draws = lambda df: sorted((str(r["doc_id"]), r["text"] or "", tuple(r["draws"])) for r in mix(df).collect())
    docs = documents(spark)
    assert draws(docs) == draws(docs.repartition(7, "text"))


def test_shards_get_even_numbers_of_blocks(spark):
    docs = documents(spark)
    plan = Mix(blocks=64, shards=5)
    per_shard = defaultdict(set)
    for r in mix(docs, plan).withColumn("draw", F.explode("draws")).collect():
        per_shard[r["draw"]].add((r["source"], r["doc_id"]))
    assert set(per_shard) == set(range(5))
    out = shuffled(mix(docs, plan))
    assert out.count() == sum(len(r["draws"]) for r in mix(docs, plan).collect())


def test_edges(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    blank = mix(spark.createDataFrame([(1, "a", None, 0, ""), (2, None, "", 0, "")], SCHEMA)).collect()
    assert [r["target"] for r in blank] == [0.0, 0.0]


def test_numbered(spark):
    rows = numbered(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")), ["v"]).collect()
    assert sorted((r["v"], r["place"]) for r in rows) == [(i, i) for i in range(1000)]
