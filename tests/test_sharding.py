import pytest

from jobweave.operators.sharding import contiguous_shards, hash_shard
from pyspark.sql import functions as F


def expected(n, shards=3):
    size = n // shards
    return [shards if size == 0 else min(shards, i // size + 1) for i in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 10, 11, 100])
def test_sizes(spark, n):
    df = spark.createDataFrame([(f"{i:03d}", i) for i in reversed(range(n))], "id string, i int")
    got = [r["shard"] for r in contiguous_shards(df, 3, ["id"]).orderBy("id").collect()]
    assert got == expected(n)


def test_repeated_keys_and_copies(spark):
    values = ["a"] * 50 + ["b"] * 7 + [None] * 3
    df = spark.createDataFrame([(v, "same") for v in values], "id string, text string").repartition(4)
    cut = contiguous_shards(df, 4, ["id"])
    sizes = {r["shard"]: r["count"] for r in cut.groupBy("shard").count().collect()}
    assert sizes == {1: 15, 2: 15, 3: 15, 4: 15}
    spans = cut.groupBy("shard").agg(F.min("id").alias("a"), F.max("id").alias("b")).orderBy("shard").collect()
    assert [(r["a"], r["b"]) for r in spans] == [("a", "a")] * 3 + [("a", "b")]
    assert cut.groupBy("id").count().orderBy("id").collect()[0]["count"] == 3


def test_repeated_keys_with_different_rows(spark):
    df = spark.createDataFrame([("a", str(i)) for i in range(30)], "id string, text string")
    cut = contiguous_shards(df, 3, ["id"])
    assert sorted(r["count"] for r in cut.groupBy("shard").count().collect()) == [10, 10, 10]
    assert cut.select("text").distinct().count() == 30


def test_hash_shards_cover_every_row(spark):
    df = spark.range(1000).withColumn("shard", hash_shard(F.col("id"), 3))
    counts = {r["shard"]: r["count"] for r in df.groupBy("shard").count().collect()}
    assert set(counts) == {1, 2, 3} and sum(counts.values()) == 1000


def test_wide_rows_are_not_shuffled(spark):
    df = spark.range(100).withColumn("text", F.lit("x"))
    plan = contiguous_shards(df, 3, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_shards_by_position(spark, tmp_path):
    from jobweave.operators.sharding import position_shards
    from jobweave.sources.tables import read_stage

    path = str(tmp_path / "t")
    rows = [(i, "en" if i % 3 else "de") for i in range(50)]
    spark.createDataFrame(rows, "id int, lang string").repartition(4, "id").write.partitionBy("lang").parquet(path)
    stored = spark.read.parquet(path).select("id", "lang", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("r"))
    placed = [(r["id"], r["lang"]) for r in sorted(stored.collect(), key=lambda r: (r["f"].rpartition("/")[0], r["f"], r["r"]))]
    for languages in (None, ["en"]):
        wanted = [i for i, lang in placed if not languages or lang in languages]
        for shards in (1, 3, 7, 60):
            size = len(wanted) // shards
            cut = position_shards(read_stage(spark, path, languages), shards)
            assert cut.columns == ["id", "lang", "shard"]
            found = {r["id"]: r["shard"] for r in cut.collect()}
            assert found == {i: min(k // size + 1, shards) if size else shards for k, i in enumerate(wanted)}
            plan = cut._jdf.queryExecution().executedPlan().toString()
            assert "Sort" not in plan and plan.count("Exchange") == plan.count("BroadcastExchange")
    assert position_shards(read_stage(spark, path, ["xx"]), 3).count() == 0
