import hashlib

from pyspark.sql import functions as F

from jobweave.llm.sharding import extendible_shards, write_shards


def hash60(key):
    return int(hashlib.md5(("\0" if key is None else str(key)).encode()).hexdigest()[:15], 16)


def split_by_hand(rows, limit):
    """(id, bytes) -> shard, by splitting buckets one bit at a time."""
    open_, done = [("", rows)], {}
    while open_:
        prefix, members = open_.pop()
        if sum(b for _, b in members) <= limit or len({hash60(i) for i, _ in members}) == 1:
            done.update({i: prefix for i, _ in members})
            continue
        for bit in "01":
            inside = [m for m in members if format(hash60(m[0]), "060b")[len(prefix)] == bit]
            if inside:
                open_.append((prefix + bit, inside))
    return done


def test_like_splitting_by_hand(spark):
    rows = [(i, (i * 37) % 50) for i in range(400)] + [(None, 3), (1000, 900)]
    df = spark.createDataFrame([(i, b, "x") for i, b in rows], "doc_id long, b int, shard string")
    for limit in (60, 300, 10**6):
        for bits in (3, 20):
            got = extendible_shards(df, ["doc_id"], F.col("b"), limit, pass_bits=bits).collect()
            wanted = split_by_hand(rows, limit)
            assert len(got) == len(rows)
            for r in got:
                assert r["shard"] == wanted[r["doc_id"]] and r["depth"] == len(r["shard"]) and r["n_bytes"] == r["b"]


def test_hot_key_and_repeated_rows_split(spark):
    rows = [(7, "y" * 10)] * 500 + [(i, "z") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = extendible_shards(df, ["doc_id"], F.octet_length("text"), 200)
    sizes = {r["shard"]: r["n"] for r in got.groupBy("shard").agg(F.sum("n_bytes").alias("n")).collect()}
    assert sum(sizes.values()) == 5100 and max(sizes.values()) <= 200


def test_edges(spark, tmp_path):
    schema = "doc_id long, text string"
    empty = spark.createDataFrame([], schema)
    assert extendible_shards(empty, ["doc_id"], F.octet_length("text"), 10).count() == 0
    one = spark.createDataFrame([(1, "a" * 100), (2, None), (3, "")], schema)
    got = {r["doc_id"]: r for r in extendible_shards(one, ["doc_id"], F.octet_length("text"), 10).collect()}
    assert [got[i]["n_bytes"] for i in (1, 2, 3)] == [100, 0, 0]
    assert got[1]["shard"] not in (got[2]["shard"], got[3]["shard"])
    write_shards(extendible_shards(one, ["doc_id"], F.octet_length("text"), 10), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
