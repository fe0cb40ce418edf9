import glob

import pytest
from pyspark.sql import functions as F

from jobweave.config import Limits
from jobweave.joins import fits_broadcast, lookup_join
from jobweave.operators.coding import apply_overrides
from jobweave.sources.tables import (
    code_table, missing_shards, read_csv_table, read_labels, read_stage, spread, write_stage, write_submission,
)
from jobweave.storage import scratch_path, shared_dir


def test_csv(spark, tmp_path):
    path = tmp_path / "ads.csv"
    path.write_text('id,title,code\n1,"two\nlines",0110\n2,"say ""hi""",NA\n3,,null\n4,"","a,b"\n')
    got = [tuple(r) for r in read_csv_table(spark, str(path)).orderBy("id").collect()]
    assert got == [("1", "two\nlines", "0110"), ("2", 'say "hi"', None), ("3", None, None), ("4", None, "a,b")]
    assert read_csv_table(spark, str(path), limit=2).count() == 2


def test_csv_with_too_many_fields_stops(spark, tmp_path):
    path = tmp_path / "ads.csv"
    path.write_text("id,title\n1,a,b\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_table(spark, str(path)).collect()


def test_label_order(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text("code,label,description\n02,b,x\n0110,a,y\n0110,c,z\n")
    labels = read_labels(spark, str(path))
    assert [r["label"] for r in labels.orderBy("pos").collect()] == ["b", "a", "c"]
    assert [r["code"] for r in code_table(labels).collect()] == ["0110"]


def test_stage_partitions(spark, tmp_path):
    path = str(tmp_path / "stage")
    df = spark.createDataFrame([("1", "en", True), ("2", "fr", False), ("3", "fr", True)], "id string, lang string, codable boolean")
    write_stage(df, path, ["lang", "codable"])
    back = read_stage(spark, path, ["fr"])
    assert "PushedFilters: []" in (plan := back._jdf.queryExecution().executedPlan().toString())
    assert "PartitionFilters: [isnotnull(lang" in plan
    assert {(r["id"], r["codable"]) for r in back.collect()} == {("2", False), ("3", True)}

    moved = spark.createDataFrame([("2", "fr", True), ("3", "fr", True)], "id string, lang string, codable boolean")
    write_stage(moved, path, ["lang", "codable"], replaces=["fr"])
    assert {(r["id"], r["codable"]) for r in read_stage(spark, path).collect()} == {("1", True), ("2", True), ("3", True)}


def test_shards_live_side_by_side(spark, tmp_path):
    path = str(tmp_path / "stage")
    schema = "id string, lang string"

    def write(ids, lang, part, replaces):
        write_stage(spark.createDataFrame([(i, lang) for i in ids], schema), path, ["lang"], part, replaces)

    def stored():
        return sorted(r["id"] for r in read_stage(spark, path).collect())

    for shard, ids in ((1, "ab"), (2, "cd"), (1, "ef")):
        write(ids, "en", (shard, 3), ["en"])
    write("xy", "fr", (1, 1), ["fr"])
    assert stored() == list("cdefxy")
    write("gh", "en", (1, 2), ["en"])  # another number of shards replaces the first
    write("ij", "en", (2, 2), ["en"])
    assert stored() == list("ghijxy")
    write("k", "en", (1, 1), ["en"])
    assert stored() == list("kxy")
    write("", "fr", (1, 1), ["fr"])
    assert stored() == ["k"]


def test_no_row_goes_before_its_successor_is_there(spark, tmp_path):
    path = str(tmp_path / "stage")
    all_ids = [str(i) for i in range(9)]

    def write(ids, part):
        rows = spark.createDataFrame([(i, "en", i in "048") for i in ids], "id string, lang string, done boolean")
        write_stage(rows, path, ["lang", "done"], part, ["en"])

    def stored():
        return sorted(r["id"] for r in read_stage(spark, path).collect())

    write(all_ids, (1, 1))
    assert missing_shards(spark, path, 2) == {}
    for order in ((1, 2, 3), (3, 1, 3, 2)):  # a shard may come twice
        for shard in order:
            write(all_ids[shard - 1 :: 3], (shard, 3))
            assert stored() == all_ids
            if shard != order[-1]:
                assert missing_shards(spark, path, 2) or order[0] == 3
        assert missing_shards(spark, path, 2) == {}
        assert {r["shard"] for r in spark.read.parquet(path).select("shard").distinct().collect()} == {
            "1-of-3", "2-of-3", "3-of-3"}
    for shard in (1, 2, 3, 4):
        write(all_ids[shard::5] if shard < 4 else [], (shard, 4))
        assert stored() == (all_ids if shard < 4 else sorted(all_ids[1::5] + all_ids[2::5] + all_ids[3::5]))
    assert missing_shards(spark, path, 2) == {}  # the fourth has no row, but was written
    write(all_ids[:1], (1, 1))
    assert stored() == all_ids[:1] and missing_shards(spark, path, 2) == {}


def test_shards_written_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "stage")
    rows = spark.createDataFrame([(i, "en") for i in range(30)], "id int, lang string")
    write_stage(rows, path, ["lang"], (1, 1), ["en"])
    with ThreadPoolExecutor(3) as pods:
        list(pods.map(lambda k: write_stage(rows.where(f"id % 3 = {k - 1}"), path, ["lang"], (k, 3), ["en"]), (1, 2, 3)))
    assert sorted(r["id"] for r in read_stage(spark, path).collect()) == list(range(30))


def test_missing_shards_are_named(spark, tmp_path):
    path = str(tmp_path / "stage")
    rows = spark.createDataFrame([(1, "en")], "id int, lang string")
    write_stage(rows, path, ["lang"], (2, 3), ["en"])
    assert missing_shards(spark, path, 1) == {"en": ["1-of-3", "3-of-3"]}


def test_failing_write_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "stage")
    df = spark.createDataFrame([("1", "en"), ("2", "fr")], "id string, lang string")
    write_stage(df, path, ["lang"], replaces=["en", "fr"])
    broken = df.withColumn("id", F.when(F.col("id") == "2", F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        write_stage(broken, path, ["lang"], replaces=["en", "fr"])
    assert {tuple(r) for r in read_stage(spark, path).select("id", "lang").collect()} == {("1", "en"), ("2", "fr")}


def test_null_partition_value(spark, tmp_path):
    path = str(tmp_path / "stage")
    write_stage(spark.createDataFrame([("1", None), ("2", "en")], "id string, lang string"), path, ["lang"])
    assert {(r["id"], r["lang"]) for r in read_stage(spark, path).collect()} == {("1", None), ("2", "en")}


def test_submission_file(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("3", "0110"), ("1", None), ("2", "a,b")], "id string, class_code string")
    write_submission(df, path, "id")
    parts = sorted(glob.glob(path + "/part-*"))
    assert "".join(open(p).read() for p in parts) == '1,\n2,"a,b"\n3,0110\n'


def test_overrides(spark):
    ads = spark.createDataFrame([("1", "a"), ("2", "b"), ("2", "c"), (None, "d")], "id string, description string")
    given = spark.createDataFrame([("2", "new"), ("9", "none")], "id string, description string")
    got = [tuple(r) for r in apply_overrides(ads, given).collect()]
    assert sorted(got, key=str) == sorted([("1", "a"), ("2", "new"), ("2", "new"), (None, "d")], key=str)


def test_salted_lookup_gives_the_same_rows(spark):
    rows = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    tight = Limits(broadcast_rows=5, salts=4)
    assert fits_broadcast(lookup) and not fits_broadcast(lookup, tight)
    for how in ("left", "inner", "left_semi", "left_anti"):
        wide = {tuple(r) for r in lookup_join(rows, lookup, "k", how).select("id", "k").collect()}
        salted = [tuple(r) for r in lookup_join(rows, lookup, "k", how, tight).select("id", "k").collect()]
        assert len(salted) == len(wide) and set(salted) == wide


def test_spread(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).coalesce(1).write.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    assert spread(spark.read.parquet(path)).rdd.getNumPartitions() == cores
    spark.range(0, 100, 1, cores * 2).write.parquet(path + "2")
    assert "Exchange" not in spread(spark.range(0, 9, 1, cores))._jdf.queryExecution().executedPlan().toString()


def test_shared_folder_is_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
