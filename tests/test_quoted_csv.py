import random

import pytest

from jobweave.sources.quoted_csv import read_quoted_csv
from jobweave.sources.tables import read_ads, read_csv_table


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def field(draw):
    kind = draw.randint(0, 7)
    if kind == 0:
        return ""
    if kind == 1:
        return '""'
    text = "".join(draw.choice('ab é,"\n\r;') for _ in range(draw.choice((3, 30, 900))))
    return '"' + text.replace('"', '""') + '"' if kind < 6 else "plain text"


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("last", [True, False])
def test_as_one_task_reads_it(spark, tmp_path, end, last):
    draw = random.Random(7)
    for part in range(2):
        lines = ["id,title,description"] + [f"{part}-{i},{field(draw)},{field(draw)}" for i in range(400)]
        (tmp_path / f"ads-{part}.csv").write_bytes((end.join(lines) + (end if last else "")).encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
        found = rows_of(read_ads(spark, str(tmp_path)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert len(found) == 800
    if end == "\r\n":  # where lines end so, the one task makes newlines of such ends inside fields
        found = sorted((tuple(v and v.replace(end, "\n") for v in row) for row in found), key=repr)
    assert found == rows_of(read_csv_table(spark, str(tmp_path)))


def test_a_record_over_several_splits(spark, tmp_path):
    path = tmp_path / "a.csv"
    text = "\n".join("line %d ""x""" % i for i in range(500))
    path.write_text('id,t\n1,"%s"\n2,b\n' % text.replace('"', '""'))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        found = rows_of(read_quoted_csv(spark, str(path)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [("1", text), ("2", "b")]


def test_broken_files(spark, tmp_path):
    path = tmp_path / "open.csv"
    path.write_text('id,t\n1,"never closed\n2,b\n')
    with pytest.raises(Exception, match="never closed"):
        read_quoted_csv(spark, str(path)).collect()
    path = tmp_path / "fields.csv"
    path.write_text("id,t\n1,b,c\n")
    with pytest.raises(Exception):
        read_quoted_csv(spark, str(path)).collect()
    path = tmp_path / "empty.csv"
    path.write_text("id,t\n")
    assert read_quoted_csv(spark, str(path)).columns == ["id", "t"] and read_quoted_csv(spark, str(path)).count() == 0


def test_the_query_writes_a_file_per_task(spark, tmp_path, monkeypatch):
    from checks import queries

    rows = [(i, f'line "{i}"\nand, more', "en") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(queries, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    monkeypatch.setattr(queries, "read_ads", lambda spark, path: queries.table(spark, str(tmp_path), "documents").withColumnsRenamed(
        {"doc_id": "id", "text": "description"}))
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        queries.quoted_newlines(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(list((tmp_path / "quoted").glob("part-*.csv"))) > 1
