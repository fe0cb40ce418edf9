"""CSV whose quoted fields hold line ends, read by many tasks.

Where a line end lies in a quoted field, a reader that starts in the middle of a file cannot tell. The number of quotes before
it does: it is odd inside a field, and a doubled quote counts twice. So one pass counts the quotes of each split, the parity at a split's start
is that of all before it in its file, and a second pass puts lines together to records, split by split. Only the open ends of splits
have to meet: two short texts for each at most. Spark's own parser reads the records.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from jobweave.joins import fits_broadcast
from jobweave.storage import materialise

_PIECES = "file string, start long, part int, opens boolean, closes boolean, record string"


def read_quoted_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """The records of UTF-8 files with a header line each, every column a string, in as many tasks as the files have splits.

    Quotes are doubled inside quoted fields. Lines end with a newline, or a carriage return before it; inside a field both stay (Spark's
    one-task reader makes a newline of the two, in files whose lines end with both). A record with more or fewer fields than the header stops the job, as does a quote that is never closed. Blank lines are skipped.
    Files may be larger than a task's memory, records may not; rows come in no particular order.
    """
    if schema is None:
        header = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
        schema = StructType([StructField(name, StringType()) for name in header.columns])
    lines = spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"')))
    counts = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = F.sum("quotes").over(
        Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    # A row per split. The lines must stay where they are and in order, so this side is broadcast, or the read fails.
    opened = materialise(counts.select("file", "start", (F.coalesce(before, F.lit(0)) % 2).cast("int").alias("inside")), "csv-splits")
    if not fits_broadcast(opened):
        raise ValueError("too many splits: raise spark.sql.files.maxPartitionBytes")
    placed = lines.join(F.broadcast(opened), ["file", "start"]).select("file", "start", "inside", quotes.alias("quotes"), "value")
    pieces = materialise(placed.mapInArrow(_records, _PIECES), "csv-records")
    whole = pieces.where("opens and closes").select("record")
    ends = pieces.where("not (opens and closes)")
    order = Window.partitionBy("file").orderBy("start", "part")
    joined = ends.withColumn("at", F.sum(F.col("opens").cast("int")).over(order)).groupBy("file", "at").agg(
        F.array_sort(F.collect_list(F.struct("start", "part", "record", "closes"))).alias("parts"))
    closed = F.element_at("parts", -1)["closes"]
    record = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
    stitched = joined.select(
        F.when(closed, record).otherwise(F.raise_error(F.concat(F.lit("a quote is never closed in "), "file"))).alias("record"))
    # A carriage return before the end of a record belongs to the line end.
    records = whole.unionByName(stitched).select(F.regexp_replace("record", r"\r\z", "").alias("record")).where("record <> ''")
    options = {"mode": "FAILFAST", "quote": '"', "escape": '"', "multiLine": "true"}
    parsed = records.select(F.from_csv("record", _ddl(schema), options).alias("r"))
    return parsed.select(*(F.col("r")[name].alias(name) for name in schema.names))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in schema.names)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines put together to records; the open ends of a split are marked, the header of a file is left out.

    ``opens``: the record begins here; ``closes``: it ends here.
    """
    split, inside, part, held, opens, header = None, False, 0, [], True, False
    for batch in batches:
        out: list[tuple] = []
        files, starts = batch.column("file").to_pylist(), batch.column("start").to_numpy()
        odd = batch.column("quotes").to_numpy() % 2 == 1
        values = batch.column("value").to_pylist()
        begins = batch.column("inside").to_numpy()
        for i, value in enumerate(values):
            if split != (files[i], starts[i]):
                if held:
                    out.append((*split, part, opens, False, "\n".join(held)))
                split, part, held = (files[i], int(starts[i])), 0, []
                inside, opens, header = bool(begins[i]), not begins[i], starts[i] == 0
            held.append(value)
            inside = inside != odd[i]
            if not inside:
                if header:
                    header = False
                else:
                    out.append((*split, part, opens, True, "\n".join(held)))
                    part += 1
                held, opens = [], True
        yield _batch(out)
    if held:
        yield _batch([(*split, part, opens, False, "\n".join(held))])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_(), pa.string())
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["file", "start", "part", "opens", "closes", "record"])
