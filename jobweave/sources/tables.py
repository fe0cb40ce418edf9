"""Reading ads and labels, stage tables, the fixed dimensions, and the submission file."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from jobweave import fixed
from jobweave.functions.text import na_to_null
from jobweave.sources.quoted_csv import read_quoted_csv

BOOLEAN_PARTITIONS = ("job_desc_extracted", "codable")


def read_csv_table(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    limit: int | None = None,
    multi_line: bool = True,
    malformed: str = "FAILFAST",
) -> DataFrame:
    """A CSV with a header, every column a string, missing-value texts as null.

    Types are never inferred: a code such as ``0110`` keeps its zero. With quoted newlines Spark reads a
    file in one task: ``read_quoted_csv`` splits it. Set ``multi_line=False`` where no
    field holds a newline. A row with more or fewer fields than the header stops the job;
    ``malformed="PERMISSIVE"`` with ``_corrupt_record`` in ``schema`` keeps such rows there.
    """
    reader = (
        spark.read.option("header", True).option("multiLine", multi_line)
        .option("quote", '"').option("escape", '"').option("inferSchema", False)
        .option("mode", malformed)
    )
    if schema is not None:
        reader = reader.schema(schema)
    table = na_to_null(reader.csv(path))
    return table if limit is None else table.limit(limit)


def read_ads(
    spark: SparkSession, path: str | list[str], limit: int | None = None, **options
) -> DataFrame:
    """The ads, at most the first ``limit`` of them, over all cores.

    Without a limit or other options, files with quoted newlines are read split by split.
    """
    if limit is None and not options:
        return na_to_null(read_quoted_csv(spark, path))
    ads = read_csv_table(spark, path, limit=limit, **options)
    return spread(ads) if limit is None else ads.repartition(spark.sparkContext.defaultParallelism)


def spread(table: DataFrame) -> DataFrame:
    """A scan of few splits over all cores, because the work on its texts is heavy.

    A scan that already has a split per core, as any large table does, is left alone. For
    plain scans only: asking a plan with a shuffle for its partitions would run it.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table


def read_labels(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """The taxonomy, with its load order in ``pos`` (the first row of a code wins)."""
    return read_csv_table(spark, path, **options).withColumn(
        "pos", F.monotonically_increasing_id()
    )


def language_table(spark: SparkSession) -> DataFrame:
    """The 25 languages: ``language, lang, lang_iso_3``."""
    return spark.createDataFrame(
        fixed.LANGUAGES, "language string, lang string, lang_iso_3 string"
    )


def with_language_name(
    df: DataFrame, column: str = "language", lang: str = "lang", iso_3: str | None = None
) -> DataFrame:
    """Add the name of each row's language, and its long code; null for one that is not listed."""
    added = {"language": column} | ({"lang_iso_3": iso_3} if iso_3 else {})
    names = language_table(df.sparkSession).select(
        F.col("lang").alias("_code"), *(F.col(c).alias(name) for c, name in added.items()))
    return df.drop(*added.values()).join(F.broadcast(names), df[lang] == F.col("_code"), "left").drop("_code")


def unlisted_languages(df: DataFrame, lang: str = "lang") -> DataFrame:
    """Rows whose language is not one of the 25."""
    names = language_table(df.sparkSession).select(F.col("lang").alias("_code"))
    return df.join(F.broadcast(names), df[lang] == F.col("_code"), "left_anti")


def code_table(labels: DataFrame) -> DataFrame:
    """The valid codes: the four-digit codes of the taxonomy, each once.

    The coarser levels of a classification have shorter codes and are not valid answers.
    """
    return labels.where(F.rlike("code", F.lit("^[0-9]{4}$"))).select("code").distinct()


def read_stage(
    spark: SparkSession,
    path: str,
    languages: Iterable[str] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """A stage table, only the partitions of the given languages, whatever shards wrote it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    table = reader.parquet(path)
    if languages is not None:
        table = table.where(F.col("lang").isin(list(languages)))
    for name in BOOLEAN_PARTITIONS:
        if name in table.columns:
            table = table.withColumn(name, F.col(name).cast("boolean"))
    return table.drop("shard")


def write_stage(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    part: tuple[int, int] = (1, 1),
    replaces: Iterable[str] = (),
) -> None:
    """Write by partition; partitions not in ``df`` stay, those in it are replaced.

    ``part`` is the shard and the number of shards. It is the last partition level of every
    table, so one language may be written in thirds beside others that are written whole. Where a language is there
    in another number of shards, the new shards wait, unseen by readers, until the last of them is written; then
    they replace the former ones together. Writers of different shards may run at once.

    ``replaces`` names languages whose old rows of this shard go as a whole. A row whose answer
    changes between two runs changes its partition as well, and would otherwise be there twice. A
    shard without a row counts as written for these languages.

    The rows are written aside first and take their places afterwards, so a failing job leaves
    the table as it was. The rebalance step collects each partition value into files of the advisory
    size and splits a heavy value (one language may hold most rows) over many tasks by measured size.
    """
    shard, shards = part
    cols = [*partition_cols, "shard"]
    new = f"{path}/_new-{uuid.uuid4().hex}"
    (
        df.withColumn("shard", F.lit(f"{shard}-of-{shards}")).hint("rebalance", *cols)
        .write.partitionBy(*cols).parquet(new)
    )
    _Places(df.sparkSession, path, len(cols)).settle(new, shard, shards, list(replaces))


class _Places:
    """The partition directories of a stage table. They are only listed and renamed, never read.

    Names that begin with ``_`` are hidden from readers: ``_pending-n`` holds shards of a language that wait for
    the others of their number, ``_shards`` an empty file for each shard that was written, with or without a row.
    """

    def __init__(self, spark: SparkSession, path: str, levels: int):
        self.to_path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.path, self.levels = path, levels
        self.old = f"{path}/_old-{uuid.uuid4().hex}"

    def leaves(self, root: str, language: str = "*=*") -> list[str]:
        """The last partition level below ``root``, as relative paths."""
        return self._names(f"{root}/{language}" + "/*=*" * (self.levels - 1), self.levels)

    def marks(self, root: str, language: str) -> set[str]:
        return {name.split("/")[-1] for name in self._names(f"{root}/_shards/{language}/*", 1)}

    def _names(self, pattern: str, levels: int) -> list[str]:
        found = self.files.globStatus(self.to_path(pattern)) or []
        return ["/".join(status.getPath().toString().split("/")[-levels:]) for status in found]

    def move(self, leaf: str, source: str, root: str) -> None:
        """Moves a leaf, an older one at its place aside. What another writer has moved already is left where it is."""
        place, target = self.to_path(f"{source}/{leaf}"), self.to_path(f"{root}/{leaf}")
        # In this order: a leaf that another writer brings meanwhile is gone from its source.
        if self.files.exists(target) and self.files.exists(place):
            self.move(leaf, root, self.old)
        self.files.mkdirs(target.getParent())
        try:
            moved = self.files.rename(place, target)
        except Py4JJavaError:
            moved = False
        if not moved and self.files.exists(place):
            raise OSError(f"cannot move {place} to {target}")

    def mark(self, root: str, language: str, label: str) -> None:
        self.files.create(self.to_path(f"{root}/_shards/{language}/{label}"), True).close()

    def drop(self, path: str) -> None:
        self.files.delete(self.to_path(path), True)

    def settle(self, new: str, shard: int, shards: int, replaces: list[str]) -> None:
        written = self.leaves(new)
        whole = {f"lang={x}" for x in replaces}
        for language in sorted(whole | {leaf.split("/")[0] for leaf in written}):
            own = [leaf for leaf in written if leaf.split("/")[0] == language]
            self._settle(language, own, new, f"{shard}-of-{shards}", shards, language in whole)
        for rest in (self.old, new):
            self.drop(rest)

    def _settle(self, language: str, written: list[str], new: str, label: str, shards: int, whole: bool) -> None:
        pending = f"{self.path}/_pending-{shards}"
        waits = shards > 1 and bool(self._former(language, written, shards, whole) or self.marks(pending, language))
        root = pending if waits else self.path
        above = {_above(leaf) for leaf in written}
        for leaf in self.leaves(root, language):
            if leaf.endswith(f"shard={label}") and (whole or _above(leaf) in above):
                self.move(leaf, root, self.old)
        if not waits:
            for leaf in self._former(language, written, shards, whole):
                self.move(leaf, self.path, self.old)
        for leaf in written:
            self.move(leaf, new, root)
        self.mark(root, language, label)
        if waits and len(self.marks(root, language)) == shards:
            come = self.leaves(root, language)
            for leaf in self._former(language, come, shards, whole):
                self.move(leaf, self.path, self.old)
            for leaf in come:
                self.move(leaf, root, self.path)
            for done in self.marks(root, language):
                self.mark(self.path, language, done)
            self.drop(f"{root}/_shards/{language}")
        left = {leaf.rpartition("-of-")[2] for leaf in self.leaves(self.path, language)}
        for mark in self.marks(self.path, language):
            if left and mark.rpartition("-of-")[2] not in left:
                self.drop(f"{self.path}/_shards/{language}/{mark}")

    def _former(self, language: str, written: list[str], shards: int, whole: bool) -> list[str]:
        """Leaves in another number of shards that the written ones replace."""
        above = {_above(leaf) for leaf in written}
        return [leaf for leaf in self.leaves(self.path, language)
                if not leaf.endswith(f"-of-{shards}") and (whole or _above(leaf) in above)]


def _above(leaf: str) -> str:
    return leaf.rpartition("/")[0]


def missing_shards(spark: SparkSession, path: str, levels: int) -> dict[str, list[str]]:
    """The shards of each language of a stage table that have not been written yet, where some have.

    ``levels`` counts the partition columns without the shard. Shards that wait for others of their number are named, too.
    """
    places = _Places(spark, path, levels + 1)
    missing: dict[str, set[str]] = {}
    pending = [name for name in places._names(f"{path}/_pending-*", 1)]
    for root in [path, *(f"{path}/{name}" for name in pending)]:
        marked = {name.split("/")[0] for name in places._names(f"{root}/_shards/*/*", 2)}
        found = {language: places.marks(root, language) for language in marked}
        for leaf in places.leaves(root) if root == path else []:
            found.setdefault(leaf.split("/")[0], set()).add(leaf.rpartition("shard=")[2])
        for language, labels in found.items():
            for shards in {label.rpartition("-of-")[2] for label in labels}:
                lacking = {f"{i}-of-{shards}" for i in range(1, int(shards) + 1)} - labels
                if lacking:
                    missing.setdefault(language.removeprefix("lang="), set()).update(lacking)
    return {language: sorted(labels) for language, labels in sorted(missing.items())}


def write_submission(df: DataFrame, path: str, sort: str | None = None) -> None:
    """Two columns without a header, in as many part files as there are tasks.

    With ``sort`` the part files in name order are one sorted file. It sorts by ranges, and a
    value that fills more than one task is cut by where its rows came from.
    """
    if sort is not None:
        df = df.withColumn("_from", F.spark_partition_id()).orderBy(sort, "_from").drop("_from")
    df.write.mode("overwrite").option("header", False).option("nullValue", "").option(
        "emptyValue", ""
    ).option("escape", '"').csv(path)
