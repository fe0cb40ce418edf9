"""Tables in the cluster's shared folder, written to cut lineage and to survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``. Only a local session may go without."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="jobweave-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; every call gives another one."""
    path = f"{shared_dir(spark)}/jobweave/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a read of it.

    Model calls are not repeatable, so nothing downstream may trigger them again; and a lost
    executor re-reads files instead of running the whole history.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that a job has put in the shared folder once its result is written."""
    before = len(_made)
    yield
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for path in _made[before:]:
        target = hadoop(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    del _made[before:]
