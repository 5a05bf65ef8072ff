"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_noted: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder named by `spark.checkpoint.dir`, or set as checkpoint folder. Only a local master with neither gets a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="capsieve-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _noted:
        paths.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a written table: its lineage ends here, so lost executors cost no earlier work, and repeated uses read it."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def noted(paths: list[str]) -> Iterator[None]:
    """Adds the paths of all tables written meanwhile to a list, for :func:`removed`."""
    _noted.append(paths)
    try:
        yield
    finally:
        _noted.remove(paths)


def removed(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables that nothing reads any more, and empties the list."""
    jvm = spark.sparkContext._jvm
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_batches(spark: SparkSession) -> None:
    """Arrow batches of 1000 rows where the session has the default of 10000: rows hold whole texts, and JVM and worker hold copies of a batch."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")
