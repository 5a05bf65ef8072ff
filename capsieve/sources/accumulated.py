"""Accumulating tables, stored by month: deliveries are appended after an anti-join with the months that they touch.

A row's key holds its date, so the same key can only stand in the same month. Appending therefore reads the keys of the touched
months and nothing else, whatever the age of the table, and rewrites no stored file. An append that failed half-way or is repeated
adds nothing twice, because what it stored is found by the next anti-join.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capsieve.operators.keyed import new_rows, one_per_key
from capsieve.session import stored_once
from capsieve.sources.tables import table_exists

MONTH, UNDATED = "Month", "undated"


def month_of(date: str) -> Column:
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(UNDATED))


def read_store(spark: SparkSession, folder: str, name: str, columns: T.StructType) -> DataFrame:
    """All rows of an accumulating table with its month; no rows when nothing was stored yet."""
    stored = T.StructType([*columns.fields, T.StructField(MONTH, T.StringType())])
    if not table_exists(spark, folder, name):
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).parquet(os.path.join(folder, name))


def unseen(new: DataFrame, stored: DataFrame, keys: Sequence[str], date: str, dedupe: bool = False) -> DataFrame:
    """Rows of `new` (with its month) whose key is not stored. Both sides are cut to the months of `new`."""
    if date not in keys:
        raise ValueError("the key of an accumulating table holds its date")
    rows = new.withColumn(MONTH, month_of(date))
    months = [r[MONTH] for r in rows.select(MONTH).distinct().collect()]  # as many rows as a calendar has months
    fresh = new_rows(stored.where(F.col(MONTH).isin(months)).select(*keys), rows, keys)
    return one_per_key(fresh, keys) if dedupe else fresh


def accumulate(new: DataFrame, folder: str, name: str, keys: Sequence[str], date: str, columns: T.StructType,
               complete: Callable[[DataFrame], DataFrame] = lambda df: df, dedupe: bool = False) -> int:
    """Append the rows with unseen keys; `complete` is applied to these rows only. Returns how many were added.

    The count is observed while the rows are written. Keys compare as text, null equals null; rows without a date have a month
    of their own. Repeated keys inside one delivery stay unless `dedupe` asks for one row per key.
    """
    spark = new.sparkSession
    once = stored_once(new, f"{name}-new")
    fresh = complete(unseen(once, read_store(spark, folder, name, columns), keys, date, dedupe))
    rows = fresh.select(*[(F.col(f"`{f.name}`") if f.name in fresh.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns.fields], MONTH)
    added = Observation()
    # rows of a month go to one file each task, not to a file for each month and task
    dealt = rows.repartition(MONTH, F.pmod(F.hash(*keys), F.lit(8))).observe(added, F.count(F.lit(1)).alias("rows"))
    dealt.write.mode("append").partitionBy(MONTH).parquet(os.path.join(folder, name))
    return added.get["rows"]


def drop_months(spark: SparkSession, folder: str, name: str, before: dt.date) -> list[str]:
    """Deletes the whole months that ended before a day; rows of later months are left to the retention rule of the reader."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    root = jvm_path(os.path.join(folder, name))
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for status in fs.listStatus(root) if fs.exists(root) else []:
        month = status.getPath().getName().removeprefix(f"{MONTH}=")
        if status.isDirectory() and month[:4].isdigit() and month < before.strftime("%Y-%m"):
            fs.delete(status.getPath(), True)
            gone.append(month)
    return sorted(gone)
