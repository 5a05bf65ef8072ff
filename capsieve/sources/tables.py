"""Stage tables on shared storage: checked reads, fixed-schema writes, appends, promotion."""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from capsieve.operators.keyed import align, keep_days, new_rows, one_per_key, spread
from capsieve.schemas import schema
from capsieve.session import stored_once

FILES_PER_FOLDER, BATCH_BYTES = 4096, 8 << 20


class MissingTable(RuntimeError):
    """A stage table or one of its required columns is absent."""


def _path(folder: str, name: str) -> str:
    return os.path.join(folder, name)


def table_exists(spark: SparkSession, folder: str, name: str) -> bool:
    """Asks the file system the path belongs to, so it works on any shared store."""
    location = spark._jvm.org.apache.hadoop.fs.Path(_path(folder, name))
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def read_table(spark: SparkSession, folder: str, name: str, required: Sequence[str] = (),
               columns: T.StructType | None = None) -> DataFrame:
    """A stored table; missing table or columns are an error."""
    try:
        reader = spark.read.schema(columns) if columns is not None else spark.read
        df = reader.parquet(_path(folder, name))
    except AnalysisException as error:
        raise MissingTable(f"{name} missing; cannot resume at this stage") from error
    check_columns(df, name, required)
    return df


def check_columns(df: DataFrame, name: str, required: Sequence[str]) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingTable(f"{name} missing required columns: {', '.join(missing)}")


def read_csv_table(spark: SparkSession, path: str, columns: T.StructType) -> DataFrame:
    """CSV in the published column layout: names come from the header, types from the schema."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    known = {f.name for f in columns.fields}
    typed = [F.col(f"`{c}`").try_cast(columns[c].dataType).alias(c) for c in raw.columns if c in known]
    return align(raw.select(typed), columns)


def write_table(df: DataFrame, folder: str, name: str, columns: T.StructType | None = None) -> int:
    """Replace a table. The schema is written even when there are no rows. Returns how many rows were written, counted on the way."""
    out = align(df, columns) if columns is not None else df
    written = Observation()
    out.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(_path(folder, name))
    return written.get["rows"]


def write_csv(df: DataFrame, path: str) -> None:
    """CSV sink for reports. Lists are joined with ';'."""
    flat = [F.array_join(F.col(f"`{f.name}`"), ";").alias(f.name) if isinstance(f.dataType, T.ArrayType)
            else F.col(f"`{f.name}`") for f in df.schema.fields]
    df.select(flat).write.mode("overwrite").csv(path, header=True, escape='"')


def append_table(spark: SparkSession, new: DataFrame, folder: str, name: str, keys: Sequence[str],
                 as_of: dt.date | str, days: int | None = None, date: str = "Date", dedupe: bool = False) -> int:
    """Add the rows with unseen keys and apply flat retention. Returns how many rows were added.

    The merged table is written next to the old one and then swapped in, so a
    failed run leaves the old table readable. For tables that grow without bound
    see :mod:`accumulated`, which rewrites nothing.
    """
    added = Observation()
    stored = spark.read.parquet(_path(folder, name)) if table_exists(spark, folder, name) else None
    fresh = new if stored is None else new_rows(stored, new, keys)
    fresh = (one_per_key(fresh, keys) if dedupe else fresh).observe(added, F.count(F.lit(1)).alias("rows"))
    merged = fresh if stored is None else stored.unionByName(fresh, allowMissingColumns=True)
    merged = keep_days(merged, date, F.lit(str(as_of)).cast("date"), days)
    staged = _path(folder, f"{name}__next")
    merged.write.mode("overwrite").parquet(staged)
    swap(spark, staged, _path(folder, name))
    return added.get["rows"]


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Puts a staged table in the place of another, which is kept aside until the staged one stands there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    new, old, aside = jvm_path(staged), jvm_path(target), jvm_path(f"{target}__last")
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(new):
        raise RuntimeError(f"{staged} is not there to be moved")
    if not fs.exists(old) and fs.exists(aside):  # an earlier swap ended between its two moves
        fs.rename(aside, old)
    fs.delete(aside, True)
    if fs.exists(old) and not fs.rename(old, aside):
        raise RuntimeError(f"could not move {target} aside")
    if not fs.rename(new, old):
        fs.rename(aside, old)
        raise RuntimeError(f"could not move {staged} to {target}")
    fs.delete(aside, True)


def log_step(spark: SparkSession, folder: str, module: str, rows: int, ms: int, note: str, ts: dt.datetime) -> None:
    """One line of the run log."""
    spark.createDataFrame([(ts, module, rows, ms, note)], schema("runlog")).write.mode("append").parquet(_path(folder, "runlog"))


def log_error(spark: SparkSession, folder: str, module: str, message: str, ts: dt.datetime) -> None:
    spark.createDataFrame([(ts, module, message)], schema("errorlog")).write.mode("append").parquet(_path(folder, "errorlog"))


def first_existing(spark: SparkSession, folder: str, names: Iterable[str]) -> DataFrame | None:
    """Canonical table if stored, else the older one, else None."""
    for name in names:
        if table_exists(spark, folder, name):
            return spark.read.parquet(_path(folder, name))
    return None


def modified_at(spark: SparkSession, folder: str, name: str) -> int:
    """Modification time of a table in milliseconds, -1 when absent."""
    if not table_exists(spark, folder, name):
        return -1
    location = spark._jvm.org.apache.hadoop.fs.Path(_path(folder, name))
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(location).getModificationTime()


def newest(spark: SparkSession, folder: str, canonical: str, legacy: str) -> DataFrame | None:
    """The older table when it was written last, else the canonical one."""
    here, other = modified_at(spark, folder, canonical), modified_at(spark, folder, legacy)
    if here < 0 and other < 0:
        return None
    return spark.read.parquet(_path(folder, legacy if other >= 0 and other >= here else canonical))


def stage_counts(tables: dict[str, DataFrame | None], spark: SparkSession) -> DataFrame:
    """``(Stage, Rows)`` of the funnel; absent tables count as 0."""
    empty = spark.createDataFrame([], "x int")
    parts = [(df if df is not None else empty).agg(F.count("*").alias("Rows")).select(F.lit(n).alias("Stage"), "Rows")
             for n, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """``(URL, Text)`` of filing files; undecodable bytes are dropped."""
    return _texts(spark.read.format("binaryFile").load(path).select(F.col("path").alias("URL"), "content"))


def _texts(files: DataFrame) -> DataFrame:
    text = F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("\ufffd"), F.lit(""))
    return files.select(F.regexp_replace("URL", "^file:/+", "file:///").alias("URL"), text.alias("Text"))


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a link as Hadoop writes it (``file:/x``, ``s3a://``)."""
    return fs.FileSystem.from_uri("/" + uri[5:].lstrip("/") if uri.startswith("file:") else uri.replace("s3a://", "s3://", 1))


def write_text_files(texts: DataFrame, folder: str) -> DataFrame:
    """``texts (name, text)``, each as a file of its own with a line end; returns the written table of their links (``URL``).

    Tasks write the files at their final places, into folders of their own, and the list of links is a table. Nothing is
    moved or listed by the driver, so its work does not grow with the files. What a lost attempt has written is in no list.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        attempt, count = uuid.uuid4().hex, 0
        store, root = _store(folder)
        for batch in batches:
            links = []
            for name, text in zip(batch.column(0), batch.column(1)):
                place = f"{attempt}-{count // FILES_PER_FOLDER}"
                if count % FILES_PER_FOLDER == 0:
                    store.create_dir(f"{root}/{place}", recursive=True)
                with store.open_output_stream(f"{root}/{place}/{name.as_py()}") as out:
                    out.write(text.as_py().encode() + b"\n")
                links.append(f"{folder}/{place}/{name.as_py()}")
                count += 1
            yield pa.RecordBatch.from_arrays([pa.array(links, pa.string())], ["URL"])

    whole = texts.select("name", F.coalesce("text", F.lit("")).alias("text"))
    return stored_once(whole.mapInArrow(run, "URL string"), "text-files")


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(links: list[str], found: list[bytes]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(links, pa.string()), pa.array(found, pa.binary())], ["URL", "content"])

    store, root, before = None, "", 0
    for given in batches:
        links, found, size = [], [], 0
        for link in given.column(0).to_pylist():
            if link is None:
                continue
            if not root or not link.startswith(root):  # one file system per scheme and host
                store, path = _store(link)
                before = len(link) - len(path)
                root = link[:before] if link.endswith(path) else link
            else:
                path = link[before:]
            with store.open_input_stream(path) as file:
                found.append(file.read())
            links.append(link)
            size += len(found[-1])
            if size >= BATCH_BYTES:
                yield batch(links, found)
                links, found, size = [], [], 0
        yield batch(links, found)


def read_listed_files(files: DataFrame) -> DataFrame:
    """:func:`read_text_files` of the files whose links are listed in a table (``URL``): tasks open them, the driver lists nothing."""
    return _texts(spread(files.select("URL"), "URL").mapInArrow(_contents, "URL string, content binary"))


def tail(log: DataFrame, rows: int = 500, ts: str = "ts", ordinal: str | None = None) -> DataFrame:
    """Newest rows of a log."""
    order = [F.desc(ts)] + ([F.desc(ordinal)] if ordinal else [])
    return log.orderBy(*order).limit(rows)
