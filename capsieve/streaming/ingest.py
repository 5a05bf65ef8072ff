"""Incremental filings: micro-batches appended to a table by month, retention and gating on read.

Each micro-batch writes its new rows to ``Month=<yyyy-MM>/batch=<id>`` under the target and
overwrites these folders when it is retried, so a replayed batch changes nothing. Keys hold the filing date, so a batch is
compared with the months that it touches and with nothing else.
"""

from __future__ import annotations

import datetime as dt
import os
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from capsieve.operators.filings import coverage, fill_company, fill_ticker, keep_eligible, purge, with_age
from capsieve.operators.keyed import one_per_key
from capsieve.operators.runway import attach_runway, runway_by_url
from capsieve.rules import RULES, Rules
from capsieve.session import stored_once, work_dir
from capsieve.sources.accumulated import MONTH, month_of, unseen
from capsieve.sources.tables import log_step, swap, table_exists

KEYS = ("CIK", "URL", "Form", "FiledAt", "Ticker")


def store_batch(batch: DataFrame, batch_id: int, target: str, rules: Rules, as_of: dt.date | str,
                keys: Sequence[str] = KEYS, dedupe: bool = False, texts: DataFrame | None = None) -> int:
    """Write the rows of a batch whose key is not stored by another batch and which are inside retention.

    ``texts (URL, Text)`` give a cash runway to the new rows. Returns how many rows were written.
    """
    spark = batch.sparkSession
    kept = stored_once(purge(batch, as_of, rules), "batch")
    if table_exists(spark, os.path.dirname(target), os.path.basename(target)):
        fresh = unseen(kept, spark.read.parquet(target).where(F.col("batch") != batch_id), keys, "FiledAt", dedupe)
    else:
        rows = one_per_key(kept, keys) if dedupe else kept
        fresh = rows.withColumn(MONTH, month_of("FiledAt"))
    if texts is not None:
        fresh = attach_runway(fresh, runway_by_url(fresh, texts))
    added = Observation()
    fresh.withColumn("batch", F.lit(batch_id)).observe(added, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(MONTH, "batch").parquet(target)
    return added.get["rows"]


def ingest(stream: DataFrame, target: str, checkpoint: str | None, as_of: dt.date | str, rules: Rules = RULES,
           dedupe: bool = False, once: bool = True, texts: DataFrame | None = None, log_folder: str | None = None) -> StreamingQuery:
    """Start the append of a filings stream; ``once`` drains what is there and stops.

    Without a ``checkpoint`` the offsets go to the shared work folder of the session. With a ``log_folder`` every batch
    adds a line to the run log there, with the rows that it added.
    """
    if checkpoint is None:
        checkpoint = os.path.join(work_dir(stream.sparkSession), "ingest", os.path.basename(target.rstrip("/")))

    def store(batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        rows = store_batch(batch, batch_id, target, rules, as_of, dedupe=dedupe, texts=texts)
        if log_folder is not None:
            now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            log_step(batch.sparkSession, log_folder, "filings", rows, round(1000 * (time.monotonic() - began)), f"batch {batch_id}", now)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    return (writer.trigger(availableNow=True) if once else writer).start()


def current_filings(spark: SparkSession, target: str, profiles: DataFrame, as_of: dt.date | str, ordinal: str = "ord",
                    rules: Rules = RULES) -> DataFrame:
    """Stored filings after retention, key repair and the coverage gate, with their age."""
    stored = purge(spark.read.parquet(target).drop("batch", MONTH), as_of, rules)
    repaired = fill_ticker(stored, profiles, ordinal)
    gated = keep_eligible(repaired, coverage(repaired, profiles))
    return with_age(fill_company(gated, profiles, ordinal), as_of)


def compact(spark: SparkSession, target: str, as_of: dt.date | str, rules: Rules = RULES) -> None:
    """Rewrite the batches as one without the rows that left retention. Run it while the stream is stopped."""
    stored = spark.read.parquet(target)
    last = stored.agg(F.max("batch").alias("b")).first()["b"]
    staged = f"{target}__next"
    purge(stored, as_of, rules).withColumn("batch", F.lit(last)).write.mode("overwrite").partitionBy(MONTH, "batch").parquet(staged)
    swap(spark, staged, target)
