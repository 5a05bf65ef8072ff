"""A training corpus from raw documents: quality, near-duplicates, repeated passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the docs of
the next. All but the last return the columns of documents. `run` applies the stages to the documents of a folder.

Defined results, for every stage: null and empty texts are texts without words; rows without doc_id stay in all stages but where
their text is rejected; repeated rows are documents each until near-duplicates go, where of rows that share an id all stay or go
together; an empty table gives an empty table; further columns, whatever their names, are carried through the first four stages.

Tables that a stage writes on its way are deleted when the next stage begins on the written result, so that the shared
folder holds those of one stage at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capsieve.llm import near_dup, packing, pii, quality, substring_dedup
from capsieve.llm.queries import VOCABULARY
from capsieve.llm.store import noted, removed, text_batches, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Tables on the way to the result of the last stage that began.
_underway: list[str] = []


def _stage(function: Stage) -> Stage:
    @wraps(function)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        text_batches(spark)
        # a caller that passes the unwritten result of a stage still needs its tables
        if not any(path.rpartition("/")[2] in file for file in docs.inputFiles() for path in _underway):
            removed(spark, _underway)
        with noted(_underway):
            return function(spark, docs, sf_dir)
    return run


@_stage
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels of the folder, does not reject.

    Empty texts are scored like others. Without labels of the documents at hand every score is 0.5 and nothing goes.
    """
    trees = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.with_scores(docs, trees).where("predicted = 1").select("row.*")


@_stage
def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group (five-word shingles, similarity 0.8).

    Texts without words are near nothing and stay. Rows without doc_id stay.
    """
    named = [c for c in docs.columns if c in ("doc_id", "text")]
    lost = near_dup.near_duplicates(docs.select(named), words=5).where("NOT kept").select(F.col("doc_id").alias("lost")).distinct()
    return docs.join(lost, docs["doc_id"] == lost["lost"], "left_anti")


@_stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 20 words or more that stand earlier. A null text comes out empty, rows without doc_id stay whole."""
    found = substring_dedup.remove_repeats(docs)
    return found.select(*[F.col("kept_text").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


@_stage
def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced, and terms that disclose it generalised or removed. A null text stays null."""
    return pii.sanitised(docs)


@_stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: the pieces of the documents and their places. A null or empty text is its end mark alone."""
    return packing.pack(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality), ("near_dedup", one_of_each), ("substring_dedup", without_repeats), ("pii", without_personal_data), ("packing", packed)]

#: The classifier, the confirmed MinHash groups and the packing cannot be put in SQL; tests/llm compares the operators with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
