"""A corpus pipeline of the operators in starflow.llm: reject toxic documents, drop lines seen
before, keep one document of each group of near copies, drop documents that leak a
benchmark, and encode what is left.

Each stage works on all that the one before kept, and what it returns is written and read again.
All stages but the last return the columns of the documents they were given, with n_chars
brought up to date where texts change.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starflow.llm import sentencepiece_tokens, toxicity
from starflow.llm.decontamination import find_leaks
from starflow.llm.line_dedup import without_repeated_lines
from starflow.llm.minhash import near_duplicates
from starflow.llm.queries import SENTENCEPIECE_MODEL
from starflow.llm.rows import row_key, saved, unused
from starflow.sources import read_parquet

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5. The classifier learns from the labels of documents whose
    crc32 is not divisible by 5."""
    labels = read_parquet(spark, f"{sf_dir}/labels.parquet").filter(
        F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    )
    model = toxicity.train(docs, labels)
    score = unused(docs, "score")
    return toxicity.with_toxicity(docs, model, score).filter(F.col(score) < 0.5).drop(score)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier one has."""
    return without_repeated_lines(docs).withColumn(
        "n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more of five-word shingles."""
    groups = near_duplicates(docs, words=5, percent=80)
    doc, row = unused(docs, "of_doc"), unused(docs, "of_row")
    dropped = groups.filter("NOT kept").select(
        F.col("doc_id").alias(doc), F.col("row").alias(row)
    )
    same = (docs["doc_id"] == dropped[doc]) & (row_key() == dropped[row])
    return docs.join(dropped.distinct(), same, "left_anti")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark. Rows are judged one by one, also those without
    doc_id and those that share one."""
    leaks = find_leaks(docs, read_parquet(spark, f"{sf_dir}/benchmark.parquet"))
    doc, row = unused(docs, "of_doc"), unused(docs, "of_row")
    leaking = leaks.select(F.col("doc_id").alias(doc), F.col("row").alias(row)).distinct()
    same = docs["doc_id"].eqNullSafe(leaking[doc]) & (row_key() == leaking[row])
    return docs.join(leaking, same, "left_anti")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return sentencepiece_tokens.encode(docs, Path(SENTENCEPIECE_MODEL).read_bytes())


# Rows that go to a task's Python and back at a time, unless the session asks for fewer. Spark's default of 10,000 is
# tens of megabytes of text, held several times over in an executor; operators cut it into blocks anyway.
ROWS_AT_A_TIME = 2000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _in_small_batches(stage: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        asked = int(spark.conf.get(_BATCH))
        if not 0 < asked <= ROWS_AT_A_TIME:
            spark.conf.set(_BATCH, str(ROWS_AT_A_TIME))
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _in_small_batches(reject_toxic)),
    ("line_dedup", _in_small_batches(drop_repeated_lines)),
    ("near_dedup", _in_small_batches(drop_near_copies)),
    ("decontamination", _in_small_batches(drop_leaks)),
    ("tokens", _in_small_batches(encode)),
]

# Classifier, sketches and tokens are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_parquet(spark, f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
