"""The corpus pipeline: five stages, each over all that the one before it kept.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``, any others that the table has included. Between stages the rows are written as Parquet
and read again. An empty table of documents gives empty results in all stages; null texts count as empty ones, but stay null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontaminate, jaccard_join, mixing, pii, quality_model
from plumbline.llm.common import scratch


def _measured(before: DataFrame, after: DataFrame) -> DataFrame:
    """n_chars follows the texts that a stage has changed."""
    return after.withColumn("n_chars", F.length("text").cast(before.schema["n_chars"].dataType)).select(*before.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Repeated rows are judged alike; without usable labels all are kept."""
    model = quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of least id stays, and of equal rows one; a null id comes last.

    Texts without words link with nothing and stay, one for each id and text.
    """
    return jaccard_join.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark spans are cut out; documents made of them for the most part go. An empty benchmark changes nothing."""
    return _measured(docs, decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to their kind in brackets; other texts are unchanged, repeated rows are treated each."""
    return _measured(docs, pii.redact(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of each document in the mix: a row for each row; a null source is a source of its own, without words nothing is taken."""
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("benchmark_free", benchmark_free), ("personal_data", personal_data), ("mixture", mixture)]

#: Trees, an LSTM and Newton steps have no SQL; tests/llm/test_pipeline.py holds each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
