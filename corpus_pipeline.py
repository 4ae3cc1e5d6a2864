"""A text pipeline over ``documents``: each stage is one operator, written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.llm import bpe_codec, chosen_path, language_id, pii, template_leaks
from lotflow.llm.texts import fold, table
from lotflow.session import shared_dir

#: Least probability of the predicted language.
SURE_LANGUAGE = 0.5
#: Rows that pass to a Python worker at a time: whole texts, so a batch of the usual 10,000 takes tens of megabytes on both sides.
BATCH_ROWS = 1000


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter and those whose language stays unsure, row by row."""
    model = language_id.train(docs.where(fold("doc_id", 3) != 1))
    found = language_id.with_language(docs, model)
    sure = (F.col("__lang_pred") != language_id.UNDETERMINED) & (F.col("__lang_score") >= SURE_LANGUAGE)
    return found.where(sure).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return chosen_path.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """No document that holds a benchmark item."""
    return template_leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; lengths brought up to date."""
    return pii.with_length(pii.redact(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the text they decode to."""
    return bpe_codec.bpe_digests(docs)


def _in_small_batches(stage: Callable) -> Callable:
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language", _in_small_batches(keep_known_languages)),
    ("near_copies", _in_small_batches(keep_one_of_each)),
    ("leaks", _in_small_batches(drop_leaks)),
    ("personal_data", _in_small_batches(hide_personal_data)),
    ("encode", _in_small_batches(encode)),
]

#: Models and trained vocabularies are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = shared_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
