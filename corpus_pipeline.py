"""A training corpus from raw documents: identify, filter, deduplicate, pack.

STAGES are applied in order; each gets the rows that its predecessor kept, written as Parquet and read
again. All but the last return the columns of documents. Nulls, ties, repeated rows and empty tables
have the results that the operators state: a document without letters goes in the first stage, a row that repeats
the id and text of another stays once, and no documents give no sequences.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from leaguelake.llm import exact_dedup, language, near_dedup, packing, toxicity
from leaguelake.llm.common import in_fold
from leaguelake.llm.queries import table, vocabulary_path
from leaguelake.sources.store import let_go, session_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(function: Stage) -> Stage:
    """A stage that begins once what the one before it left on the driver and in shuffle files is dropped."""

    @wraps(function)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        let_go(spark)
        return function(spark, docs, sf_dir)

    return begun


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the language models reject: texts without letters, or unlike any language learned."""
    model = language.train(docs.where(~in_fold("doc_id", 3, 1)))
    return language.accepted_documents(docs, model)


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents scored as toxic by a field fitted on the labels of those outside the test fold."""
    model = toxicity.train(docs.where(~in_fold("doc_id", 5, 0)), table(spark, sf_dir, "labels"))
    return toxicity.clean_documents(docs, model)


@_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, keeps the one with the largest id."""
    return exact_dedup.kept_documents(docs, keep="largest")


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shared shingles, keeps the one with the smallest id."""
    return near_dedup.kept_documents(docs)


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 2048 tokens."""
    return packing.packed(docs, vocabulary_path()).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("packing", pack),
]

#: Trained models and token merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{session_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
