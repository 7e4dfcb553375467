"""The corpus pipeline: language ID, near-duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the
shared folder and read back as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candlewick.llm.decontam import decontaminate
from candlewick.llm.langid import accept
from candlewick.llm.mixing import mix
from candlewick.llm.neardup import keep_one
from candlewick.llm.shared import Scratch, table
from candlewick.llm.token_store import token_store


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return accept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_store(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("tokens", tokens)]

#: Trained models, sketch-like joins and a tokenizer: not SQL. Tested stage by stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.cut(docs, name)
    return docs
