"""Corpus pipeline: the stages that turn raw documents into a training mixture."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicspark.llm import decontaminate, jaccard_join, mixing, surrogates, toxicity
from civicspark.llm.frames import importable, read
from civicspark.llm.queries import SURROGATE_KEY
from civicspark.session import drop_staged, stage_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, learned from the labels, does not reject."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 of its five-word shingles."""
    importable(spark)
    return jaccard_join.one_of_each(docs, shingle=5, percent=80)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"))


def with_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; n_chars follows the text."""
    found, _ = surrogates.replace(docs, SURROGATE_KEY)
    if "n_chars" not in docs.columns:
        return found.select(*docs.columns)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return found.withColumn("n_chars", F.coalesce(length, "n_chars")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture of sources."""
    found, _ = mixing.mix(docs)
    return found


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmarks),
    ("personal_data", with_surrogates),
    ("mixing", mixed),
]

#: The first stage's classifier cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is stored and read again as the next one's input."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        table = stage_table(stage(spark, docs, sf_dir), f"pipeline_{name}")
        if before:
            drop_staged(spark, before)
        docs, before = spark.table(table), table
    return docs
