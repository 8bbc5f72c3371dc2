"""From raw documents to a training mix, in five stages; each reads the Parquet that the one before wrote.

Stages 1 to 4 return the columns of `documents`; the last returns the documents of the mix with their size, source_size, target and taken words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom import scratch
from starloom.llm import decontaminate, langid, line_dedup, mixing, queries, simhash
from starloom.llm.common import materialise, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a determinable language go; a missing label is filled in by the prediction."""
    found = langid.identify(docs, queries.language_model(docs))
    kept = found.where(F.col("lang_pred") != langid.UNDETERMINED).withColumn("lang", F.coalesce("lang", "lang_pred"))
    return kept.select(*docs.columns)


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated three-line windows go, and documents of which nothing is left."""
    found = line_dedup.dedup(docs)
    kept = found.where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("bigint")).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one(docs).select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes words of, with how many."""
    return mixing.mix(docs).where(F.col("taken") > 0)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("line_dedup", unique_lines),
    ("simhash_dedup", one_of_each),
    ("decontamination", without_benchmark),
    ("source_mix", mixed),
]
#: Language models, fingerprints and edit distances are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Tables that a stage and its predecessor wrote are removed once the stage itself is written."""
    docs, at = table(spark, sf_dir, "documents"), scratch.mark()
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
        scratch.clear(spark, at, keep=(docs,))
    return docs
