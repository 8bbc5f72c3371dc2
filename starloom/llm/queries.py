"""The queries opN_<name>: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_extract, langid, line_dedup, lm_score, mixing, mpeg_audio, secrets, simhash, url_filter
from .common import crc_mod, table


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), crc_mod(F.col("doc_id"), 7) == 2)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select("doc_id", "item_id", "distance", "budget")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), secrets.fit(secrets.labelled_findings(spark)))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "mined")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def language_model(docs: DataFrame) -> langid.LanguageModel:
    """Learnt from the documents that are not held out."""
    return langid.fit_profiles(langid.sample(docs.where(crc_mod(F.col("doc_id"), 4) != 2)))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), language_model(docs))
    return found.select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op10_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mpeg_audio.digests(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_lm_score, op2_decontaminate, op3_source_mix, op4_simhash, op5_secret_scan, op6_url_filter, op7_line_dedup, op8_language_id, op9_main_text, op10_mpeg_audio)}
SQL: dict[str, str] = {"op3_source_mix": mixing.SQL, "op7_line_dedup": line_dedup.SQL}
