"""The digest queries of this subpackage: ``QUERIES`` by name, ``SQL`` for
those that another engine can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, language, licenses, mixing, pii, quality_model, quality_rules, similarity_join, url_rules
from .common import table, values
from .sql import SQL

__all__ = ["QUERIES", "SQL"]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents")).drop("clean_text")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(licenses.scan(table(spark, sf_dir, "documents"), "doc_id"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.detect(table(spark, sf_dir, "documents"), "doc_id"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs), "doc_id")
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mix(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rules_frame(spark))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.window_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


HARD_CONVERSATION = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(values(spark, HARD_CONVERSATION, "conv_id long, turn long, role string, text string"))
    return chat.read_back(chat.format_chat(rows))


def op10_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_join.join_texts(table(spark, sf_dir, "documents"))


_ALL = (
    op1_quality_rules, op2_license_scan, op3_pii, op4_language_id, op5_mixing,
    op6_quality_model, op7_url_rules, op8_decontaminate, op9_chat_format, op10_similarity_join,
)
QUERIES = {f.__name__: f for f in _ALL}
