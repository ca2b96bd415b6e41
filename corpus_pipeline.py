"""Corpus pipeline: five stages from raw documents to a training mix.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all that the stage
before it kept.  ``run`` writes each stage's result as Parquet in the shared
folder and reads it again as the next one's documents, so a lost executor
costs one stage at most.

1. ``language`` drops documents of no language: without a letter, or with
   nothing in them that the model knows.
2. ``near_duplicates`` keeps one document, that of the least ``doc_id``, of each
   class of texts linked by 5-word shingles at a similarity of 0.8.
3. ``decontaminate`` drops documents that hold a window of the benchmark.
4. ``pii`` puts ``[KIND]`` in place of personal data; ``n_chars`` follows.
5. ``mix`` takes documents by source towards the target weights; ``copy``
   numbers the repeats of a document from 1.

Ids may repeat or be missing: documents are told apart by their texts, and rows
by all their columns, which every stage passes on whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm import decontaminate, language, mixing, pii, similarity_join
from sedimenta.llm.common import shared_folder, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.known_rows(docs, language.fit(docs))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similarity_join.one_of_each_class(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("mix", mix_stage),
]

#: SQL has no form of the fitted models in stages 1 and 4, nor of chosen paths.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
