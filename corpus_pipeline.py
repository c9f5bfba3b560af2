"""Corpus pipeline: raw documents to packed token sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm import decontaminate, language, neardup, packing, private
from depotlens.llm.queries import TOKENIZER, table
from depotlens.llm.storage import drop, fresh_folder, stored, working_folders


def with_main_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones know: texts without letters go, and
    texts that no known language explains. A missing ``lang`` is filled in."""
    return language.main_language(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id. Unlike op1,
    two documents are near-duplicates from a similarity of 0.80 of their word shingles on."""
    return neardup.one_of_each(docs, percent=80)


def clean_of_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose personal data is replaced by tags."""
    return private.redacted(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full token sequences, with their ids."""
    return packing.packed(docs, TOKENIZER).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language identification", with_main_language),
    ("near-duplicates", without_near_duplicates),
    ("benchmark decontamination", clean_of_benchmarks),
    ("personal data", without_personal_data),
    ("packing", packed),
]

# Near-duplicates, language models and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and reread by the next. What a
    stage wrote for itself goes at its end, and its result once the next has used it."""
    folder = fresh_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        with working_folders(spark):
            docs = stored(stage(spark, docs, sf_dir), folder, f"stage{number}")
        if number:
            drop(spark, f"{folder}/stage{number - 1}")
    return docs
