"""Registered queries of the operators, and their DuckDB texts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlens.llm import (
    archive,
    decontaminate,
    frames,
    language,
    licenses,
    mixing,
    neardup,
    negatives,
    packing,
    private,
    topk,
    toxicity,
    turns,
)
from depotlens.llm.oracle import ORACLE  # noqa: F401
from depotlens.llm.storage import fresh_folder, stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.report(table(spark, folder, "documents"))


def op2_bit_sliced_topk(spark: SparkSession, folder: str) -> DataFrame:
    shared = fresh_folder(spark, "slices")
    written = topk.index(table(spark, folder, "embeddings"), shared, "vec_id", "embedding")
    return topk.search(written, shared, k=5, every=50).drop("query_row")


def op3_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    shared = fresh_folder(spark, "frames")
    manifest = stored(frames.write(table(spark, folder, "documents"), shared, TOKENIZER), shared, "manifest")
    return frames.read(manifest).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op4_zip_archive(spark: SparkSession, folder: str) -> DataFrame:
    shared = fresh_folder(spark, "archives")
    packages = stored(archive.write(table(spark, folder, "pages"), shared), shared, "packages")
    return archive.read(packages).drop("url", "payload")


def op5_cutting_stock(spark: SparkSession, folder: str) -> DataFrame:
    return packing.report(packing.packed(table(spark, folder, "documents"), TOKENIZER))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op7_language_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return language.report(table(spark, folder, "documents"))


def op8_private_data(spark: SparkSession, folder: str) -> DataFrame:
    return private.report(table(spark, folder, "documents"))


def op9_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.score(table(spark, folder, "documents"))


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op11_multiple_instance(spark: SparkSession, folder: str) -> DataFrame:
    shared = fresh_folder(spark, "toxicity")
    return toxicity.report(table(spark, folder, "documents"), table(spark, folder, "labels"), shared)


def op12_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turns.repaired(table(spark, folder, "conversations"), fresh_folder(spark, "turns"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = negatives.shifted_labels(table(spark, folder, "embeddings"))
    return negatives.mine(rows, fresh_folder(spark, "negatives"), every=50)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_minhash_dedup,
        op2_bit_sliced_topk,
        op3_token_frames,
        op4_zip_archive,
        op5_cutting_stock,
        op6_license_scan,
        op7_language_mixture,
        op8_private_data,
        op9_context_mixing,
        op10_decontamination,
        op11_multiple_instance,
        op12_turn_repair,
        op13_hard_negatives,
    )
}
