"""One registered query per operator, with production parameters on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm import (
    embeddings, hard_negatives, language, line_dedup, mixing, neighbours, packing, pivot_search, simhash, suffixes,
    toxicity, warc, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary() -> str:
    """Path of the vocabulary file, which every executor has installed at the same place."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.repeated_spans(table(spark, folder, "documents"))


def op2_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op3_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"))


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = line_dedup.cleaned(table(spark, folder, "documents"), every_copy=True)
    return rows.select("row.doc_id", "removed_lines", "row.text")


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete"
    )


def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.plan(table(spark, folder, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    rows = packing.pack(table(spark, folder, "documents"), vocabulary())
    return rows.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "sequence_id",
        F.col("offset").cast("long").alias("offset"),
        "certified",
    )


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return hard_negatives.mine(rows.withColumn("label", hard_negatives.shifted_label(F.col("vec_id"), F.col("label"))))


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_pivot_search(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_search.search(table(spark, folder, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_suffixes": op1_suffixes,
    "op2_embeddings": op2_embeddings,
    "op3_neighbours": op3_neighbours,
    "op4_line_dedup": op4_line_dedup,
    "op5_warc": op5_warc,
    "op6_language": op6_language,
    "op7_mixing": op7_mixing,
    "op8_packing": op8_packing,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_whitening": op12_whitening,
    "op13_pivot_search": op13_pivot_search,
}
