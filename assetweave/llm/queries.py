"""The thin queries over the operators: each applies one operator to its whole table and derives the columns that are asked for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, harmonic_packing, jaccard_join, line_dedup, lm_scoring, media_audio, merkle_manifest, sentencepiece_codec, token_counts, token_output, toxicity, winnowing, yinyang_clusters
from .common import crc_mod, read_table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(read_table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents"), n=4, percent=85)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.7).cast("int").alias("predicted"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(read_table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = token_output.write_token_files(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return token_output.read_token_files(spark, folder, manifest)


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_audio.media_round_trip(read_table(spark, sf_dir, "documents"))


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.format_chats(read_table(spark, sf_dir, "conversations"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("line_total").alias("n_lines"), F.col("line_dropped").alias("n_dropped"), F.sha2(F.col("line_kept").cast("binary"), 256).alias("kept_sha256"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnowing.find_overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        winnowing.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.tamper_check(read_table(spark, sf_dir, "documents"))


def op12_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = harmonic_packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_yinyang_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return yinyang_clusters.clusters_with_inertia(read_table(spark, sf_dir, "embeddings")).drop("scans")


def queries() -> dict:
    ops = (
        op1_lm_scoring,
        op2_ngram_jaccard_join,
        op3_toxicity,
        op4_token_counts,
        op5_sentencepiece,
        op6_token_files,
        op7_media_columns,
        op8_chat_formatting,
        op9_line_dedup,
        op10_benchmark_decontamination,
        op11_merkle_manifest,
        op12_harmonic_packing,
        op13_yinyang_clusters,
    )
    return {f.__name__: f for f in ops}
