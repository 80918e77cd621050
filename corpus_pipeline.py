"""The corpus pipeline: toxicity, line dedup, near duplicates, benchmark decontamination, encoding.

Each stage works on all that its predecessor kept; its output is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assetweave.llm import jaccard_join, line_dedup, sentencepiece_codec, toxicity, winnowing
from assetweave.llm.common import drop_tables, materialise, read_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs, n=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return winnowing.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: A learned classifier and a tokenizer are among the stages, so SQL can't express the rows of run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if i:
            drop_tables(before)
    return STAGES[-1][1](spark, docs, sf_dir)
