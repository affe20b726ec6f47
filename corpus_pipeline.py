"""The corpus pipeline: language ID, line dedup, near-dedup, source mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.llm import bpe, language_crf, line_dedup, near_dedup, source_mixing
from broadsheet.llm.work import ship, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_CONFIDENCE = 0.5  # mean chance of the words' likeliest languages, below which a text is rejected
RANKS = "byte_bpe_50k.tiktoken"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a language, or whose words can't be told; ``lang`` is what prevails."""
    ship(spark)
    told = language_crf.identify(docs, docs.where("lang is not null"), keep=COLUMNS)
    kept = told.where((F.col("lang_pred") != language_crf.UNKNOWN) & (F.col("confidence") >= LEAST_CONFIDENCE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove lines that begin earlier in the corpus, and documents of which no text is left."""
    ship(spark)
    kept = line_dedup.dedup_lines(docs, keep=("lang", "source"))
    return kept.where((F.col("n_removed") == 0) | (F.col("kept") != "")).select("doc_id", F.col("kept").alias("text"), "lang", "source", F.length("kept").cast("long").alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest id."""
    ship(spark)
    judged = near_dedup.near_duplicates(docs, shingle=5, percent=80)
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin documents so that sources weigh the root of their size."""
    return source_mixing.mixed_sources(docs, power=0.5).select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it."""
    ship(spark)
    ranks = public_tokenizers.path(RANKS)
    told = bpe.round_trip(docs.select(*COLUMNS), ranks)
    whole = F.sha2("decoded", 256) == F.sha2(F.coalesce("text", F.lit("")), 256)
    return told.select("doc_id", "lang", "source", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", whole.alias("round_trip"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("bpe", encode_texts),
]

# Learned labels, edit joins and merges are not SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
