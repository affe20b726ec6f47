"""Spelling suggestions for whole tables of words, by neighbourhoods of deletions.

Two words within ``MAX_EDITS`` edits that begin with the same character have a variant in common:
the same string is left of both when some characters, no more than that, are deleted from the first
``PREFIX`` ones, the very first not among them. The variants of a vocabulary are a stored table, in
buckets; a table of words meets it by an equality join on the variant, and only those pairs are
measured. A word has at most 22 variants, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from broadsheet.functions.shape import let
from broadsheet.operators.spelling import ACCURACY, COUNT, MAX_EDITS, MAX_QUERY_FREQUENCY, MIN_QUERY_LENGTH

# ---- fixed values -------------------------------------------------------------------
PREFIX = 7
BUCKETS = 64


def deletions(word: Column, max_edits: int = MAX_EDITS, prefix: int = PREFIX) -> Column:
    """Distinct variants of a word: its beginning with up to ``max_edits`` characters deleted, the first kept."""

    def one_less(texts: Column) -> Column:
        def of(text: Column) -> Column:
            without = lambda i: F.concat(F.substring(text, 1, i - 1), F.substring(text, i + 1, F.lit(prefix)))
            return F.when(F.length(text) > 0, F.transform(F.sequence(F.lit(1), F.length(text)), without)).otherwise(
                F.array().cast("array<string>")
            )

        return F.array_distinct(F.flatten(F.transform(texts, of)))

    head, tail = F.substring(word, 1, 1), F.substring(word, 2, prefix - 1)

    def levels(level: Column, left: int) -> Column:
        return level if left == 0 else let(level, lambda own: F.concat(own, levels(one_less(own), left - 1)))

    return F.transform(F.array_distinct(levels(F.array(tail), max_edits)), lambda v: F.concat(head, v))


def write_deletions(vocabulary: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store (variant, term, n) of a vocabulary (term, n) in buckets of variants, sorted within."""
    rows = vocabulary.where(F.col("term") != "").select(F.explode(deletions(F.col("term"))).alias("variant"), "term", "n")
    rows = rows.withColumn("bucket", F.pmod(F.hash("variant"), F.lit(buckets)))
    rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "variant").write.partitionBy("bucket").parquet(path)


def read_deletions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def suggest_batch(
    stored: DataFrame,
    vocabulary: DataFrame,
    words: DataFrame,
    n_docs: DataFrame,
    max_edits: int = MAX_EDITS,
    accuracy: float = ACCURACY,
    min_length: int = MIN_QUERY_LENGTH,
    max_query_frequency: float = MAX_QUERY_FREQUENCY,
    count: int = COUNT,
    alternative_count: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """(query, suggestion, distance, n, rank) for the misspelt ones among a table of ``words`` (query).

    ``stored``: the vocabulary's deletions; ``n_docs``: one number, of documents. Which words are looked
    at, and which are suggested in which order, is as in ``spelling.suggest``.
    """
    if max_edits > MAX_EDITS:
        raise ValueError(f"variants are stored for at most {MAX_EDITS} edits")
    known = vocabulary.select(F.col("term").alias("query"), F.col("n").alias("query_n"))
    considered = (
        words.select("query")
        .where(F.length("query") >= min_length)
        .distinct()
        .join(known, "query", "left")
        .withColumn("query_n", F.coalesce("query_n", F.lit(0)))
        .where(F.col("query_n") <= F.lit(max_query_frequency) * n_docs.scalar())
    )
    asked = considered.select("query", "query_n", F.explode(deletions(F.col("query"), max_edits)).alias("variant"))
    asked = asked.withColumn("bucket", F.pmod(F.hash("variant"), F.lit(buckets)))
    size = F.abs(F.length("query") - F.length("term"))
    met = asked.join(stored, ["bucket", "variant"]).where((F.col("query") != F.col("term")) & (size <= max_edits))
    met = met.select("query", "query_n", "term", "n").distinct()
    similarity = 1 - F.col("distance") / F.greatest(F.length("query"), F.length("term"))
    near = met.withColumn("distance", F.levenshtein("query", "term", max_edits)).where((F.col("distance") > 0) & (similarity >= accuracy))
    order = Window.partitionBy("query").orderBy("distance", F.col("n").desc(), "term")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    if alternative_count is not None:
        ranked = ranked.where((F.col("query_n") == 0) | (F.col("rank") <= alternative_count))
    return ranked.select("query", F.col("term").alias("suggestion"), "distance", "n", "rank")
