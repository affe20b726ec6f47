"""Job counters as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

GOOD, FAILED = "GOOD", "FAILED"


def status_counts(outcomes: DataFrame) -> DataFrame:
    """(status, n): documents per outcome, from rows (status, n)."""
    return outcomes.groupBy("status").agg(F.sum("n").alias("n"))


def shard_counts(articles: DataFrame, failed: str | None = None) -> DataFrame:
    """(key, n) per shard: documents added under the shard's number, ``TOTAL``, ``FAILURES``.

    ``failed`` names a boolean column; without it nothing failed.
    """
    bad = F.coalesce(F.col(failed), F.lit(False)) if failed else F.lit(False)
    per_shard = articles.groupBy("shard").agg(F.count(F.lit(1)).alias("total"), F.count_if(bad).alias("failures"))
    shard = F.col("shard").cast("string")
    rows = F.array(
        F.struct(shard.alias("key"), (F.col("total") - F.col("failures")).alias("n")),
        F.struct(F.concat(F.lit("TOTAL "), shard).alias("key"), F.col("total").alias("n")),
        F.struct(F.concat(F.lit("FAILURES "), shard).alias("key"), F.col("failures").alias("n")),
    )
    return per_shard.select(F.inline(rows))


def articles_per_issue(articles: DataFrame) -> DataFrame:
    return articles.groupBy("issue_domid_l").agg(F.count(F.lit(1)).alias("n"))
