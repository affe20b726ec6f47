"""Sharded article output and status counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from broadsheet.functions.naming import shard_of


def with_shard(articles: DataFrame, shards: int = 4, key: str = "id") -> DataFrame:
    return articles.withColumn("shard", shard_of(F.col(key), shards))


def write_shards(articles: DataFrame, path: str, shards: int = 4, key: str = "id") -> None:
    """Write one directory per shard.

    A shard is a directory, not a task: the rebalance groups rows by shard and splits a shard
    into as many files of the advisory size as its volume needs.
    """
    placed = with_shard(articles, shards, key).hint("rebalance", "shard")
    placed.write.mode("errorifexists").partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_status(counters: DataFrame, path: str) -> None:
    """Counters (key, n) as tab-separated text. There are a handful of keys, so one file."""
    counters.select("key", "n").coalesce(1).write.mode("errorifexists").option("sep", "\t").csv(path)
