"""Keeping the article table up to date: upsert, delete, de-duplicate, append and compact."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from broadsheet.functions.naming import signature

NO_ID = "NO_ID"


def latest_per_key(df: DataFrame, key: str, order: Column | str) -> DataFrame:
    """The last row per key by ``order``; rows without a key are left out.

    The top-1 is cut on each partition before the shuffle, so a key repeated millions of times
    does not gather in one task.
    """
    order = F.col(order) if isinstance(order, str) else order
    last = Window.partitionBy(key).orderBy(order.desc())
    return (
        df.where(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(last))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def without_id(df: DataFrame, key: str = "id") -> DataFrame:
    """Rows that cannot be indexed because they have no id."""
    return df.where(F.col(key).isNull()).withColumn("reason", F.lit(NO_ID))


def upsert(index: DataFrame, batch: DataFrame, order: Column | str, key: str = "id") -> DataFrame:
    """Index after adding a batch: rows with a known id are replaced, the batch's last row wins."""
    fresh = latest_per_key(batch, key, order).select(*index.columns)
    return index.join(fresh.select(key), key, "left_anti").select(*index.columns).unionByName(fresh)


def delete_by_query(index: DataFrame, predicate: Column) -> DataFrame:
    """Index without the rows a predicate holds for; an unknown result keeps the row."""
    return index.where(~F.coalesce(predicate, F.lit(False)))


def signature_dedupe(df: DataFrame, fields: Sequence[str], key: str = "id") -> DataFrame:
    """One row per distinct content of ``fields``: the one with the lowest key.

    Adds ``signature``. Copies are cut on each partition before the shuffle.
    """
    signed = df.withColumn("signature", signature(*[F.col(f) for f in fields]))
    first = Window.partitionBy("signature").orderBy(F.col(key).asc())
    return signed.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") == 1).drop("_rank")


def union_batches(*batches: DataFrame) -> DataFrame:
    """Bag union by column name."""
    out = batches[0]
    for batch in batches[1:]:
        out = out.unionByName(batch)
    return out


def append_batch(batch: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch to the table's log. Repeating a batch id rewrites that batch only.

    A batch costs what it holds: the rest of the table is neither read nor rewritten.
    """
    batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def current_articles(log: DataFrame, key: str = "id", order: str = "batch_id") -> DataFrame:
    """The table's present content: each id's row from the latest batch."""
    return latest_per_key(log, key, order).drop("batch_id")


def commit(articles: DataFrame, path: str, version: int) -> str:
    """Write a complete new version next to the old ones and return its folder.

    Readers keep the version they have open; it becomes visible as a whole when the write's
    success marker appears (see ``latest_version``).
    """
    target = f"{path}/v={version:010d}"
    articles.write.mode("overwrite").parquet(target)
    return target


def latest_version(spark: SparkSession, path: str) -> tuple[int, DataFrame] | None:
    """Highest version whose write has finished, or None."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{path}/v=*/_SUCCESS")) or []
    versions = sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)
    if not versions:
        return None
    return versions[-1], spark.read.parquet(f"{path}/v={versions[-1]:010d}")
