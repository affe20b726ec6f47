"""Where registered queries are kept, and lazy access to the given tables."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """The given tables by name, read when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, deal: int = 0):
        """``deal``: deal rows out to so many partitions first, for files of one row group, which
        no setting can split. Only timings on one machine want this."""
        self.spark = spark
        self._deal = deal
        self._folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self._folder}/{name}.parquet")
        return df.repartition(self._deal) if self._deal and name in ("documents", "pages", "part") else df


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function from ``Tables`` to the query's DataFrame, with its SQL."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(build, sql)
        return build

    return add


def tokens_sql(text: str) -> str:
    """SQL for the tokens of a text expression."""
    return (
        rf"list_filter(regexp_split_to_array(lower({text}), '[^\p{{L}}\p{{N}}]+'), lambda tk: tk <> '')"
    )
