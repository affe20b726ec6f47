"""Hits grouped by a field."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.functions.shape import computed


def group_hits(hits: DataFrame, field: str, order: Sequence[Column], per_group: int = 1, groups: int | None = 10) -> DataFrame:
    """Top hits of each group, with the group's size and rank and the total of all matches.

    Groups rank by their best hit. The per-group top-k is cut on each partition before the
    shuffle, and sizes are a separate combinable count, so a group holding most of the hits
    never gathers in one task. Rows without a value form one group of their own.
    """
    in_group = Window.partitionBy(field).orderBy(*order)
    ranked = hits.withColumn("rank_in_group", F.row_number().over(in_group))
    top = ranked.where(F.col("rank_in_group") <= per_group)
    sizes = hits.groupBy(field).agg(F.count(F.lit(1)).alias("group_size"))
    total = sizes.agg(F.sum("group_size").alias("matches"))
    # The rank is fixed before it is tested again, so that both uses of ``top`` are the same
    # plan and the second one reuses the first one's shuffle.
    best = computed(top, hits.columns, [F.col("rank_in_group").alias("_rank")])
    heads = best.where(F.col("_rank") == 1).orderBy(*order)
    if groups is not None:
        heads = heads.limit(groups)
    shown = heads.select(F.col(field).alias("_g"))
    out = (
        top.join(shown, F.col(field).eqNullSafe(F.col("_g")))
        .drop("_g")
        .join(sizes.withColumnRenamed(field, "_g"), F.col(field).eqNullSafe(F.col("_g")))
        .drop("_g")
    )
    return out.withColumn("matches", total.scalar())
