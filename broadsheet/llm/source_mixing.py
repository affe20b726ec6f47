"""Mixing sources to target weights by Poisson replication, with built-in functions only.

A source with share w of the target and size n (its texts' code points, all sources' T) is to be
repeated at the mean rate w * T * ``scale`` / n. Each document gets a count from the Poisson
distribution with its source's rate: the inverse distribution function at a number that hashes
the document's id and a seed. Each document is exploded by its count, and all copies are
ordered by a hash, so that neighbours in the output are unrelated.

A rate above ``PART`` is the sum of equal parts, each with a number of its own: a sum of
Poisson counts is Poisson, and no term underflows.

Cases: a null source is a source of its own; a null id hashes like any other value; a null text
has size 0 and the rate of its source; a source without code points has rate 0, as has one
without a weight; repeated rows are decided alike; an empty table gives no rows; the columns
``copy``, ``rate`` and ``position`` replace columns of these names, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions.shape import let
from broadsheet.llm.work import stored

PART = 64.0
SEED = 17
_DIGITS = 13  # hexadecimal digits of a hash, which fit a double exactly


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _DIGITS), 16, 10).cast("double") / float(16**_DIGITS)


def poisson_count(rate: Column, draw: Column) -> Column:
    """The least k whose distribution function exceeds ``draw``."""
    steps = F.sequence(F.lit(1), F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int"))
    zero = F.struct(F.exp(-rate).alias("term"), F.exp(-rate).alias("reached"), F.lit(0).alias("count"))

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * rate / k
        return F.struct(
            term.alias("term"),
            (state["reached"] + term).alias("reached"),
            (state["count"] + (state["reached"] <= draw).cast("int")).alias("count"),
        )

    return F.aggregate(steps, zero, step, lambda s: s["count"])


def source_rates(docs: DataFrame, weights: DataFrame | None = None, scale: float = 1.0, power: float = 0.5,
                 source: str = "source", text: str = "text") -> DataFrame:
    """(source, size, weight, rate) of each source.

    ``weights``: (source, weight), any positive numbers; without it a source weighs its size to
    the ``power``, so that large sources are thinned and small ones repeated.
    """
    sizes = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(
        F.coalesce(F.sum(F.length(F.col(f"`{text}`"))), F.lit(0)).cast("double").alias("size")
    )
    if weights is None:
        told = sizes.withColumn("weight", F.pow("size", F.lit(power)))
    else:
        own = weights.select(F.col("source").alias("s"), F.col("weight").cast("double").alias("weight"))
        told = sizes.join(own, F.col("source").eqNullSafe(F.col("s")), "left").drop("s").fillna(0.0, ["weight"])
    sizes_sum, weights_sum = told.agg(F.sum("size"), F.sum("weight")).first()
    if not sizes_sum or not weights_sum:
        return told.withColumn("rate", F.lit(0.0))
    # Rounded, so that the order in which sums were taken can't show.
    rate = F.round(F.col("weight") / weights_sum * sizes_sum * scale / F.col("size"), 9)
    return told.withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(0.0))


def replicated(docs: DataFrame, rates: DataFrame, seed: int = SEED, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """Each document as often as its Poisson count: all columns, and (copy, rate)."""
    kept = [c for c in docs.columns if c.lower() not in ("copy", "rate", "position")]
    own = rates.select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    joined = docs.select(*[F.col(f"`{c}`") for c in kept]).join(
        own, F.col(f"`{source}`").eqNullSafe(F.col("__source"))
    )
    parts = F.greatest(F.lit(1), F.ceil(F.col("__rate") / PART)).cast("int")
    one = lambda i: let(
        uniform(F.col(f"`{doc_id}`"), F.lit(seed), i), lambda u: poisson_count(F.col("__rate") / parts, u)
    )
    count = F.aggregate(F.transform(F.sequence(F.lit(1), parts), one), F.lit(0), lambda s, x: s + x)
    return (
        joined.withColumn("__count", count)
        .where(F.col("__count") > 0)
        .select(
            *[F.col(f"`{c}`") for c in kept],
            F.explode(F.sequence(F.lit(1), F.col("__count"))).alias("copy"),
            F.col("__rate").alias("rate"),
        )
    )


def mixed_sources(docs: DataFrame, weights: DataFrame | None = None, scale: float = 1.0, power: float = 0.5, seed: int = SEED,
                  doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mixture in shuffled order: all columns, and (copy, rate, position).

    ``position`` in [0, 1) is the hash by which copies are in order.
    """
    # Written, so that the rates' size is known before any text moves: sources are few, and then none does here.
    rates = stored(source_rates(docs, weights, scale, power, source, text), "source-rates")
    copies = replicated(docs, rates, seed, doc_id, source)
    return copies.withColumn("position", uniform(F.col(f"`{doc_id}`"), F.lit(seed), F.lit("position"), F.col("copy"))).orderBy("position")
