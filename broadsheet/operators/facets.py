"""Facets: counts by value, by predicate, by range and nested."""

from __future__ import annotations

import math
from decimal import Decimal
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_MONTHS = {"MONTH": 1, "YEAR": 12}
_MICROS = {"SECOND": 1_000_000, "MINUTE": 60_000_000, "HOUR": 3_600_000_000, "DAY": 86_400_000_000}


def _values(df: DataFrame, field: str) -> Column:
    """The field's values as an array of strings: multi-valued fields as they are."""
    col = F.col(field)
    if isinstance(df.schema[field].dataType, T.ArrayType):
        return F.coalesce(col.cast("array<string>"), F.array().cast("array<string>"))
    return F.array(col.cast("string"))


def facet_fields(df: DataFrame, fields: Sequence[str], mincount: int = 1, limit: int | None = None) -> DataFrame:
    """(field, value, n) for several fields in one scan; NULLs are not counted.

    Counts combine before the shuffle, so a value held by most rows costs no more than others.
    ``limit`` keeps each field's first values by count, then by value.
    """

    def tagged(f: str) -> Column:
        return F.transform(_values(df, f), lambda v: F.struct(F.lit(f).alias("field"), v.alias("value")))

    counts = (
        df.select(F.inline(F.concat(*[tagged(f) for f in fields])))
        .where(F.col("value").isNotNull())
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= mincount)
    )
    if limit is None:
        return counts
    rank = Window.partitionBy("field").orderBy(F.col("n").desc(), F.col("value").asc())
    return counts.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= limit).drop("rank")


def facet_field(df: DataFrame, field: str, mincount: int = 1, limit: int | None = None) -> DataFrame:
    """(value, n), largest first; ties by value."""
    value = F.explode(field) if isinstance(df.schema[field].dataType, T.ArrayType) else F.col(field)
    counts = (
        df.select(value.alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= mincount)
        .orderBy(F.col("n").desc(), F.col("value").asc())
    )
    return counts if limit is None else counts.limit(limit)


def facet_query(df: DataFrame, predicates: Mapping[str, Column], mincount: int = 1) -> DataFrame:
    """(query, n): one count per named predicate, all in one pass."""
    totals = df.agg(*[F.count_if(p).alias(f"c{i}") for i, p in enumerate(predicates.values())])
    rows = [
        F.struct(F.lit(name).alias("query"), F.col(f"c{i}").alias("n")) for i, name in enumerate(predicates)
    ]
    return totals.select(F.inline(F.array(*rows))).where(F.col("n") >= mincount)


def facet_range(
    df: DataFrame,
    field: str,
    start: float,
    end: float,
    gap: float,
    other: Sequence[str] = (),
    mincount: int = 1,
) -> DataFrame:
    """(bucket, lower, n) over half-open numeric buckets ``[lower, lower + gap)``.

    The last bucket is always whole, so ``end`` rounds up to it. Bounds are decimals, so a gap of
    0.1 has exact ones. ``other`` adds ``before``, ``between`` and ``after`` rows, or all three
    (``all``) or none (``none``); they are kept also when zero. ``mincount`` 0 gives empty
    buckets too.
    """
    if gap <= 0:
        raise ValueError("gap must be positive")
    first, step = Decimal(str(start)), Decimal(str(gap))
    n_buckets = math.ceil((Decimal(str(end)) - first) / step)
    value = F.col(field).cast("double")

    def bound(k: Column) -> Column:
        return (F.lit(first) + k.cast("decimal(18,0)") * F.lit(step)).cast("double")

    # The quotient of doubles may be off by one at a bound, so it is checked against the bounds.
    guess = F.greatest(F.lit(-1), F.least(F.lit(n_buckets), F.floor((value - float(first)) / float(step)))).cast("long")
    index = F.when(value < bound(guess), guess - 1).when(value >= bound(guess + 1), guess + 1).otherwise(guess)
    rows = df.where(value.isNotNull()).select(value.alias("value"), index.alias("index"))
    kind = F.when(F.col("value") < float(first), "before").when(F.col("index") >= n_buckets, "after").otherwise("range")
    placed = rows.select(kind.alias("bucket"), F.when(kind == "range", bound(F.col("index"))).alias("lower"))
    every = df.sparkSession.range(n_buckets).select(bound(F.col("id")).alias("lower"))
    return _range_counts(placed, other, mincount, every)


def facet_range_dates(
    df: DataFrame,
    field: str,
    start: Column,
    end: Column,
    gap: int,
    unit: str,
    other: Sequence[str] = (),
    mincount: int = 1,
) -> DataFrame:
    """(bucket, lower, n) over calendar buckets; ``gap`` counts ``unit`` (SECOND … YEAR).

    ``start`` and ``end`` are constant expressions, e.g. ``rounded(F.now(), "YEAR", -10)``.
    Buckets are found by arithmetic, not by a range join.
    """
    if gap <= 0:
        raise ValueError("gap must be positive")
    unit = unit.upper()
    rows = df.where(F.col(field).isNotNull()).select(F.col(field).cast("timestamp").alias("v"))

    if unit in _MONTHS:
        months = gap * _MONTHS[unit]

        def bound(k: Column) -> Column:
            return F.timestamp_add("MONTH", (k * months).cast("int"), start)

        def index_of(ts: Column) -> Column:
            # Whole gaps between the instants; the estimate may be one too high or low at a
            # bucket's edge because months differ in length, so it is checked against bounds.
            apart = (F.year(ts) - F.year(start)) * 12 + F.month(ts) - F.month(start)
            k = F.floor(apart / months)
            return F.when(ts < bound(k), k - 1).when(ts >= bound(k + 1), k + 1).otherwise(k)
    else:
        micros = gap * _MICROS[unit]

        def bound(k: Column) -> Column:
            return F.timestamp_micros(F.unix_micros(start) + k * micros)

        def index_of(ts: Column) -> Column:
            return F.floor((F.unix_micros(ts) - F.unix_micros(start)) / micros)

    last = index_of(end)
    n_buckets = F.when(bound(last) < end, last + 1).otherwise(last)
    index = index_of(F.col("v"))
    kind = F.when(F.col("v") < start, "before").when(index >= n_buckets, "after").otherwise("range")
    placed = rows.select(kind.alias("bucket"), F.when(kind == "range", bound(index)).alias("lower"))
    one = df.sparkSession.range(1)
    every = one.select(F.explode(F.sequence(F.lit(0).cast("long"), n_buckets.cast("long") - 1)).alias("k"))
    return _range_counts(placed, other, mincount, every.select(bound(F.col("k")).alias("lower")))


def _others(names: Sequence[str]) -> list[str]:
    """The rows beside the buckets that are asked for."""
    known = ["before", "between", "after"]
    unknown = set(names) - {*known, "all", "none"}
    if unknown:
        raise ValueError(f"unknown rows beside the buckets: {sorted(unknown)}")
    if "none" in names:
        return []
    return [k for k in known if k in names or "all" in names]


def _range_counts(placed: DataFrame, other: Sequence[str], mincount: int, every: DataFrame) -> DataFrame:
    """Counts by bucket; ``every`` lists the lower bounds of all buckets, for those without rows."""
    other = _others(other)
    counts = placed.groupBy("bucket", "lower").agg(F.count(F.lit(1)).alias("n"))
    in_range = counts.where((F.col("bucket") == "range") & (F.col("n") >= mincount))
    if mincount <= 0:
        in_range = every.join(in_range.drop("bucket"), "lower", "left").select(
            F.lit("range").alias("bucket"), "lower", F.coalesce("n", F.lit(0)).cast("long").alias("n")
        )
    if not other:
        return in_range
    meant = {"before": "before", "between": "range", "after": "after"}
    outside = placed.agg(*[F.count_if(F.col("bucket") == meant[o]).alias(o) for o in other])
    lower_type = placed.schema["lower"].dataType
    rows = [
        F.struct(F.lit(o).alias("bucket"), F.lit(None).cast(lower_type).alias("lower"), F.col(o).alias("n"))
        for o in other
    ]
    return in_range.unionByName(outside.select(F.inline(F.array(*rows))))


def rounded(ts: Column, unit: str, plus: int = 0) -> Column:
    """Date rounded down to a unit, then moved by ``plus`` units."""
    return F.timestamp_add(unit.upper(), F.lit(plus), F.date_trunc(unit, ts))


def facet_pivot(df: DataFrame, outer: str, inner: str, mincount: int = 1) -> DataFrame:
    """(level, outer, inner, n): counts per outer value and per pair within it.

    Pairs are counted first; the outer counts are summed from those few rows.
    """
    pairs = (
        df.where(F.col(outer).isNotNull()).groupBy(outer, inner).agg(F.count(F.lit(1)).alias("n"))
    )
    both = pairs.groupingSets([[F.col(outer)], [F.col(outer), F.col(inner)]], outer, inner).agg(
        F.sum("n").alias("n"), F.grouping(inner).alias("g")
    )
    level = F.when(F.col("g") == 1, 1).otherwise(2)
    return (
        both.where(((F.col("g") == 1) | F.col(inner).isNotNull()) & (F.col("n") >= mincount))
        .select(level.alias("level"), F.col(outer), F.col(inner), "n")
    )
