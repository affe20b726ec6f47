"""Field statistics from sketches that are written per batch and merged when asked, without rereading rows.

Per batch, field and group one row holds the number of rows and of values, a sketch of the distinct
values (HyperLogLog), one of the keys that have the field (theta, for overlaps and differences) and, for
numbers, one of their order (KLL, for quantiles). A batch's rows are a few kilobytes however large it is;
merging is a combinable aggregate over them.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.operators.maintain import append_batch

# ---- fixed values: sizes of the sketches, as powers of two, and what errors they bring ---
DISTINCT_BITS = 12  # about 1.6 % standard error
KEY_BITS = 12  # about 1.6 %
ORDER_K = 400  # ranks within about 0.7 %


def batch_sketches(df: DataFrame, fields: Sequence[str], key: str = "id", group: Column | None = None) -> DataFrame:
    """(group, field, rows, present, distinct, keys, order): one row a group and field of a batch.

    ``order`` is there for numeric fields only. Values and numbers that are null are absent.
    """
    kinds = dict(df.dtypes)
    numeric = lambda f: kinds[f] in ("tinyint", "smallint", "int", "bigint", "float", "double") or kinds[f].startswith("decimal")
    items = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"), F.col(f).cast("string").alias("value"),
                (F.col(f).cast("double") if numeric(f) else F.lit(None).cast("double")).alias("number"),
            )
            for f in fields
        ]
    )
    name = F.lit("") if group is None else F.coalesce(group.cast("string"), F.lit(""))
    rows = df.select(name.alias("group"), F.col(key).cast("string").alias("key"), F.inline(items))
    present = F.col("value").isNotNull()
    return rows.groupBy("group", "field").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("present"),
        F.hll_sketch_agg("value", F.lit(DISTINCT_BITS)).alias("distinct"),
        F.theta_sketch_agg(F.when(present, F.col("key")), F.lit(KEY_BITS)).alias("keys"),
        F.kll_sketch_agg_double("number", F.lit(ORDER_K)).alias("order"),
    )


def write_sketches(df: DataFrame, path: str, batch_id: int, fields: Sequence[str], key: str = "id", group: Column | None = None) -> None:
    """Store a batch's sketches under its id; repeating a batch replaces them."""
    append_batch(batch_sketches(df, fields, key, group), path, batch_id)


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """(field, rows, present, distinct, keys, order) over all batches and groups of ``sketches``."""
    return sketches.groupBy("field").agg(
        F.sum("rows").alias("rows"),
        F.sum("present").alias("present"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.theta_union_agg("keys").alias("keys"),
        F.kll_merge_agg_double("order").alias("order"),
    )


def sketch_stats(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(field, rows, present, distinct_values, quantiles): estimates from sketches alone."""
    numbers = F.kll_sketch_get_n_double("order") > 0
    at = F.array(*[F.lit(float(q)) for q in quantiles])
    return merged_sketches(sketches).select(
        "field",
        "rows",
        "present",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        F.when(numbers, F.kll_sketch_get_quantile_double("order", at)).alias("quantiles"),
    )


def sketch_overlap(sketches: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """(a, b, a_keys, b_keys, both, only_a): how many rows have two fields, or one without the other."""
    merged = merged_sketches(sketches).select("field", "keys")
    merged = merged if fields is None else merged.where(F.col("field").isin(*fields))
    a, b = (merged.select(F.col("field").alias(x), F.col("keys").alias(f"{x}_sketch")) for x in "ab")
    pairs = a.join(b, F.col("a") < F.col("b"))  # a row a field: as many pairs as fields squared
    estimate = lambda c: F.theta_sketch_estimate(c)
    return pairs.select(
        "a", "b", estimate("a_sketch").alias("a_keys"), estimate("b_sketch").alias("b_keys"),
        estimate(F.theta_intersection("a_sketch", "b_sketch")).alias("both"),
        estimate(F.theta_difference("a_sketch", "b_sketch")).alias("only_a"),
    )


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
