"""More like this: other articles sharing an article's most telling terms."""

from __future__ import annotations

from typing import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from broadsheet.functions.shape import let
from broadsheet.operators.analysis import PLAIN, Analyser, exploded_terms, exploded_vocabulary
from broadsheet.operators.search import bm25, read_index, read_statistics, read_vocabulary

# ---- fixed values -------------------------------------------------------------------
MAX_QUERY_TERMS = 25
MIN_TERM_FREQ = 2
MIN_DOC_FREQ = 5
COUNT = 3
MAX_IDS = 1024


def _field_words(df: DataFrame, keep: list[str], fields: Iterable[str], analyser: Analyser) -> DataFrame:
    """(keep, field, dl, words): one row per field that is present, tokenized once."""

    def item(f: str):
        return let(
            analyser.words(F.col(f)),
            lambda w: F.struct(F.lit(f).alias("field"), F.size(w).alias("dl"), w.alias("words")),
        )

    rows = df.select(*keep, F.inline_outer(F.array(*[item(f) for f in fields])))
    return rows.where(F.col("words").isNotNull())


def more_like_this(
    df: DataFrame,
    ids: Sequence,
    weights: Mapping[str, float],
    key: str = "id",
    count: int = COUNT,
    max_terms: int = MAX_QUERY_TERMS,
    min_tf: int = MIN_TERM_FREQ,
    min_df: int = MIN_DOC_FREQ,
    analyser: Analyser = PLAIN,
) -> DataFrame:
    """(seed, key, score, rank): the ``count`` best other articles for each of ``ids``.

    ``ids`` are normally one page of hits. The collection's tokens are joined with the ids' terms
    before anything is grouped; adaptive execution picks that join by measured size. The picked
    terms are at
    most ``max_terms`` per id, so their table is always small. Each intermediate table is used
    once, so nothing is recomputed.
    """
    if len(ids) > MAX_IDS:
        raise ValueError(f"at most {MAX_IDS} ids are allowed, got {len(ids)}")
    seeds = df.where(F.col(key).isin(*ids))
    fields = list(weights)
    seed_tf = (
        exploded_terms(seeds.select(F.col(key).alias("seed"), *fields), "seed", fields, analyser)
        .groupBy("seed", "field", "term")
        .agg(F.count(F.lit(1)).alias("seed_tf"))
        .where(F.col("seed_tf") >= min_tf)
    )
    per_field = (
        _field_words(df, [], weights, analyser)
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avg_dl"))
    )
    weighed = (
        exploded_vocabulary(df, fields, analyser)
        .join(seed_tf, ["field", "term"])
        .groupBy("seed", "field", "term", "seed_tf")
        .agg(F.count(F.lit(1)).alias("doc_freq"))
        .where(F.col("doc_freq") >= min_df)
        .join(per_field, "field")
        .withColumn("telling", F.col("seed_tf") * (1 + F.log((F.col("n") + 1) / (F.col("doc_freq") + 1))))
    )
    best_terms = Window.partitionBy("seed").orderBy(F.col("telling").desc(), "field", "term")
    picked = (
        weighed.withColumn("r", F.row_number().over(best_terms))
        .where(F.col("r") <= max_terms)
        .select("seed", "field", "term", "doc_freq", "n", "avg_dl")
    )

    # The length travels with the tokens, so no second table has to be joined on the key.
    tokens = _field_words(df, [key], weights, analyser).select(
        key, "field", "dl", F.explode_outer("words").alias("term")
    )
    doc_tf = (
        tokens.join(F.broadcast(picked), ["field", "term"])
        .where(F.col(key) != F.col("seed"))
        .groupBy("seed", key, "field", "dl", "term", "doc_freq", "n", "avg_dl")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    weight = F.lit(0.0)
    for f, w in weights.items():
        weight = F.when(F.col("field") == f, float(w)).otherwise(weight)
    part = weight * bm25(F.col("tf"), F.col("dl"), F.col("n"), F.col("avg_dl"), F.col("doc_freq"))
    scores = doc_tf.groupBy("seed", key).agg(F.round(F.sum(part), 6).alias("score"))
    ranking = Window.partitionBy("seed").orderBy(F.col("score").desc(), F.col(key).asc())
    return scores.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= count)


def more_like_this_index(
    df: DataFrame,
    path: str,
    ids: Sequence,
    weights: Mapping[str, float],
    key: str = "id",
    count: int = COUNT,
    max_terms: int = MAX_QUERY_TERMS,
    min_tf: int = MIN_TERM_FREQ,
    min_df: int = MIN_DOC_FREQ,
    analyser: Analyser = PLAIN,
) -> DataFrame:
    """``more_like_this`` from a stored index of ``df``: only the rows of ``ids`` are tokenized.

    Frequencies come from the stored vocabulary, lengths and scores from the buckets of the terms that
    are picked, at most ``max_terms`` for each of ``ids``; these few terms reach the driver.
    """
    if len(ids) > MAX_IDS:
        raise ValueError(f"at most {MAX_IDS} ids are allowed, got {len(ids)}")
    spark, fields = df.sparkSession, list(weights)
    seeds = df.where(F.col(key).isin(*ids)).select(F.col(key).alias("seed"), *fields)
    seed_tf = (
        exploded_terms(seeds, "seed", fields, analyser)
        .groupBy("seed", "field", "term")
        .agg(F.count(F.lit(1)).alias("seed_tf"))
        .where(F.col("seed_tf") >= min_tf)
    )
    weighed = (
        read_vocabulary(spark, path)
        .where(F.col("n") >= min_df)
        .withColumnRenamed("n", "doc_freq")
        .join(seed_tf, ["field", "term"])
        .join(read_statistics(spark, path), "field")
        .withColumn("telling", F.col("seed_tf") * (1 + F.log((F.col("n") + 1) / (F.col("doc_freq") + 1))))
    )
    best_terms = Window.partitionBy("seed").orderBy(F.col("telling").desc(), "field", "term")
    chosen = weighed.withColumn("r", F.row_number().over(best_terms)).where(F.col("r") <= max_terms)
    kind = dict(df.dtypes)[key]
    rows = chosen.select("seed", "field", "term", "doc_freq", "n", "avg_dl").collect()
    picked = spark.createDataFrame(
        [tuple(r) for r in rows], f"seed {kind}, field string, term string, doc_freq bigint, n bigint, avg_dl double"
    )
    terms = sorted({r["term"] for r in rows})
    postings = spark.read.parquet(f"{path}/postings").where("false") if not terms else _of_terms(spark, path, terms)
    weight = F.lit(0.0)
    for f, w in weights.items():
        weight = F.when(F.col("field") == f, float(w)).otherwise(weight)
    part = weight * bm25(F.col("tf"), F.col("dl"), F.col("n"), F.col("avg_dl"), F.col("doc_freq"))
    scores = (
        postings.where(F.col("field").isin(*fields))
        .select(key, "field", "term", "tf", "dl")
        .join(F.broadcast(picked), ["field", "term"])
        .where(F.col(key) != F.col("seed"))
        .groupBy("seed", key)
        .agg(F.round(F.sum(part), 6).alias("score"))
    )
    ranking = Window.partitionBy("seed").orderBy(F.col("score").desc(), F.col(key).asc())
    return scores.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= count)


def _of_terms(spark: SparkSession, path: str, terms: Sequence[str]) -> DataFrame:
    """Postings of any number of terms, in portions of as many as one query may have."""
    out = None
    for at in range(0, len(terms), MAX_IDS):
        rows, _ = read_index(spark, path, terms[at : at + MAX_IDS])
        out = rows if out is None else out.unionByName(rows)
    return out
