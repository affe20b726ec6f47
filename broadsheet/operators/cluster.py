"""Clustering of hits by their wording, with labels."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import DataFrame, Window, functions as F

from broadsheet.operators.analysis import PLAIN, Analyser
from broadsheet.session import shared_dir

# ---- fixed values -------------------------------------------------------------------
CLUSTERS = 20


def cluster_hits(
    hits: DataFrame,
    field: str,
    key: str = "id",
    k: int = CLUSTERS,
    features: int = 1 << 14,
    label_terms: int = 3,
    seed: int = 42,
    iterations: int = 10,
    analyser: Analyser = PLAIN,
) -> DataFrame:
    """(key, cluster, label): TF-IDF vectors grouped by k-means.

    Terms are hashed to ``features`` places, so no vocabulary is gathered; only the ``k`` centres
    come to the driver. A cluster's label is the terms with the greatest summed weight in it.
    """
    words = hits.select(F.col(key), F.coalesce(analyser.words(F.col(field)), F.array().cast("array<string>")).alias("words"))
    # Each pass below reads these rows as they lie, so texts are analysed once and k-means draws from the same partitions.
    counted = HashingTF(inputCol="words", outputCol="tf", numFeatures=features).transform(words).persist(StorageLevel.DISK_ONLY)
    vectors = IDF(inputCol="tf", outputCol="features").fit(counted).transform(counted).select(key, "words", "features")
    model = KMeans(k=k, seed=seed, maxIter=iterations, featuresCol="features", predictionCol="cluster").fit(vectors)
    path = shared_dir(hits.sparkSession, "clusters")
    placed = model.transform(vectors).select(key, "words", "cluster")
    placed.write.parquet(path)
    counted.unpersist()
    placed = hits.sparkSession.read.schema(placed.schema).parquet(path)
    # Occurrences of a term, and hits with it, of each cluster.
    told = lambda terms, new: F.transform(terms, lambda x: F.struct(x.alias("term"), F.lit(new).alias("new")))
    terms = F.explode(F.concat(told(F.col("words"), False), told(F.array_distinct("words"), True)))
    per_cluster = (
        placed.select("cluster", terms.alias("x")).groupBy("cluster", "x.term").agg(F.count_if(~F.col("x.new")).alias("tf"), F.count_if("x.new").alias("hits"))
    )
    per_cluster = per_cluster.withColumn("df", F.sum("hits").over(Window.partitionBy("term")))
    words = placed
    n = words.agg(F.count(F.lit(1)).alias("n"))
    weighed = per_cluster.withColumn("weight", F.col("tf") * F.log((n.scalar() + 1) / (F.col("df") + 1)))
    best = Window.partitionBy("cluster").orderBy(F.col("weight").desc(), "term")
    labels = (
        weighed.where(F.col("weight") > 0)
        .withColumn("r", F.row_number().over(best))
        .where(F.col("r") <= label_terms)
        .groupBy("cluster")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "term"))), lambda x: x["term"]), ", ").alias("label"))
    )
    return placed.select(key, "cluster").join(labels, "cluster", "left").select(key, "cluster", F.coalesce("label", F.lit("")).alias("label"))
