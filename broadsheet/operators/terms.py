"""Term lists, term vectors and field statistics."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from broadsheet.operators.analysis import PLAIN, Analyser, exploded_vocabulary, term_runs


def document_frequencies(df: DataFrame, field: str, analyser: Analyser = PLAIN, prefix: str = "") -> DataFrame:
    """(term, n): in how many rows a term occurs.

    Each row lists its distinct terms itself, so counting is one combinable aggregate.
    """
    words = F.array_distinct(analyser.words(F.col(field)))
    if prefix:
        words = F.filter(words, lambda t: t.startswith(prefix))
    return df.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def terms(df: DataFrame, field: str, prefix: str = "", limit: int = 10, analyser: Analyser = PLAIN) -> DataFrame:
    """Completion list: most frequent terms with a prefix; ties by term."""
    found = document_frequencies(df, field, analyser, prefix)
    return found.orderBy(F.col("n").desc(), F.col("term").asc()).limit(limit)


def term_vectors(df: DataFrame, key: str, field: str, analyser: Analyser = PLAIN) -> DataFrame:
    """(key, terms): each row's terms with their frequency, ordered by term."""
    runs = F.transform(
        term_runs(analyser.terms(F.col(field))), lambda r: F.struct(r["term"].alias("term"), r["tf"].alias("tf"))
    )
    return df.select(F.col(key), runs.alias("terms")).where(F.size("terms") > 0)


def terms_of_index(vocabulary: DataFrame, field: str, prefix: str = "", limit: int = 10) -> DataFrame:
    """The completion list of a stored vocabulary; field and prefix reach the scan."""
    found = vocabulary.where((F.col("field") == field) & F.col("term").startswith(prefix)).select("term", "n")
    return found.orderBy(F.col("n").desc(), F.col("term").asc()).limit(limit)


def _field_terms(df: DataFrame, fields: Sequence[str], analyser: Analyser) -> DataFrame:
    """(field, term, n) document frequencies of several fields in one scan."""
    return exploded_vocabulary(df, fields, analyser).groupBy("field", "term").agg(F.count(F.lit(1)).alias("n"))


def field_stats(df: DataFrame, fields: Sequence[str], analyser: Analyser = PLAIN) -> DataFrame:
    """(field, docs, distinct_terms): how many rows have the field, how many terms it holds."""
    docs = df.agg(*[F.count(f).alias(f"c{i}") for i, f in enumerate(fields)]).select(
        F.inline(
            F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"c{i}").alias("docs")) for i, f in enumerate(fields)])
        )
    )
    distinct = _field_terms(df, fields, analyser).groupBy("field").agg(F.count(F.lit(1)).alias("distinct_terms"))
    return docs.join(distinct, "field", "left").select(
        "field", "docs", F.coalesce("distinct_terms", F.lit(0)).cast("bigint").alias("distinct_terms")
    )


def top_field_terms(df: DataFrame, fields: Sequence[str], limit: int = 10, analyser: Analyser = PLAIN) -> DataFrame:
    """(field, term, n, rank): each field's most frequent terms."""
    rank = Window.partitionBy("field").orderBy(F.col("n").desc(), F.col("term").asc())
    return _field_terms(df, fields, analyser).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= limit)


def frequency_histogram(df: DataFrame, fields: Sequence[str], analyser: Analyser = PLAIN) -> DataFrame:
    """(field, bucket, n): number of terms by document frequency, in powers of two.

    Bucket ``b`` holds the terms found in more than ``b / 2`` and at most ``b`` rows.
    """
    power = F.ceil(F.log2("n")).cast("int")
    bucket = F.pow(F.lit(2.0), power).cast("bigint")
    return (
        _field_terms(df, fields, analyser)
        .select("field", bucket.alias("bucket"))
        .groupBy("field", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
