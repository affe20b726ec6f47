"""Spelling suggestions for query terms, word breaks, and rewritten queries."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from broadsheet.operators.analysis import PLAIN, Analyser
from broadsheet.operators.filters import check_terms
from broadsheet.operators.query_terms import all_terms, analysed

# ---- fixed values -------------------------------------------------------------------
MAX_EDITS = 2
MIN_PREFIX = 1
ACCURACY = 0.5
MIN_QUERY_LENGTH = 4
MAX_QUERY_FREQUENCY = 0.01
COUNT = 5
ALTERNATIVE_COUNT = 2
MAX_CHANGES = 10
MAX_RESULTS_FOR_SUGGEST = 5
MAX_COLLATIONS = 3
MAX_COLLATION_TRIES = 5


def _word_counts(df: DataFrame, field: str, analyser: Analyser, test) -> DataFrame:
    """(term, n): document frequency of the vocabulary words that pass ``test``."""
    words = F.filter(F.array_distinct(analyser.words(F.col(field))), test)
    return df.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def suggest(
    df: DataFrame,
    field: str,
    terms: Sequence[str],
    max_edits: int = MAX_EDITS,
    accuracy: float = ACCURACY,
    min_length: int = MIN_QUERY_LENGTH,
    max_query_frequency: float = MAX_QUERY_FREQUENCY,
    count: int = COUNT,
    alternative_count: int | None = None,
    analyser: Analyser = PLAIN,
    stored: DataFrame | None = None,
) -> DataFrame:
    """(query, suggestion, distance, n, rank) for the query terms that look misspelt.

    A term is considered if it has at least ``min_length`` characters and occurs in at most a
    share ``max_query_frequency`` of the rows. Suggestions share its first character, are at
    most ``max_edits`` away and similar enough; they rank by distance, then frequency, then
    term. ``alternative_count`` limits the list for terms that do occur.

    Words that cannot be near any query term are dropped inside each row, before counting. With
    ``stored``, the field's vocabulary (term, n) of an index, no row is tokenized.
    """
    spark = df.sparkSession
    asked = [t for t in all_terms(analysed(spark, terms, analyser)) if len(t) >= min_length]
    queries = spark.createDataFrame([(t, t[:MIN_PREFIX]) for t in asked], "query string, head string")
    if not asked:
        return queries.select(
            "query", F.lit("").alias("suggestion"), F.lit(0).alias("distance"), F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("rank")
        )
    shapes = sorted({(t[:MIN_PREFIX], len(t)) for t in asked})

    def near_some(word: Column) -> Column:
        test = F.lit(False)
        for head, length in shapes:
            test = test | (
                word.startswith(head) & F.length(word).between(length - max_edits, length + max_edits)
            )
        return test

    counted = _word_counts(df, field, analyser, near_some) if stored is None else stored.where(near_some(F.col("term")))
    vocabulary = counted.withColumn("head", F.substring("term", 1, MIN_PREFIX))
    n_docs = df.agg(F.count(F.lit(1)).alias("n_docs"))
    known = vocabulary.select(F.col("term").alias("query"), F.col("n").alias("query_n"))
    considered = (
        queries.join(known, "query", "left")
        .withColumn("query_n", F.coalesce("query_n", F.lit(0)))
        .where(F.col("query_n") <= F.lit(max_query_frequency) * n_docs.scalar())
    )
    distance = F.levenshtein("query", "term", max_edits)
    similarity = 1 - F.col("distance") / F.greatest(F.length("query"), F.length("term"))
    near = (
        vocabulary.join(F.broadcast(considered), "head")  # at most one row per query term
        .withColumn("distance", distance)
        .where((F.col("distance") > 0) & (similarity >= accuracy))
    )
    order = Window.partitionBy("query").orderBy("distance", F.col("n").desc(), "term")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    if alternative_count is not None:
        ranked = ranked.where((F.col("query_n") == 0) | (F.col("rank") <= alternative_count))
    return ranked.select("query", F.col("term").alias("suggestion"), "distance", "n", "rank")


def word_breaks(
    df: DataFrame, field: str, terms: Sequence[str], max_changes: int = MAX_CHANGES, analyser: Analyser = PLAIN
) -> DataFrame:
    """(kind, query, suggestion, n): neighbours joined to one known word, or a word split into
    two known words. ``n`` is the frequency of the joined word, or of the rarer half.
    Every term is looked at; of a term's suggestions the ``max_changes`` most frequent are given.

    The candidate words come from the query alone; rows are only tested for holding them.
    """
    terms = check_terms(terms)
    joined = [(f"{a} {b}", a + b) for a, b in zip(terms, terms[1:])]
    splits = [(t, t[:i], t[i:]) for t in terms for i in range(1, len(t))]
    wanted = sorted({w for _, w in joined} | {w for _, a, b in splits for w in (a, b)})
    spark = df.sparkSession
    found = _word_counts(df, field, analyser, lambda w: w.isin(*wanted)) if wanted else spark.createDataFrame([], "term string, n bigint")
    combined = (
        spark.createDataFrame(joined, "query string, term string")
        .join(found, "term")
        .select(F.lit("join").alias("kind"), "query", F.col("term").alias("suggestion"), "n")
    )
    left = found.select(F.col("term").alias("a"), F.col("n").alias("na"))
    right = found.select(F.col("term").alias("b"), F.col("n").alias("nb"))
    broken = (
        spark.createDataFrame(splits, "query string, a string, b string")
        .join(left, "a")
        .join(right, "b")
        .select(
            F.lit("split").alias("kind"),
            "query",
            F.concat_ws(" ", "a", "b").alias("suggestion"),
            F.least("na", "nb").alias("n"),
        )
    )
    every = combined.unionByName(broken)
    order = Window.partitionBy("kind", "query").orderBy(F.col("n").desc(), "suggestion")
    return every.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_changes).drop("r")


def collations(
    df: DataFrame,
    field: str,
    terms: Sequence[str],
    max_results: int = MAX_RESULTS_FOR_SUGGEST,
    tries: int = MAX_COLLATION_TRIES,
    max_collations: int = MAX_COLLATIONS,
    analyser: Analyser = PLAIN,
    postings: DataFrame | None = None,
    key: str = "id",
    **suggest_options,
) -> DataFrame:
    """(rewrite, cost, hits, rank): queries with misspellings replaced that do find something.

    Offered only when the query itself has at most ``max_results`` hits. Rewrites are tried in
    order of the sum of their suggestions' ranks. Keeping the ``tries`` best partial rewrites
    term by term is exact, because costs add up and the choices are independent. With the ``postings`` of a
    stored index, and its vocabulary as ``stored``, hits are counted from the posting lists of the
    rewrites' words.
    """
    terms = check_terms(terms)
    suggestions = suggest(df, field, terms, analyser=analyser, **suggest_options)
    choices = suggestions.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("query", F.col("rank").alias("cost"), "suggestion"))).alias("all")
    )
    rewrites = F.array(F.struct(F.lit(0).alias("cost"), F.array().cast("array<string>").alias("words")))
    for term in terms:
        options = F.transform(
            F.filter("all", lambda s: s["query"] == term),
            lambda s: F.struct(s["cost"].alias("cost"), s["suggestion"].alias("word")),
        )
        options = F.when(F.size(options) > 0, options).otherwise(
            F.array(F.struct(F.lit(0).alias("cost"), F.lit(term).alias("word")))
        )
        rewrites = _best_extensions(rewrites, options, tries)
    # Suggestions are at most ``count`` per query term, so this row is small.
    tried = choices.select(
        F.filter(rewrites, lambda r: r["cost"] > 0).alias("rewrites")
    )

    if postings is None:
        words = df.select(analyser.words(F.col(field)).alias("w"))
    else:
        # Some words a query term: a row's list holds those of them that it has.
        listed = tried.select(F.explode("rewrites").alias("r")).select(F.explode("r.words").alias("term"))
        listed = listed.union(df.sparkSession.createDataFrame([(t,) for t in terms], "term string")).distinct()
        own = postings.where(F.col("field") == field).join(F.broadcast(listed), "term")
        words = own.groupBy(key).agg(F.collect_set("term").alias("w")).select("w")
    query = F.array(*[F.lit(t) for t in terms])
    own_hits = words.where(F.forall(query, lambda t: F.array_contains("w", t))).agg(F.count(F.lit(1)).alias("n"))
    matched = words.withColumn("r", tried.scalar()).select(
        F.explode(F.filter("r", lambda r: F.forall(r["words"], lambda t: F.array_contains(F.col("w"), t)))).alias("r")
    )
    counts = matched.groupBy(F.array_join("r.words", " ").alias("rewrite"), F.col("r.cost").alias("cost")).agg(
        F.count(F.lit(1)).alias("hits")
    )
    offered = counts.where(own_hits.scalar() <= max_results)
    # At most ``tries`` rows remain, so ranking them in one window is a constant amount of work.
    order = Window.partitionBy(F.lit(1)).orderBy("cost", "rewrite")
    return offered.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max_collations)


def _best_extensions(rewrites: Column, options: Column, tries: int) -> Column:
    """Every partial rewrite with every option appended, the ``tries`` cheapest kept."""
    extended = F.flatten(
        F.transform(
            rewrites,
            lambda r: F.transform(
                options,
                lambda o: F.struct(
                    (r["cost"] + o["cost"]).alias("cost"),
                    F.concat(r["words"], F.array(o["word"])).alias("words"),
                ),
            ),
        )
    )
    return F.slice(F.array_sort(extended), 1, tries)
