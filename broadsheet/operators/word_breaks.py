"""Words broken into many known parts, and runs of neighbours joined to known words, for whole tables of queries.

A word's substrings meet the vocabulary by an equality join; those that are known come back to the
word's row, where a dynamic programme over its places finds the break with the fewest parts, then
the most frequent ones, then the first by name. A word of length L has less than L squared
substrings, so what returns to a row is bounded by its word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions.shape import let
from broadsheet.operators.spelling import MAX_CHANGES

MIN_PART = 1


def _best_break(word: Column, parts: Column, max_changes: int) -> Column:
    """(parts, frequency, text) of the best break; null without one. ``parts``: array of (start, size, n), from 0."""
    kind = "struct<parts:int,rarity:bigint,text:string>"

    def state(count: Column, rarity: Column, text: Column) -> Column:
        return F.struct(count.alias("parts"), rarity.alias("rarity"), text.alias("text"))

    def step(reached: Column, end: Column) -> Column:
        def from_part(p: Column) -> Column:
            def after(before: Column) -> Column:
                piece = F.substring(word, p["start"] + 1, p["size"])
                text = F.when(before["parts"] == 0, piece).otherwise(F.concat(before["text"], F.lit(" "), piece))
                return F.when(before.isNotNull() & (before["parts"] <= max_changes), state(before["parts"] + 1, before["rarity"] - p["n"], text))

            return let(F.get(reached, p["start"]), after)

        ways = F.transform(F.filter(parts, lambda p: p["start"] + p["size"] == end), from_part)
        return F.concat(reached, F.array(F.array_min(F.filter(ways, lambda w: w.isNotNull()))))

    begin = F.array(state(F.lit(0), F.lit(0).cast("bigint"), F.lit(""))).cast(f"array<{kind}>")
    return F.aggregate(F.sequence(F.lit(1), F.length(word)), begin, step, lambda s: F.get(s, F.length(word)))


def breaks(vocabulary: DataFrame, words: DataFrame, max_changes: int = MAX_CHANGES, min_part: int = MIN_PART) -> DataFrame:
    """(query, suggestion, changes, n): each distinct word of ``words`` (query) that breaks into two or more known parts.

    ``n``: the parts' frequencies added up; ``changes``: the number of breaks, at most ``max_changes``.
    """
    asked = words.select("query").where(F.length("query") >= 2 * min_part).distinct()
    size = F.length("query")
    places = F.flatten(
        F.transform(
            F.sequence(F.lit(0), size - min_part),
            lambda start: F.transform(
                F.sequence(F.lit(min_part), F.least(size - start, size - 1)), lambda n: F.struct(start.alias("start"), n.alias("size"))
            ),
        )
    )
    listed = asked.select("query", F.inline(F.filter(places, lambda p: (p["size"] >= min_part) & (p["start"] + p["size"] <= size))))
    listed = listed.withColumn("term", F.substring(F.col("query"), F.col("start") + 1, F.col("size")))
    parts = listed.join(vocabulary.select("term", "n"), "term").groupBy("query").agg(F.collect_list(F.struct("start", "size", "n")).alias("parts"))
    best = parts.select("query", F.inline_outer(F.array(_best_break(F.col("query"), F.col("parts"), max_changes))))
    return best.where(F.col("parts") > 1).select(
        "query", F.col("text").alias("suggestion"), (F.col("parts") - 1).alias("changes"), (-F.col("rarity")).alias("n")
    )


def joins(vocabulary: DataFrame, queries: DataFrame, key: str = "id", max_changes: int = MAX_CHANGES) -> DataFrame:
    """(key, query, suggestion, changes, n): runs of up to ``max_changes`` + 1 neighbours that are one known word.

    ``queries``: (key, words); ``query``: the run, spaced.
    """
    count = F.size("words")
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(0), count - 2),
            lambda i: F.transform(
                F.sequence(F.lit(2), F.least(count - i, F.lit(max_changes + 1))),
                lambda k: F.struct(F.array_join(F.slice("words", i + 1, k), " ").alias("query"), (k - 1).alias("changes")),
            ),
        )
    )
    listed = queries.where(count > 1).select(key, F.inline(F.array_distinct(runs)))
    listed = listed.withColumn("term", F.replace("query", F.lit(" "), F.lit("")))
    return listed.join(vocabulary.select("term", "n"), "term").select(key, "query", F.col("term").alias("suggestion"), "changes", "n")


def word_breaks_many(vocabulary: DataFrame, queries: DataFrame, key: str = "id", max_changes: int = MAX_CHANGES, min_part: int = MIN_PART) -> DataFrame:
    """(key, kind, query, suggestion, changes, n): breaks of each query's words and joins of its neighbours."""
    own = queries.select(key, F.explode(F.array_distinct("words")).alias("query"))
    broken = own.join(breaks(vocabulary, own, max_changes, min_part), "query")
    return (
        broken.select(key, F.lit("split").alias("kind"), "query", "suggestion", "changes", "n")
        .unionByName(joins(vocabulary, queries, key, max_changes).withColumn("kind", F.lit("join")))
    )
