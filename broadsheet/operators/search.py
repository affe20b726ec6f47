"""Ranked full-text search: BM25 over weighted fields, phrase boosts, sorting, paging.

Query terms are few (at most 1024) and known when the plan is built. So each article counts
its own query terms inside its row, and the collection's statistics come from one small
aggregate used as a scalar subquery: no term postings are shuffled and no side is broadcast.
The same scores can be had from a stored index with ``search_postings``.
"""

from __future__ import annotations

import math
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.functions.shape import computed, let
from broadsheet.operators.analysis import PLAIN, Analyser
from broadsheet.operators.filters import check_terms
from broadsheet.operators.query_terms import Slot, all_terms, analysed, distinct_slots, phrase_starts

# ---- fixed values: BM25 parameters --------------------------------------------------
K1 = 1.2
B = 0.75

# ---- fixed values: sort choices, page sizes -----------------------------------------
SORTS = {
    "date": [("issue_pub_date_tdt", "desc"), ("article_title_s", "asc")],
    "title": [("article_title_s", "asc"), ("issue_pub_date_tdt", "desc")],
}
ROWS = 10
PAGE_SIZES = [10, 20, 50, 100]


def idf(n_docs: Column, doc_freq: Column) -> Column:
    return F.log(1 + (n_docs - doc_freq + 0.5) / (doc_freq + 0.5))


def bm25(tf: Column, dl: Column, n_docs: Column, avg_dl: Column, doc_freq: Column) -> Column:
    norm = K1 * (1 - B + B * dl / avg_dl)
    return idf(n_docs, doc_freq) * tf * (K1 + 1) / (tf + norm)


def required_matches(n_terms: int, mm: float | int) -> int:
    """How many terms must match: a count, or a share of the terms rounded down (at least 1)."""
    needed = mm if isinstance(mm, int) else math.floor(mm * n_terms + 1e-9)
    return max(1, min(n_terms, needed))


def _term_counts(words: Column, asked: Sequence[tuple[str, ...]]) -> Column:
    """How often what a query asks for stands among ``words``, in query order; synonyms add up.

    One hashed pass keeps the query's words; only those are compared per term.
    """
    every = list(dict.fromkeys(t for terms in asked for t in terms))
    listed = F.array(*[F.array(*[F.lit(t) for t in terms]) for terms in asked])
    return let(
        F.filter(words, lambda w: w.isin(*every)),
        lambda hits: F.transform(listed, lambda q: F.size(F.filter(hits, lambda w: F.array_contains(q, w))).cast("double")),
    )


def _phrase_count(placed: Column, slots: Sequence[Slot]) -> Column:
    """Occurrences of the query's words in their places, in an array of (pos, term)."""

    def of(own: Column) -> Column:
        def held(slot: Slot) -> Column:
            return F.transform(F.filter(own, lambda p: p["term"].isin(*slot.terms)), lambda p: p["pos"])

        return F.size(phrase_starts([held(s) for s in slots], slots))

    every = all_terms(slots)
    return F.coalesce(let(F.filter(placed, lambda p: p["term"].isin(*every)), of), F.lit(0)).cast("double")


def _fold_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def search_fields(
    df: DataFrame,
    terms: Sequence[str],
    weights: Mapping[str, float],
    key: str = "id",
    mm: float | int = 1.0,
    phrase_weights: Mapping[str, float] | None = None,
    boost: str | None = None,
    analyser: Analyser = PLAIN,
    filters: Sequence[Column] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Matching rows as (key, *keep, matched, score).

    The query is analysed by the fields' chain; what it asks for is its words, each once, where
    synonyms in one place are one word. Per word the best weighted field counts; words add up. ``mm`` says
    how many must match. ``phrase_weights`` adds the score of the whole query as a phrase. ``boost`` adds a
    numeric column. ``filters`` narrow the hits but not the collection's statistics. An empty
    query matches everything with score 0.
    """
    slots = analysed(df.sparkSession, terms, analyser)
    asked = distinct_slots(slots)
    narrowed = df
    if not asked:
        for test in filters:
            narrowed = narrowed.where(test)
        zero = F.lit(0.0) if boost is None else F.coalesce(F.col(boost).cast("double"), F.lit(0.0))
        return narrowed.select(key, *keep, F.lit(0).alias("matched"), zero.alias("score"))

    phrase_weights = dict(phrase_weights or {})
    fields = list(dict.fromkeys([*weights, *phrase_weights]))

    def counted(source: DataFrame, extra: Sequence[Column], placed: Sequence[str] = ()) -> DataFrame:
        """Counts of each row; ``placed``: fields whose terms stay, with their positions."""
        words = computed(
            source,
            extra,
            [analyser.terms(F.col(f)).alias(f"w_{f}") if f in placed else analyser.words(F.col(f)).alias(f"w_{f}") for f in fields],
        )
        of = {f: F.transform(f"w_{f}", lambda p: p["term"]) if f in placed else F.col(f"w_{f}") for f in fields}
        return computed(
            words,
            [c for c in words.columns if not c.startswith("w_")],
            [
                *[F.size(F.col(f"w_{f}")).cast("double").alias(f"dl_{f}") for f in fields],
                *[_term_counts(of[f], asked).alias(f"tf_{f}") for f in fields],
                *[F.col(f"w_{f}") for f in placed],
            ],
        )

    # One row of statistics: per field the number of documents, mean length and, per term, the
    # document frequency. A NULL field is absent and does not count.
    per_field = []
    for f in fields:
        present = F.col(f"dl_{f}") >= 0
        per_field += [
            F.count_if(present).cast("double").alias(f"n_{f}"),
            F.avg(F.when(present, F.col(f"dl_{f}"))).alias(f"avg_{f}"),
            F.array(
                *[F.count_if(F.get(F.col(f"tf_{f}"), i) > 0).cast("double") for i in range(len(asked))]
            ).alias(f"df_{f}"),
        ]
    stats = counted(df, []).agg(*per_field)
    one_row = stats.select(F.struct(*stats.columns).alias("s"))

    for test in filters:
        narrowed = narrowed.where(test)
    names = list(dict.fromkeys([key, *keep, *([boost] if boost else [])]))
    hits = counted(narrowed, [F.col(c) for c in names], list(phrase_weights) if len(slots) > 1 else [])

    def tf_at(f: str, i: int) -> Column:
        return F.coalesce(F.get(F.col(f"tf_{f}"), i), F.lit(0.0))

    matched = F.lit(0)
    for i in range(len(asked)):
        any_field = F.lit(False)
        for f in weights:
            any_field = any_field | (tf_at(f, i) > 0)
        matched = matched + any_field.cast("int")
    hits = hits.withColumn("matched", matched).where(F.col("matched") >= required_matches(len(asked), mm))
    hits = hits.withColumn("s", one_row.scalar())

    def stat(f: str):
        return F.col(f"s.n_{f}"), F.col(f"s.avg_{f}"), F.col(f"s.df_{f}")

    def field_scores(f: str) -> Column:
        n, avg, dfs = stat(f)
        return F.transform(
            F.coalesce(F.col(f"tf_{f}"), F.array_repeat(F.lit(0.0), len(asked))),
            lambda tf, i: F.when(
                tf > 0, F.lit(float(weights[f])) * bm25(tf, F.col(f"dl_{f}"), n, avg, F.get(dfs, i))
            ).otherwise(0.0),
        )

    best = field_scores(next(iter(weights)))
    for f in list(weights)[1:]:
        best = F.zip_with(best, field_scores(f), lambda a, b: F.greatest(a, b))
    score = _fold_sum(best)

    if len(slots) > 1:
        for f, weight in phrase_weights.items():
            n, avg, dfs = stat(f)
            tf = _phrase_count(F.col(f"w_{f}"), slots)
            idf_sum = _fold_sum(F.transform(dfs, lambda d: idf(n, d)))
            norm = K1 * (1 - B + B * F.col(f"dl_{f}") / avg)
            gain = F.lit(float(weight)) * idf_sum * tf * (K1 + 1) / (tf + norm)
            score = score + F.when(tf > 0, gain).otherwise(0.0)
    if boost is not None:
        score = score + F.coalesce(F.col(boost).cast("double"), F.lit(0.0))
    return hits.select(key, *keep, "matched", score.alias("score"))


def search(df: DataFrame, terms: Sequence[str], field: str = "content", **options) -> DataFrame:
    """Ranked match in one field; any term may match unless ``mm`` says otherwise."""
    options.setdefault("mm", 1)
    return search_fields(df, terms, {field: 1.0}, **options)


def search_title(df: DataFrame, terms: Sequence[str], title: str = "article_title_s", **options) -> DataFrame:
    """Title search: title weight plus a boost for the words standing together."""
    options.setdefault("phrase_weights", {title: 2.0})
    return search_fields(df, terms, {title: 1.0}, **options)


def search_postings(
    postings: DataFrame,
    lengths: DataFrame,
    terms: Sequence[str],
    weights: Mapping[str, float],
    key: str = "id",
    mm: float | int = 1.0,
    statistics: DataFrame | None = None,
    analyser: Analyser = PLAIN,
) -> DataFrame:
    """The same ranking from a stored index (``postings`` and ``field_lengths``).

    ``statistics`` (field, n, avg_dl), as an index stores them, spares the scan of all lengths.

    The term filter reaches the postings scan, so only the query's posting lists are read.
    Postings that carry ``dl``, as stored ones do, need no join with the lengths by key.
    """
    asked = distinct_slots(analysed(postings.sparkSession, terms, analyser))
    fields = list(weights)
    size = ["dl"] if "dl" in postings.columns else []
    wanted = postings.where(F.col("term").isin(*[t for ts in asked for t in ts]) & F.col("field").isin(*fields)).select(
        key, "field", "term", "tf", *size
    )
    if any(len(ts) > 1 for ts in asked):
        # Synonyms add up under one name; there are as many rows as the query has terms.
        named = postings.sparkSession.createDataFrame([(t, str(i)) for i, ts in enumerate(asked) for t in ts], "term string, slot string")
        wanted = wanted.join(F.broadcast(named), "term").groupBy(key, "field", F.col("slot").alias("term"), *size).agg(F.sum("tf").alias("tf"))
    if statistics is None:
        statistics = field_statistics(lengths)
    per_field = statistics.where(F.col("field").isin(*fields))
    per_term = wanted.groupBy("field", "term").agg(F.count(F.lit(1)).alias("doc_freq"))
    stats = per_term.join(per_field, "field")
    weight = F.lit(0.0)
    for f, w in weights.items():
        weight = F.when(F.col("field") == f, float(w)).otherwise(weight)
    sized = wanted if "dl" in wanted.columns else wanted.join(lengths, [key, "field"])
    part = weight * bm25(F.col("tf"), F.col("dl"), F.col("n"), F.col("avg_dl"), F.col("doc_freq"))
    # At most one row per field and query term, of which ``check_terms`` limits the number.
    scored = sized.join(F.broadcast(stats), ["field", "term"]).select(key, "term", part.alias("part"))
    return (
        scored.groupBy(key, "term")
        .agg(F.max("part").alias("part"))
        .groupBy(key)
        .agg(F.count(F.lit(1)).cast("int").alias("matched"), F.sum("part").alias("score"))
        .where(F.col("matched") >= required_matches(len(asked), mm))
    )


def search_phrase_postings(
    postings: DataFrame,
    statistics: DataFrame,
    terms: Sequence[str],
    field: str,
    slop: int = 0,
    key: str = "id",
    analyser: Analyser = PLAIN,
) -> DataFrame:
    """(key, tf, score): articles with the query's words in their places, from stored postings.

    ``slop``: how far apart the words' beginnings may lie, if each is moved back by its place in the
    query. Repeated words need positions of their own. Only the query's posting lists are read; an
    article's lists, one a term, meet in one row, where positions are merged.
    """
    slots = analysed(postings.sparkSession, terms, analyser)
    asked, every = distinct_slots(slots), all_terms(slots)
    wanted = postings.where(F.col("term").isin(*every) & (F.col("field") == field)).select(key, "term", "positions", "dl")
    lists = wanted.groupBy(key).agg(F.collect_list(F.struct("term", "positions")).alias("lists"), F.first("dl").alias("dl"))

    def positions(slot: Slot) -> Column:
        own = F.filter("lists", lambda p: p["term"].isin(*slot.terms))
        return F.array_sort(F.flatten(F.transform(own, lambda p: p["positions"])))

    held = computed(lists, [key, "dl"], [positions(s).alias(f"p{i}") for i, s in enumerate(slots)])
    full = F.lit(True)
    for i in range(len(slots)):
        full = full & (F.size(f"p{i}") > 0)
    starts = phrase_starts([F.col(f"p{i}") for i in range(len(slots))], slots, slop)
    found = computed(held.where(full), [key, "dl"], [F.size(starts).cast("double").alias("tf")]).where("tf > 0")
    names = {t: i for i, ts in enumerate(asked) for t in ts}
    slot = F.try_element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col("term"))
    counted = wanted.groupBy(slot.alias("slot")).agg(F.count_distinct(key).alias("doc_freq"))
    per_field = statistics.where(F.col("field") == field).select("n", "avg_dl")
    # One row for each of the query's words, and one of statistics.
    stats = per_field.select(F.struct("n", "avg_dl").alias("s"))
    weighed = counted.withColumn("s", stats.scalar()).agg(F.sum(idf(F.col("s.n"), F.col("doc_freq"))).alias("idf"))
    norm = K1 * (1 - B + B * F.col("dl") / F.col("s.avg_dl"))
    return (
        found.withColumn("s", stats.scalar())
        .withColumn("idf", weighed.scalar())
        .select(key, "tf", (F.col("idf") * F.col("tf") * (K1 + 1) / (F.col("tf") + norm)).alias("score"))
    )


def field_statistics(lengths: DataFrame) -> DataFrame:
    """(field, n, avg_dl): one row per field."""
    return lengths.groupBy("field").agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avg_dl"))


def write_index(df: DataFrame, path: str, key: str, fields: Sequence[str], analyser: Analyser = PLAIN, buckets: int = 64) -> None:
    """Store postings, field lengths, statistics and vocabulary under ``path``.

    Each part of the input writes a segment of its own: its postings, sorted by term in hash buckets.
    So postings are never shuffled, and a very common term lies in as many files as there are segments.
    The vocabulary (field, term, n) is sorted, so that a prefix reads few row groups.
    """
    from broadsheet.operators.analysis import field_lengths, postings

    bucket = F.pmod(F.hash("term"), F.lit(buckets)).alias("bucket")
    rows = postings(df, key, fields, analyser, lengths=True).select("*", bucket)
    rows.sortWithinPartitions("bucket", "term", "field").write.partitionBy("bucket").parquet(f"{path}/postings")
    field_lengths(df, key, fields, analyser).write.parquet(f"{path}/lengths")
    field_statistics(df.sparkSession.read.parquet(f"{path}/lengths")).coalesce(1).write.parquet(f"{path}/statistics")
    listed = df.sparkSession.read.parquet(f"{path}/postings").groupBy("field", "term").agg(F.count(F.lit(1)).alias("n"))
    listed.repartitionByRange("field", "term").sortWithinPartitions("field", "term").write.parquet(f"{path}/vocabulary")


def read_statistics(spark, path: str) -> DataFrame:
    """(field, n, avg_dl) of a stored index."""
    return spark.read.parquet(f"{path}/statistics")


def read_vocabulary(spark, path: str) -> DataFrame:
    """(field, term, n) of a stored index."""
    return spark.read.parquet(f"{path}/vocabulary")


def read_index(spark, path: str, terms: Sequence[str] | None = None, buckets: int = 64) -> tuple[DataFrame, DataFrame]:
    """(postings, lengths) of a stored index; with ``terms`` only their buckets are listed."""
    rows = spark.read.parquet(f"{path}/postings")
    if terms is not None:
        terms = check_terms(terms)
        wanted = F.array(*[F.pmod(F.hash(F.lit(t)), F.lit(buckets)) for t in terms])
        rows = rows.where(F.array_contains(wanted, F.col("bucket")) & F.col("term").isin(*terms))
    return rows, spark.read.parquet(f"{path}/lengths")


def order_columns(sort: str | Sequence[tuple[str, str]], key: str = "id") -> list[Column]:
    """Sort columns of a named choice or of (field, direction) pairs, ties broken by the key."""
    pairs = SORTS[sort] if isinstance(sort, str) else sort
    out = [F.col(f).desc_nulls_last() if d == "desc" else F.col(f).asc_nulls_last() for f, d in pairs]
    return [*out, F.col(key).asc()]


def page(df: DataFrame, order: Sequence[Column], rows: int = ROWS, start: int = 0) -> DataFrame:
    """One page of hits: a top-k, so no full sort takes place."""
    return df.orderBy(*order).offset(start).limit(rows)


def page_start(number: int, rows: int = ROWS) -> int:
    """Offset of a 1-based page number."""
    return number * rows - rows


def num_found(df: DataFrame, rows: int = ROWS) -> DataFrame:
    """(num_found, page_count)."""
    return df.agg(F.count(F.lit(1)).alias("num_found")).select(
        "num_found", F.ceil(F.col("num_found") / rows).cast("bigint").alias("page_count")
    )


def curated(
    hits: DataFrame, rules: DataFrame, query: str, candidates: DataFrame | None = None, key: str = "id"
) -> DataFrame:
    """Pin or exclude results for an exact query text.

    ``rules`` is (query, id, rank, exclude), a small curated table. Pinned rows come first in
    rank order, even if they did not match, provided ``candidates`` (the article table) has
    them; excluded rows are removed. Adds ``pin_rank``.
    """
    mine = rules.where(F.col("query") == query)
    excluded = mine.where("exclude").select(F.col("id").alias(key))
    pins = mine.where(~F.col("exclude")).select(F.col("id").alias(key), F.col("rank").alias("pin_rank"))
    if candidates is not None:
        pins = candidates.select(key).join(pins, key)
    kept = hits.join(excluded, key, "left_anti")
    if candidates is None:
        return kept.join(pins, key, "left")
    # Pins meet the hits twice, where they are: as a mark on those that match, and to find those that don't.
    # The second time only the pins' own rows are looked for, so hits are never shuffled for a few pins.
    marked = kept.join(pins, key, "left")
    unmatched = pins.join(hits.join(pins.select(key), key, "left_semi").select(key), key, "left_anti")
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in kept.schema.fields if f.name != key]
    return marked.unionByName(unmatched.join(excluded, key, "left_anti").select(key, *others, "pin_rank"))
