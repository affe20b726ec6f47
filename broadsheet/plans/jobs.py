"""Whole jobs: indexing, loading to shards, and the discovery page."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from broadsheet.operators import counters, extract, facets, search
from broadsheet.operators.analysis import PLAIN
from broadsheet.operators.filters import apply_filters
from broadsheet.operators.maintain import latest_per_key, without_id
from broadsheet.operators.query_terms import all_terms, analysed
from broadsheet.sources.manifest import accepted, parse_manifest, rejected
from broadsheet.sources.sinks import write_shards


@dataclass(frozen=True)
class Indexed:
    """Results of the indexing job; all lazy."""

    articles: DataFrame
    rejects: DataFrame
    status: DataFrame


def index_articles(lines: DataFrame, issues: DataFrame, id_prefix: str = "", parse: Callable[[DataFrame], DataFrame] | None = None) -> Indexed:
    """Manifest lines and issue XML to articles, rejects (what, reason) and per-status counts.

    Each id occurs once in ``articles``: of repeated ids the last one in issue order wins. ``parse``
    makes parsed issues of (domid, xml); without it each result parses for itself when it is read.
    """
    manifest = parse_manifest(lines)
    good = accepted(manifest)
    parsed = (parse or extract.parse_issues)(issues)
    found = extract.enrich(extract.explode_articles(parsed, id_prefix), good)
    order = F.struct("issue_digi_date_tdt", "issue_domid_l", "page_i", "article_i")
    articles = latest_per_key(found, "id", order)
    outcome = extract.issue_status(good, parsed)
    rejects = (
        rejected(manifest)
        .select(F.col("line").alias("what"), "reason")
        .unionByName(
            outcome.where(F.col("status") != extract.PARSED).select(F.col("domid").alias("what"), F.col("status").alias("reason"))
        )
        .unionByName(without_id(found).select(F.col("issue_original_filename_s").alias("what"), "reason"))
    )
    failed = outcome.select(
        F.when(F.col("status").isin(extract.PARSED, extract.EMPTY), counters.GOOD).otherwise(counters.FAILED).alias("status"),
        "n_articles",
    )
    status = counters.status_counts(failed.select("status", F.col("n_articles").alias("n")))
    return Indexed(articles, rejects, status)


def index_once(lines: DataFrame, issues: DataFrame, path: str, id_prefix: str = "") -> Indexed:
    """``index_articles`` with the parse as a stage of its own, written under ``path``.

    Only issues that the manifest accepts are parsed, each once; articles, rejects and status counts
    read what was written. The stage holds text without markup, so it is smaller than the XML.
    """

    def parse(xml: DataFrame) -> DataFrame:
        wanted = accepted(parse_manifest(lines)).select("domid").distinct()
        parsed = extract.parse_issues(xml.join(wanted, "domid", "left_semi"))
        parsed.write.mode("errorifexists").parquet(path)
        return xml.sparkSession.read.schema(parsed.schema).parquet(path)

    return index_articles(lines, issues, id_prefix, parse)


def load_shards(articles: DataFrame, path: str, shards: int = 4) -> DataFrame:
    """Write the articles shard by shard and return the shard counters of what was written."""
    write_shards(articles, path, shards)
    written = articles.sparkSession.read.parquet(path)
    return counters.shard_counts(written)


@dataclass(frozen=True)
class DiscoveryPage:
    """What one request shows; all lazy, all over the same hits."""

    hits: DataFrame
    page: DataFrame
    num_found: DataFrame
    facets: DataFrame


def discover(
    articles: DataFrame,
    terms: Sequence[str] = (),
    weights: Mapping[str, float] | None = None,
    filters: Sequence[Column] = (),
    facet_fields: Sequence[str] = ("issue_year_s",),
    sort: str | Sequence[tuple[str, str]] = (("score", "desc"),),
    rows: int = search.ROWS,
    start: int = 0,
    key: str = "id",
    shown: Sequence[str] = ("article_title_s", "issue_pub_date_tdt"),
    mm: float | int = 1.0,
    **options,
) -> DiscoveryPage:
    """Search, filter, sort, page and facet in one request.

    The hit table holds only the key, score and the columns shown, sorted or faceted by, so it
    is narrow enough to ``cache()`` when several parts of the page are read.
    """
    sort_fields = [f for f, _ in (search.SORTS[sort] if isinstance(sort, str) else sort) if f != "score"]
    keep = [c for c in dict.fromkeys([*shown, *facet_fields, *sort_fields]) if c != key]
    weights = weights or {"content": 1.0}
    if terms:
        hits = search.search_fields(articles, terms, weights, key=key, filters=filters, keep=keep, mm=mm, **options)
    else:
        hits = apply_filters(articles, filters).select(key, *keep, F.lit(0).alias("matched"), F.lit(0.0).alias("score"))
    return DiscoveryPage(
        hits=hits,
        page=search.page(hits, search.order_columns(sort, key), rows, start),
        num_found=search.num_found(hits, rows),
        facets=facets.facet_fields(hits, list(facet_fields)),
    )


def discover_index(
    articles: DataFrame,
    path: str,
    terms: Sequence[str],
    weights: Mapping[str, float] | None = None,
    filters: Sequence[Column] = (),
    facet_fields: Sequence[str] = ("issue_year_s",),
    sort: str | Sequence[tuple[str, str]] = (("score", "desc"),),
    rows: int = search.ROWS,
    start: int = 0,
    key: str = "id",
    shown: Sequence[str] = ("article_title_s", "issue_pub_date_tdt"),
    mm: float | int = 1.0,
    **options,
) -> DiscoveryPage:
    """``discover`` with hits from a stored index of the articles: the query's buckets are read, no text is.

    Of the articles only the columns that are shown, sorted, filtered or faceted by are joined to the hits.
    """
    spark = articles.sparkSession
    sort_fields = [f for f, _ in (search.SORTS[sort] if isinstance(sort, str) else sort) if f != "score"]
    keep = [c for c in dict.fromkeys([*shown, *facet_fields, *sort_fields]) if c != key]
    asked = all_terms(analysed(spark, terms, options.get("analyser", PLAIN)))
    postings, lengths = search.read_index(spark, path, asked)
    found = search.search_postings(
        postings, lengths, terms, weights or {"content": 1.0}, key, mm, search.read_statistics(spark, path), **options
    )
    hits = apply_filters(articles, filters).select(key, *keep).join(found, key).select(key, *keep, "matched", "score")
    return DiscoveryPage(
        hits=hits,
        page=search.page(hits, search.order_columns(sort, key), rows, start),
        num_found=search.num_found(hits, rows),
        facets=facets.facet_fields(hits, list(facet_fields)),
    )
