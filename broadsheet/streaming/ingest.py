"""Continuous ingest: manifest files arrive, their articles join the table."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from broadsheet.operators.extract import extract_articles
from broadsheet.operators.maintain import append_batch, latest_per_key
from broadsheet.sources.issues import read_issue_files
from broadsheet.sources.manifest import accepted, parse_manifest


def ingest_lines(
    lines: DataFrame,
    issues_for: Callable[[DataFrame], DataFrame],
    table: str,
    checkpoint: str,
    id_prefix: str = "",
    every: str | None = None,
) -> StreamingQuery:
    """Parse arriving manifest lines (streaming column ``value``) and append their articles.

    ``issues_for`` gets the micro-batch's accepted manifest and returns the (domid, xml) rows
    to read for it, so a batch reads its own issues only. Each micro-batch is written once
    under its id, so a retried batch replaces itself and the table never holds it twice.
    ``every`` is a processing-time interval; without it all present input is consumed and the
    query ends.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        manifest = accepted(parse_manifest(batch))
        articles = extract_articles(manifest, issues_for(manifest), id_prefix)
        order = F.struct("issue_digi_date_tdt", "page_i", "article_i")
        append_batch(latest_per_key(articles, "id", order), table, batch_id)

    writer = lines.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def ingest_manifests(spark: SparkSession, manifests: str, issues_for, table: str, checkpoint: str, **options) -> StreamingQuery:
    """Watch a folder of manifest files; each file is read once."""
    return ingest_lines(spark.readStream.text(manifests), issues_for, table, checkpoint, **options)


def issues_from(archive: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Issue lookup in a (domid, xml) table for ``ingest_lines``."""

    def lookup(manifest: DataFrame) -> DataFrame:
        return archive.join(manifest.select("domid").distinct(), "domid", "left_semi")

    return lookup


def issues_in(spark: SparkSession, prefix: str, suffix: str = "") -> Callable[[DataFrame], DataFrame]:
    """Issue lookup among files under a prefix for ``ingest_lines``: a batch reads its own files only."""
    return lambda manifest: read_issue_files(spark, manifest, prefix, suffix)
