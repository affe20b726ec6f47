"""Upsert, delete, de-duplication, batches, streaming ingest and clustering."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.operators import cluster, maintain as mt, sketches, versions
from broadsheet.plans import bindings as bind
from broadsheet.plans.registered.ingest import _ISSUES, PREFIX, _PARTS
from broadsheet.plans.registered.registry import Tables, query
from broadsheet.session import shared_dir
from broadsheet.sources import manifest
from broadsheet.streaming import state
from broadsheet.streaming.ingest import ingest_lines, issues_from


def _upsert_inputs(t: Tables):
    """The index holds what is not French; the batch brings German and French, twice over."""
    docs = t.documents.select(F.col("doc_id").alias("id"), "lang", F.md5("text").alias("body"))
    index = docs.where(F.col("lang") != "fr").withColumn("version", F.lit(0))
    batch = docs.where(F.col("lang").isin("de", "fr")).select(
        "id", "lang", "body", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("version")
    )
    return index, batch


@query(
    "upsert",
    """SELECT doc_id AS id, lang, md5(text) AS body, CASE WHEN lang IN ('de', 'fr') THEN 2 ELSE 0 END AS version FROM documents""",
)
def upsert(t: Tables):
    index, batch = _upsert_inputs(t)
    return mt.upsert(index, batch, "version")


@query("delete_by_query", "SELECT doc_id, lang FROM documents WHERE NOT (lang = 'en' AND n_chars > 500)")
def delete_by_query(t: Tables):
    return mt.delete_by_query(t.documents, (F.col("lang") == "en") & (F.col("n_chars") > 500)).select("doc_id", "lang")


@query(
    "copies_removed",
    "SELECT min(doc_id) AS doc_id, md5(text || chr(31) || lang) AS signature FROM documents GROUP BY text, lang",
)
def copies_removed(t: Tables):
    return mt.signature_dedupe(t.documents, ["text", "lang"], "doc_id").select("doc_id", "signature")


@query("batches_united", "SELECT doc_id, lang FROM documents UNION ALL SELECT doc_id, lang FROM documents WHERE lang = 'es'")
def batches_united(t: Tables):
    docs = t.documents.select("doc_id", "lang")
    return mt.union_batches(docs, docs.where(F.col("lang") == "es").select("lang", "doc_id"))


@query(
    "log_of_batches",
    """SELECT doc_id AS id, lang, md5(text) AS body, CASE WHEN lang IN ('de', 'fr') THEN 2 ELSE 0 END AS version FROM documents""",
)
def log_of_batches(t: Tables):
    """The same upsert as appended batches, read back as the present content."""
    index, batch = _upsert_inputs(t)
    path = shared_dir(t.spark, "log") + "/table"
    mt.append_batch(index, path, 0)
    mt.append_batch(mt.latest_per_key(batch, "id", "version"), path, 1)
    return mt.current_articles(mt.read_log(t.spark, path))


@query(
    "streamed_articles",
    f"""WITH {_PARTS} SELECT '{PREFIX}' || doc_id || '-' || n AS id, CAST((n - 1) // 5 + 1 AS INTEGER) AS page_i,
     CAST((n - 1) % 5 + 1 AS INTEGER) AS article_i, doc_id AS issue_domid_l FROM parts""",
)
def streamed_articles(t: Tables):
    """Manifest lines arrive as a stream; the articles are read back from the table."""
    docs = t.documents
    work = shared_dir(t.spark, "stream")
    bind.manifest_lines(docs).write.text(f"{work}/manifests")
    lines = t.spark.readStream.text(f"{work}/manifests")
    running = ingest_lines(lines, issues_from(bind.issue_xml(docs)), f"{work}/table", f"{work}/checkpoint", PREFIX)
    running.awaitTermination()
    return mt.current_articles(mt.read_log(t.spark, f"{work}/table")).select("id", "page_i", "article_i", "issue_domid_l")


@query(
    "committed_articles",
    """SELECT doc_id AS id, lang, md5(text) AS body, CASE WHEN doc_id % 5 = 0 THEN 3 WHEN lang IN ('de', 'fr') THEN 2 ELSE 0 END AS version FROM documents""",
)
def committed_articles(t: Tables):
    """A snapshot of two batches and a batch after it, read as the present content."""
    index, batch = _upsert_inputs(t)
    path = shared_dir(t.spark, "log") + "/table"
    mt.append_batch(index, path, 0)
    mt.append_batch(mt.latest_per_key(batch, "id", "version"), path, 1)
    versions.compact(t.spark, path)
    docs = t.documents.where("doc_id % 5 = 0").select(F.col("doc_id").alias("id"), "lang", F.md5("text").alias("body"))
    mt.append_batch(docs.withColumn("version", F.lit(3)), path, 2)
    return versions.committed(t.spark, path)


def _arrivals(t: Tables, work: str):
    """Articles as they arrive: two thirds at first, then half of these again, and the rest on time or far too late."""
    at = F.timestamp_seconds(F.lit(1577836800) + F.col("doc_id") % 1000 * 60)
    docs = t.documents.select(F.col("doc_id").alias("id"), "lang", F.md5("text").alias("body"), at.alias("arrived"))
    first = docs.where("id % 3 <> 0")
    late = F.col("arrived") - F.expr("INTERVAL 200 DAYS")
    rest = docs.where("id % 3 = 0").withColumn("arrived", F.when(F.col("id") % 2 == 0, late).otherwise(F.col("arrived")))
    first.write.parquet(f"{work}/in/drop=1")
    yield
    first.where("id % 2 = 0").unionByName(rest).write.parquet(f"{work}/in/drop=2")
    yield


@query("streamed_once", "SELECT doc_id AS id, lang, md5(text) AS body FROM documents WHERE doc_id % 3 <> 0 OR doc_id % 2 <> 0")
def streamed_once(t: Tables):
    """Each article once, though files repeat and the stream is restarted between them; what is far too late stays out."""
    work = shared_dir(t.spark, "once")
    for _ in _arrivals(t, work):
        rows = t.spark.readStream.schema("id long, lang string, body string, arrived timestamp").parquet(f"{work}/in/*")
        once = state.once_per_key(rows, "id", "arrived", "100 days")
        state.append_stream(once, f"{work}/table", f"{work}/checkpoint").awaitTermination()
    return t.spark.read.parquet(f"{work}/table").select("id", "lang", "body")


@query(
    "streamed_status",
    f"""WITH {_ISSUES} SELECT status, CAST(count(*) AS BIGINT) AS n FROM (SELECT status FROM issues
      UNION ALL SELECT 'HEADER' FROM (SELECT DISTINCT source FROM documents)) GROUP BY status""",
)
def streamed_status(t: Tables):
    """Running counts of manifest lines by status, over two runs of the stream."""
    work = shared_dir(t.spark, "status")
    lines = bind.manifest_lines(t.documents)
    for part in (0, 1):
        lines.where(F.pmod(F.hash("value"), F.lit(2)) == part).write.text(f"{work}/in/part={part}")
        rows = manifest.parse_manifest(t.spark.readStream.schema("value string").text(f"{work}/in/*"))
        state.count_stream(rows, "status", f"{work}/log", f"{work}/checkpoint").awaitTermination()
    return mt.current_articles(mt.read_log(t.spark, f"{work}/log"), "status")


@query("sketched_stats")
def sketched_stats(t: Tables):
    """Field statistics of three batches from their sketches; estimates, so there is no SQL to compare."""
    articles = bind.articles(t.documents)
    path = shared_dir(t.spark, "sketches")
    fields = ["article_title_s", "newspaper_title_s", "issue_year_s", "article_text_length_ti"]
    for batch in range(3):
        sketches.write_sketches(articles.where(F.col("id") % 3 == batch), path, batch, fields, group=F.col("article_type_s"))
    return sketches.sketch_stats(sketches.read_sketches(t.spark, path))


@query("hit_clusters")
def hit_clusters(t: Tables):
    """Clusters of all articles by wording; iterative, so there is no SQL to compare."""
    return cluster.cluster_hits(bind.articles(t.documents), "content", k=8)
