"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and cores; ``python bench.py all`` times
every registered query. One query runs first and is not counted; then each runs to completion
once; the index on disk is written by the first query that asks for it. The inputs are files of one row group, so text tables are dealt out to the cores first.
"""

from __future__ import annotations

import json
import os
import sys
import time

from broadsheet.plans.registered import REGISTRY, Tables
from broadsheet.session import build_session

HEADLINE = [
    "manifest_rows",
    "article_table",
    "year_facet_of_index",
    "newest_articles_page",
    "job_status_counts",
    "shard_counts",
    "tokens",
    "stopwords_removed",
    "language_detected",
    "postings",
    "terms_with_prefix",
    "document_frequencies",
    "spelling_suggestions",
    "query_rewrites",
    "highlights",
    "search_weighted_fields",
    "search_title_phrase",
    "discovery_page",
    "discovery_facets",
    "hits_grouped",
    "search_written_index",
    "search_phrase_written_index",
    "discovery_written_index",
    "more_like_this_written_index",
    "rewrites_written_index",
    "spelling_batch",
    "word_breaks_many",
    "hit_phrase_clusters",
    "catalogue_index",
    "more_like_this",
    "facet_several_fields_all_values",
    "facet_price_range",
    "facet_order_years",
    "facet_pivot",
    "upsert",
    "copies_removed",
    "catalogue_titles",
    "catalogue_formats",
    "catalogue_languages",
    "prices_converted",
    "recent_searches",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "broadsheet-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus if cpus.isdigit() else "8",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(REGISTRY) if "all" in sys.argv[1:] else HEADLINE
    deal = spark.sparkContext.defaultParallelism
    REGISTRY["manifest_rows"].build(Tables(spark, folder, deal)).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.time()
        REGISTRY[name].build(Tables(spark, folder, deal)).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        if "all" in sys.argv[1:]:
            print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
