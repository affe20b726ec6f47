"""Every registered query against its SQL, and the shape of its plan, on the smallest tables."""

from __future__ import annotations

import os
import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.oracle import compare, connect

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(DATA)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# The training-data queries have their own tests and may run Python.
@pytest.mark.parametrize("name", [n for n in sorted(queries()) if not re.match(r"op\d+_|pipeline$", n)])
def test_query(spark, con, name):
    df = queries()[name](spark, DATA)
    plan = plan_of(df)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert unwanted not in plan, f"{unwanted} in the plan of {name}"
    if name in oracle_sql():
        assert compare(df, con, oracle_sql()[name]) is None
    else:
        assert df.count() > 0


# These read back what they derived from the tables.
BACK = (
    "shards_written log_of_batches streamed_articles hit_clusters search_written_index terms_written_index search_phrase_written_index "
    "spelling_batch word_breaks_many hit_phrase_clusters hit_label_clusters committed_articles streamed_once streamed_status sketched_stats "
    "status_written indexed_once discovery_written_index more_like_this_written_index rewrites_written_index"
).split()


def test_every_query_reads_given_tables(spark):
    for name, run in queries().items():
        if name in BACK or re.match(r"op\d+_|pipeline$", name):
            continue
        assert DATA in plan_of(run(spark, DATA)), name


def test_entry(spark):
    assert entry(spark).count() == 10


def read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: struct<(.*?)>", plan)


def test_scans_read_only_needed_columns(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(queries()["facet_pivot"](spark, DATA))
    assert read_schemas(plan) == ["lang:string,source:string"]
    plan = plan_of(queries()["range_filters"](spark, DATA))
    assert "GreaterThanOrEqual(o_totalprice,1000.0)" in plan and "EqualTo(o_orderstatus,F)" in plan
    plan = plan_of(queries()["recent_searches"](spark, DATA))
    assert "EqualTo(event_type,view)" in plan


def test_written_index_reads_the_buckets_of_its_terms(spark):
    plan = plan_of(queries()["search_written_index"](spark, DATA))
    assert "split(" not in plan and "/lengths" not in plan
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters", 1)[1][:400]
    assert "StartsWith(term,th)" in plan_of(queries()["terms_written_index"](spark, DATA))


def test_requests_over_a_written_index_tokenize_nothing(spark):
    for name in ("discovery_written_index", "more_like_this_written_index", "rewrites_written_index", "search_phrase_written_index", "spelling_batch"):
        plan = plan_of(queries()[name](spark, DATA))
        assert "split(lower(" not in plan or name == "spelling_batch", name
    assert "split(lower(text" not in plan_of(queries()["discovery_written_index"](spark, DATA))


def test_postings_need_no_shuffle(spark):
    assert "Exchange" not in plan_of(queries()["postings"](spark, DATA)).replace("RoundRobin", "")


def test_top_k_is_cut_before_the_shuffle(spark):
    for name in ("copies_removed", "recent_searches", "hits_grouped", "upsert"):
        plan = plan_of(queries()[name](spark, DATA))
        assert "Partial" in plan.split("WindowGroupLimit", 1)[1], name
    assert "TakeOrderedAndProject" in plan_of(queries()["newest_articles_page"](spark, DATA))


def test_documents_are_parsed_once(spark):
    plan = plan_of(queries()["articles_per_issue"](spark, DATA))
    assert plan.count("from_xml(") == 1 and plan.count("from_csv(") == 1
    plan = plan_of(queries()["search_one_field"](spark, DATA))
    # One tokenization for the statistics, one for the hits.
    assert plan.count("split(lower(") == 2


def test_records_to_parse_are_dealt_out_by_number(spark):
    df = queries()["full_records"](spark, DATA)
    assert df.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
