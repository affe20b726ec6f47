from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import source_mixing as sm
from broadsheet.llm.queries import SQL, op9_source_mixing
from tests.oracle import compare, connect
from tests.test_registered import DATA


def plain_count(rate, u):
    k, term = 0, math.exp(-rate)
    reached = term
    while reached <= u:
        k += 1
        term *= rate / k
        reached += term
        if term == 0 and reached <= u:
            break
    return k


def test_poisson_inverse(spark):
    cases = [(r, u) for r in (0.0, 0.01, 0.5, 1.0, 7.3, 63.9) for u in (0.0, 1e-9, 0.1, 0.5, 0.9, 0.999999)]
    df = spark.createDataFrame(cases, "rate double, u double").select("rate", "u", sm.poisson_count(F.col("rate"), F.col("u")).alias("n"))
    for r in df.collect():
        assert r["n"] == plain_count(r["rate"], r["u"]), r


def test_rates_and_mean_counts(spark):
    rows = [(i, "x" * 100, f"s{i % 10 if i % 3 else 0}", "other") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy string")
    weights = spark.createDataFrame([(f"s{k}", 1.0 + k) for k in range(10)], "source string, weight double")
    rates = {r["source"]: r for r in sm.source_rates(docs, weights, scale=2.0).collect()}
    total = sum(r["size"] for r in rates.values())
    for k in range(10):
        r = rates[f"s{k}"]
        assert abs(r["rate"] * r["size"] - (1 + k) / 55 * total * 2) < 1
    out = sm.mixed_sources(docs, weights, scale=2.0)
    assert out.columns == ["doc_id", "text", "source", "copy", "rate", "position"]
    counts = {r["source"]: r["count"] for r in out.groupBy("source").count().collect()}
    for k in range(10):
        want = (1 + k) / 55 * 12000
        assert abs(counts[f"s{k}"] - want) < 5 * math.sqrt(want)
    places = [r["position"] for r in out.collect()]
    assert places == sorted(places) and len(set(places)) == len(places)


def test_large_rates_are_sums(spark):
    docs = spark.createDataFrame([(i, "ab", "s") for i in range(60)], "doc_id long, text string, source string")
    rates = spark.createDataFrame([("s", 900.0)], "source string, rate double")
    n = sm.replicated(docs, rates).count()
    assert abs(n - 54000) < 5 * math.sqrt(54000)


def test_cases(spark):
    rows = [(1, "abc", None), (1, "abc", None), (None, "x" * 50, "a"), (2, None, "b"), (3, "", "b"), (4, "y" * 100_000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rates = {r["source"]: r["rate"] for r in sm.source_rates(docs).collect()}
    assert rates["b"] == 0 and rates[None] > rates["c"] > 0
    again = sm.mixed_sources(docs, scale=4.0)
    assert sorted(map(str, again.collect())) == sorted(map(str, again.collect()))
    only = spark.createDataFrame([("nowhere", 1.0)], "source string, weight double")
    assert sm.mixed_sources(docs, only).count() == 0
    assert sm.mixed_sources(docs.limit(0)).count() == 0


def test_query_and_sql(spark):
    df = op9_source_mixing(spark, DATA)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert compare(df, connect(DATA), SQL["op9_source_mixing"]) is None


@pytest.mark.parametrize("value", [None, 0, -5, 10**15])
def test_uniform(spark, value):
    u = spark.createDataFrame([(value,)], "x long").select(sm.uniform(F.col("x"), F.lit(1)).alias("u")).first()["u"]
    assert 0 <= u < 1


def test_sql_with_a_rate_over_one_part(spark, tmp_path):
    import duckdb

    rows = [(i, "x" * 40_000, "large") for i in range(80)] + [(900, "ab", "tiny"), (901, "c", "tiny"), (902, "y" * 300, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(str(tmp_path / "documents"))
    told = sm.mixed_sources(docs, power=0.5).select("doc_id", "source", "copy", "rate", "position", "text")
    assert told.agg(F.max("rate")).first()[0] > 3 * sm.PART
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert compare(told, con, SQL["op9_source_mixing"]) is None
