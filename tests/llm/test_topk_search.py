from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import topk_search as tk
from broadsheet.llm.queries import SQL, op7_topk_search
from tests.oracle import compare, connect
from tests.test_registered import DATA


def plain(rows, k):
    usable = {
        (i, tuple(math.floor(1024 * x) for x in v)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    }
    out = set()
    for q, a in usable:
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in usable if c != q)
            out |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])}
    return out


def got(df):
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("block, k", [(4096, 10), (30, 10), (30, 3)])
def test_against_plain_version(spark, monkeypatch, block, k):
    monkeypatch.setattr(tk, "CANDIDATES", block)
    monkeypatch.setattr(tk, "QUERIES", 2)
    draw = random.Random(6)
    as_float = lambda v: [float(np.float32(x)) for x in v]
    rows = [(i, as_float([draw.gauss(0, 1) for _ in range(8)])) for i in range(450)]
    rows += [(i, as_float([0.5] * 8)) for i in range(500, 560)]  # ties
    rows += [(700, None), (701, []), (702, [None] * 8), (703, [float("nan")] * 8), (704, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    rows += [rows[3], (800, [0.0] * 8), (801, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    assert got(tk.top_k(frame, F.col("vec_id") % 100 == 0, k)) == plain(rows, k)


def test_few_rows_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert got(tk.top_k(frame, F.col("vec_id") == 0)) == {(0, 1, 1, 2048 * 1024)}
    assert tk.top_k(frame.limit(0), F.col("vec_id") == 0).count() == 0
    assert tk.top_k(frame, F.col("vec_id") == 9).count() == 0


def test_large_components_are_exact(spark):
    frame = spark.createDataFrame([(0, [3e5, 1.0]), (1, [3e5, 1.0]), (2, [3e5, 0.5]), (3, [1e30, 0.0])], "vec_id long, embedding array<double>")
    best = tk.top_k(frame, F.col("vec_id") == 0, 3).orderBy("rank").collect()
    assert [r["vec_id"] for r in best] == [3, 1, 2] and best[1]["score"] - best[2]["score"] == 512 * 1024


def test_bounds_hold_what_is_best():
    rng = np.random.default_rng(4)
    values, queries = rng.integers(-900, 900, (300, 6)), rng.integers(-900, 900, (5, 6))
    own = np.array([-1, -2, -3, -4, -5])
    for row, may in tk.bounded_rounds(queries, own, values, np.arange(300), 4):
        best = np.argsort(-(values @ queries[row]), kind="stable")[:4]
        assert set(best.tolist()) <= set(may.tolist())


def test_copies_of_queries_are_few_and_never_broadcast(spark, monkeypatch):
    monkeypatch.setattr(tk, "CANDIDATES", 10)
    monkeypatch.setattr(tk, "QUERIES", 2)
    monkeypatch.setattr(tk, "GROUPS", 3, raising=False)
    draw = random.Random(8)
    rows = [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(0, 1000, 5)]
    found = tk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 100 == 0, 4)
    assert got(found) == plain(rows, 4)
    plan = found._jdf.queryExecution().executedPlan().toString()  # as run
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan


def test_query_and_sql(spark):
    assert compare(op7_topk_search(spark, DATA), connect(DATA), SQL["op7_topk_search"]) is None
