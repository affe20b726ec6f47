from __future__ import annotations

import random

import numpy as np
import pytest

from broadsheet.llm import near_dedup
from broadsheet.llm.components import components
from broadsheet.llm.queries import op6_near_dedup
from tests.llm.helpers import Union, frame, prose, words
from tests.test_registered import DATA


def plain(rows, shingle, percent=80):
    sets = {}
    for i, text in rows:
        w = [x.lower() for x in words(text)]
        sets[i] = {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
    groups = Union(sets)
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                groups.join(a, b)
    return sorted((i, len(sets[i]), groups.find(i), groups.find(i) == i) for i in ids)


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


def corpus(family=60):
    draw = random.Random(5)
    rows = [(i, " ".join(prose(i, 120))) for i in range(30)]
    base = prose(77, 200)
    for i in range(100, 100 + family):  # a family around one text, at both sides of the threshold
        w = list(base)
        for k in draw.sample(range(200), draw.randint(1, 24)):
            w[k] = f"new{draw.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(300 + i, rows[3][1].upper().replace("É", "é").replace("SS", "ß")) for i in range(5)]
    rows += [(400, None), (401, ""), (402, "\n \t"), (403, "one"), (404, "ONE"), (405, "a b"), (406, "a b"), (407, "x " * 30000)]
    return rows


@pytest.mark.parametrize("shingle", [2, 5])
def test_against_plain_version(spark, shingle):
    rows = corpus()
    assert got(near_dedup.near_duplicates(frame(spark, rows), shingle)) == plain(rows, shingle)


def test_large_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "PAIRED", 2)
    monkeypatch.setattr(near_dedup, "BLOCK_DOCS", 7)
    rows = corpus(90)
    assert got(near_dedup.near_duplicates(frame(spark, rows), 2)) == plain(rows, 2)


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(prose(1, 50))
    out = near_dedup.near_duplicates(frame(spark, [(None, text), (4, text), (4, text), (2, text)]), 5).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in out) == [
        ("2", "2", True), ("4", "2", False), ("4", "2", False), ("None", "None", True)
    ]
    assert near_dedup.near_duplicates(frame(spark, []), 5).count() == 0


def test_estimate_and_merge():
    rng = np.random.default_rng(1)
    elements = rng.integers(0, 2**63, 3000).astype(np.uint64)
    parts = [elements[:2000], elements[500:2500], elements[:2500]]
    sketches = near_dedup.registers(np.concatenate(parts), np.array([0, 2000, 4000, 6500]))
    n = np.array([2000.0])
    estimate = near_dedup.estimated(sketches[:1], sketches[1:2], n, n)[0]
    assert abs(estimate - 0.6) < 0.15
    assert near_dedup.estimated_at_least(sketches[:1], sketches[1:2], n, n, estimate - 0.01)[0]
    assert not near_dedup.estimated_at_least(sketches[:1], sketches[1:2], n, n, estimate + 0.01)[0]
    assert np.array_equal(near_dedup.merged(sketches[0], sketches[1]), sketches[2])


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (20, 20), (None, 4)] + [(100 + i, 101 + i) for i in range(40)]
    out = {r["vertex"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert out == {1: 1, 2: 1, 3: 1, **{i: 5 for i in range(5, 10)}, **{i: 100 for i in range(100, 141)}}


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert got(op6_near_dedup(spark, DATA)) == plain(rows, 2)
