from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import vector_code as vc
from broadsheet.llm.queries import SQL, op13_vector_code
from tests.oracle import compare, connect
from tests.test_registered import DATA

SCHEMA = "vec_id long, embedding array<double>, label int, code string, v int"


def floored(x: float) -> int:
    return max(-(1 << 63), min((1 << 63) - 1, math.floor(4096 * x)))


def plain(rows, parts=vc.PARTS, rounds=vc.ROUNDS):
    kept = [(i, [floored(x) for x in v], c) for i, v, c in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // parts) * parts
    kept = sorted(((i, v, c) for i, v, c in kept), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [(i, v + [0] * (width - len(v)), c) for i, v, c in kept]
    step = width // parts
    cut = [[v[p * step : (p + 1) * step] for p in range(parts)] for _, v, _ in kept]
    books = [[cut[k][p] for k in range(min(16, len(kept)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        new = []
        for p, book in enumerate(books):
            mine = [[] for _ in book]
            for x in cut:
                mine[nearest(x[p], book)[1]].append(x[p])
            new.append([[sum(c) // len(m) for c in zip(*m)] if m else old for m, old in zip(mine, book)])
        books = new
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(x[p], books[p]) for p in range(parts)] for x in cut]
    error = [min(sum(d for d, _ in f), (1 << 63) - 1) for f in found]
    by_label = {}
    for (_, _, c), e in zip(kept, error):
        by_label[c] = min(by_label.get(c, 0) + e, (1 << 63) - 1)
    return [(i, "".join(f"{e:02x}" for _, e in f), x, by_label[c], sha) for (i, _, c), f, x in zip(kept, found, error)]


def got(spark, rows):
    frame = spark.createDataFrame([(i, v, c, "x", 1) for i, v, c in rows], SCHEMA)
    told = vc.encode(frame)
    return [tuple(r) for r in told.select("vec_id", vc.hexed(F.col("code")).alias("code"), "error", "label_error", "codebooks_sha256").collect()]


def order(rows):
    return sorted(rows, key=repr)


def test_against_plain_version(spark, monkeypatch):
    draw = random.Random(3)
    centres = [[draw.gauss(0, 1) for _ in range(16)] for _ in range(20)]
    rows = [(i, [x + draw.gauss(0, 0.05) for x in draw.choice(centres)], draw.choice([1, 2, None])) for i in range(400)]
    rows += [(500, None, 1), (501, [], 1), (502, [None] * 16, 1), (503, [math.nan] * 16, 2), (504, [math.inf] * 16, 2)]
    rows += [(505, [0.25] * 16, 3), (506, [0.25] * 16, 3), rows[3], (None, [0.5] * 16, None), (507, [1.0, 2.0], 1), (3, [0.125] * 16, 1)]
    assert order(got(spark, rows)) == order(plain(rows))
    monkeypatch.setattr(vc, "HOT", 3)  # some labels are sent to all tasks, some joined
    assert order(got(spark, rows)) == order(plain(rows))


def test_few_equal_and_no_rows(spark):
    assert got(spark, []) == []
    few = [(2, [0.5] * 5, 1), (1, [-0.5] * 3, None)]
    assert order(got(spark, few)) == order(plain(few))
    equal = [(i, [0.1] * 8, 1) for i in range(40)]
    assert order(got(spark, equal)) == order(plain(equal))


def test_large_components_are_exact(spark):
    rows = [(i, [(-1) ** i * 1e9 * (i + 1), 3e12, 1e-3 * i, 1e300] + [float(i)] * 4, i % 2) for i in range(30)]
    assert order(got(spark, rows)) == order(plain(rows))


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_the_nearest_and_the_lower_of_ties(seed):
    rng = np.random.default_rng(seed)
    book = rng.integers(-6, 7, (16, 2 + seed)) * (1 if seed % 2 else 900)  # small ranges: many ties and equal entries
    points = rng.integers(-7, 8, (500, 2 + seed)) * (1 if seed % 2 else 900)
    found, square = vc.Search(book).nearest(points)
    every = ((points[:, None, :] - book[None]) ** 2).sum(2)
    assert (found == every.argmin(1)).all() and (square == every.min(1)).all()


def test_tree_leaves_out_whole_subtrees():
    rng = np.random.default_rng(9)
    book = np.repeat(rng.integers(-40000, 40000, (4, 8)), 4, 0) + rng.integers(-200, 200, (16, 8))
    points = book[rng.integers(0, 16, 2000)] + rng.integers(-300, 300, (2000, 8))
    search = vc.Search(book)
    search.nearest(points)
    assert search.counted < 0.7 * len(points) * len(book)


def test_query_and_sql(spark):
    assert compare(op13_vector_code(spark, DATA), connect(DATA), SQL["op13_vector_code"]) is None
