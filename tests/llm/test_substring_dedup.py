from __future__ import annotations

import hashlib

from broadsheet.llm.queries import op1_substring_dedup
from broadsheet.llm.substring_dedup import dedup_substrings
from tests.llm.helpers import frame, prose, words
from tests.test_registered import DATA


def plain(rows, window=50):
    """(words, removed, kept) of each row: windows that begin in a document with a smaller id."""
    first = {}
    for i, text in rows:
        w = words(text)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()), key=str)


def corpus():
    a, b, c = prose(1, 200), prose(2, 300), prose(3, 90)
    loop = ["tick"] * 180
    rows = [
        (5, a + b[:120]), (3, b), (9, b[50:250] + c), (7, c[:49] + a[10:60]), (8, c[:50]), (2, loop), (4, loop[:70] + c),
        (6, a[:100] + ["edit"] + a[101:]), (6, a[:100] + ["edit"] + a[101:]), (10, a + b[:120]), (1, c[:49]),
    ]
    texts = [(i, "  \n".join(w) + "\t") for i, w in rows]
    return texts + [(11, None), (12, ""), (None, " ".join(b)), (13, " \n"), (14, " ".join(prose(9, 30000, 5000))), (15, "x" * 100_000)]


def test_against_plain_version(spark):
    rows = corpus()
    for window in (50, 12):
        assert got(dedup_substrings(frame(spark, rows), window=window)) == plain(rows, window)


def test_factors_cover_what_is_removed(spark):
    for r in dedup_substrings(frame(spark, corpus())).collect():
        assert sum(f["words"] for f in r["factors"]) == r["n_removed"]
        assert all(f["words"] >= 50 and f["source"] < r["doc_id"] for f in r["factors"])


def test_empty_table(spark):
    assert dedup_substrings(frame(spark, [])).count() == 0


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    want = [(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in plain(rows)]
    have = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in op1_substring_dedup(spark, DATA).collect()]
    assert sorted(have, key=str) == sorted(want, key=str)
