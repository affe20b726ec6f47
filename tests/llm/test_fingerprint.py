from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import fingerprint as fp
from broadsheet.llm.queries import op4_fingerprint
from tests.llm.helpers import frame, prose, words
from tests.test_registered import DATA


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def overlap(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain(rows):
    """Beside each row its edited text and the next text, by descending id."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""), reverse=True)
    out = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        out.append((i, text, text[: len(text) - half] + after[:half], after))
    return out


def check(rows, got):
    for i, text, edited, after in plain(rows):
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited"] == edited
        assert abs(r["near_edited"] - overlap(text, edited)) < 0.25 and abs(r["near_next"] - overlap(text, after)) < 0.25


def corpus():
    rows = [(i, " ".join(prose(i % 7, 60 + 5 * i))) for i in range(0, 40, 3)]
    rows += [(100, rows[0][1]), (101, None), (102, ""), (103, "one two"), (104, "é🙂x"), (105, " "), (10**12, "far away"), (106, "w " * 20000)]
    return rows


@pytest.mark.parametrize("neighbours", [8192, 2])
def test_against_plain_version(spark, monkeypatch, neighbours):
    monkeypatch.setattr(fp, "NEIGHBOURS", neighbours)
    rows = corpus()
    got = {r["doc_id"]: r for r in fp.edited_halves(frame(spark, rows)).collect()}
    check(rows, got)
    assert got[0]["fingerprint"] == got[100]["fingerprint"] and got[101]["fingerprint"] == got[102]["fingerprint"] == ""
    assert len(got[103]["fingerprint"]) == fp.BINS * fp.BITS // 4


def test_likeness_of_known_overlap(spark):
    base = prose(50, 3000, 10**6)
    for share in (0.2, 0.5, 0.8):
        cut = int(3000 * 2 * share / (1 + share))
        other = base[:cut] + prose(51, 3000 - cut, 10**6)
        df = spark.createDataFrame([(" ".join(base), " ".join(other))], "a string, b string")
        value = df.select(fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("x")).first()["x"]
        assert abs(value - overlap(" ".join(base), " ".join(other))) < 0.15


def test_empty_bins_are_filled_alike(spark):
    short, longer = " ".join(prose(60, 20)), " ".join(prose(60, 20) + prose(61, 5))
    df = spark.createDataFrame([(short, short), (short, longer)], "a string, b string")
    rows = df.select("a", "b", fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("x")).collect()
    for r in rows:
        assert abs(r["x"] - overlap(r["a"], r["b"])) < 0.25


def test_null_and_repeated_ids_and_empty_table(spark):
    out = fp.edited_halves(frame(spark, [(None, "a b c d"), (1, "x y"), (1, "x y"), (2, "p q r s t")])).collect()
    assert len(out) == 4 and next(r for r in out if r["doc_id"] == 2)["edited"] == "p q rx y"[:9]
    assert fp.edited_halves(frame(spark, [])).count() == 0
    assert len(fp.fingerprints(frame(spark, [(1, "a b")])).collect()) == 1


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    df = op4_fingerprint(spark, DATA)
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r["doc_id"]: r for r in df.collect()}
    wrong = 0
    for i, text, edited, after in plain(rows):
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        wrong += abs(got[i]["near_edited"] - overlap(text, edited)) > 0.2
    assert wrong <= len(rows) * 0.02
