from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

pytest.importorskip("sentencepiece")
P = pytest.importorskip("public_tokenizers")

from broadsheet.llm import lattice_lm as lm  # noqa: E402
from broadsheet.llm.queries import op5_lattice_lm  # noqa: E402
from tests.llm.helpers import words  # noqa: E402
from tests.test_registered import DATA  # noqa: E402

PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return lm.read_pieces(PATH)


def test_lattice_sums_all_segmentations(pieces):
    by_hash = dict(zip(pieces.hashes.tolist(), pieces.prior.tolist()))

    def total(raw, left=None):
        """Sum over segmentations, each cut in turn."""
        if not raw:
            return 1.0
        out = 0.0
        for k in range(1, len(raw) + 1):
            p = by_hash.get(lm._hash(raw[:k]))
            if p is not None:
                out += p * (1 - pieces.stop) * total(raw[k:])
        return out

    for word in ("tea", "the", "über", "日", "qzx"):
        want = math.log(total((lm.SPACE + word).encode()) / (1 - pieces.stop) * pieces.stop)
        assert abs(lm.word_log_p(pieces, pa.array([word]))[0] - want) < 1e-9


def test_expected_counts_add_up(pieces):
    expect = np.zeros(len(pieces.hashes))
    lm.word_log_p(pieces, pa.array(["trade", "trade", "tea"]), expect)
    covered = (expect * pieces.lengths).sum()
    assert abs(covered - sum(len((lm.SPACE + w).encode()) for w in ("trade", "trade", "tea"))) < 1e-6


def test_refitting_raises_the_likelihood(spark, pieces):
    kinds = ["ananas", "banana", "bandana", "ana", "nana"]
    better = lm.fitted(pieces, spark.createDataFrame([(w,) for w in kinds], "word string"))
    assert lm.word_log_p(better, pa.array(kinds)).sum() > lm.word_log_p(pieces, pa.array(kinds)).sum()


def check(rows, got):
    counts = Counter()
    for i, text in rows:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(w.lower() for w in words(text))
            counts[None] += 1
    total, kinds = sum(counts.values()), len(counts)
    for i, text in rows:
        w = [x.lower() for x in words(text)] + [None]
        base = sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(counts[x] > 0 for x in w), total)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 1) and abs(r["base_score"] - base) < 1e-6 * (1 + abs(base))
        assert r["score"] < 0 and math.isfinite(r["score"])


def held(df):
    return lm.score(df, PATH, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)


def test_cases(spark):
    rows = [(i, t) for i, t in enumerate(["Tea tea\tTRADE", None, "", "é É x", " ", "zq " * 20000, "y" * 3000, "tea"])]
    frame = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, chunk int, words string")
    check(rows, {r["doc_id"]: r for r in held(frame).collect()})
    assert held(frame.limit(0)).count() == 0
    twice = held(frame.union(frame)).collect()
    assert len(twice) == 16 and len({(r["doc_id"], round(r["score"], 9)) for r in twice}) == 8
    none = lm.score(frame, PATH, F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and math.isfinite(r["score"]) for r in none)


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    check(rows, {r["doc_id"]: r for r in op5_lattice_lm(spark, DATA).collect()})
