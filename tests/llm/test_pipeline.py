from __future__ import annotations

import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline as cp
from broadsheet.llm import language_crf, line_dedup, near_dedup, source_mixing
from tests.llm.helpers import DOCS, prose
from tests.test_registered import DATA


def test_stages_take_effect_one_after_another(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    told = {r["doc_id"]: r for r in language_crf.identify(docs, docs).collect()}
    texts = []
    for n, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        before = {r["doc_id"]: r for r in docs.collect()}
        after = out.collect()
        ids = {r["doc_id"] for r in after}
        if n < 4:
            assert out.columns == cp.COLUMNS
        if name == "language_id":
            assert ids == {i for i, r in told.items() if r["lang_pred"] != "und" and r["confidence"] >= cp.LEAST_CONFIDENCE}
            assert len(ids) == len(after) and all(r["text"] == before[r["doc_id"]]["text"] for r in after)
        elif name == "line_dedup":
            want = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
            assert all(r["text"] == want[r["doc_id"]]["kept"] and r["n_chars"] == len(r["text"]) for r in after)
            assert ids == {i for i, r in want.items() if not r["n_removed"] or r["kept"]}
        elif name == "near_dedup":
            want = {r["doc_id"] for r in near_dedup.near_duplicates(docs, 5).collect() if r["kept"]}
            assert ids == want and len(after) == len(ids)
        elif name == "source_mixing":
            assert len(after) == source_mixing.mixed_sources(docs).count() and ids <= set(before)
            texts = sorted((r["doc_id"], r["n_chars"]) for r in after)
        else:
            assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in after)
            assert sorted((r["doc_id"], r["n_chars"]) for r in after) == texts
        docs = out


def test_odd_rows_and_empty_table(spark):
    text = "\n".join(" ".join(prose(i, 12)) for i in range(3))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, None, None, None, None), (None, text, "en", "b", 1), (3, "", "en", "a", 0), (4, "1 2", "en", "a", 3)]
    for frame in (spark.createDataFrame(rows, DOCS), spark.createDataFrame([], DOCS)):
        docs = frame
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, DATA)
        docs.collect()
