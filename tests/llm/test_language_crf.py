from __future__ import annotations

import numpy as np

from broadsheet.llm import language_crf as crf
from broadsheet.llm.queries import op3_language_crf
from tests.test_registered import DATA


def plain_marginals(values, transitions):
    """Forward-backward word by word, in logs."""
    n, count = values.shape
    alpha, beta = np.zeros((n, count)), np.zeros((n, count))
    alpha[0] = values[0]
    add = np.logaddexp.reduce
    for t in range(1, n):
        alpha[t] = values[t] + add(alpha[t - 1][:, None] + transitions, axis=0)
    for t in range(n - 2, -1, -1):
        beta[t] = add(transitions + (values[t + 1] + beta[t + 1])[None], axis=1)
    chance = alpha + beta
    return np.exp(chance - add(chance, axis=1)[:, None])


def test_blocks_give_the_plain_recursion():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 31, 32, 33, 200, 0, 5]
    values, transitions = rng.normal(0, 3, (sum(sizes), 3)), rng.normal(0, 1, (3, 3))
    first = np.concatenate(([0], np.cumsum(sizes)))
    got = crf.marginals(values, first, transitions)
    for a, b in zip(first, first[1:]):
        if b > a:
            assert np.allclose(got[a:b], plain_marginals(values[a:b], transitions), atol=1e-9)


def test_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(3)
    values, transitions = rng.normal(0, 1, (1, 6, 3)), rng.normal(0, 1, (3, 3))
    gold = rng.integers(0, 3, (1, 6))

    def likelihood(v, t):
        path = sum(v[k, gold[0, k]] for k in range(6)) + sum(t[gold[0, k], gold[0, k + 1]] for k in range(5))
        alpha = v[0]
        for k in range(1, 6):
            alpha = v[k] + np.logaddexp.reduce(alpha[:, None] + t, axis=0)
        return path - np.logaddexp.reduce(alpha)

    slope, turns = crf._slopes(values, gold, transitions)
    step = 1e-6
    for k in range(6):
        for i in range(3):
            moved = values[0].copy()
            moved[k, i] += step
            assert abs((likelihood(moved, transitions) - likelihood(values[0], transitions)) / step - slope[0, k, i]) < 1e-4
    for i in range(3):
        for j in range(3):
            moved = transitions.copy()
            moved[i, j] += step
            assert abs((likelihood(values[0], moved) - likelihood(values[0], transitions)) / step - turns[i, j]) < 1e-4


def corpus(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang").collect()
    by_lang = {}
    for r in docs:
        by_lang.setdefault(r["lang"], []).append(r["text"])
    return docs, by_lang


def test_code_switched_text_and_cases(spark):
    docs, by_lang = corpus(spark)
    texts, labels = zip(*[(t, k) for k, v in by_lang.items() for t in v[:10]])
    model = crf.fit(list(texts), list(labels))
    en, fr = (max(by_lang[k][10:], key=len).split()[:60] for k in ("en", "fr"))
    rows = [(1, " ".join(en + fr), "x"), (2, None, "x"), (3, "123 ... %%", "x"), (4, "", "x"), (None, " ".join(fr), "x"),
            (5, " ".join(en * 300), "x"), (5, " ".join(en * 300), "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = {(r["doc_id"], r["lang_pred"]): r for r in crf.label(frame, model).collect()}
    assert {k for k in got} == {(1, got_one(got, 1)), (2, "und"), (3, "und"), (4, "und"), (None, "fr"), (5, "en")}
    switched = next(r for k, r in got.items() if k[0] == 1)
    assert {s["lang"] for s in switched["spans"]} >= {"en", "fr"} and len(switched["spans"]) <= 12
    assert 0.4 < switched["score"] < 0.7 and got[2, "und"]["score"] == 0.0
    assert {r["lang_pred"] for r in crf.label(frame, None).collect()} == {"und"}
    assert crf.label(frame.limit(0), model).count() == 0
    kept = crf.label(frame, model, keep=["doc_id", "text"]).columns
    assert kept == ["doc_id", "text", "lang_pred", "score", "confidence", "spans"]
    # A text in two languages is as sure as one in a single language, though neither prevails.
    assert switched["confidence"] > 0.8 and got[5, "en"]["confidence"] > 0.8 and got[2, "und"]["confidence"] == 0.0


def test_language_with_long_texts_only(spark):
    _, by_lang = corpus(spark)
    long = lambda k: [" ".join([t] * (1 + 30_000 // max(1, len(t)))) for t in by_lang[k][:20]]
    rows = [(i, t, "en") for i, t in enumerate(t for t in by_lang["en"] if len(t) < 2000) if i < 20]
    rows += [(100 + i, t, "de") for i, t in enumerate(long("de"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, labels = crf.sample(docs)
    assert labels.count("de") == 20 and max(len(t.encode()) for t in texts) <= crf.SAMPLE_BYTES
    told = {r["doc_id"]: r["lang_pred"] for r in crf.identify(docs, docs).collect()}
    assert sum(told[i] == lang for i, _, lang in rows) >= 38


def got_one(got, doc):
    return next(k[1] for k in got if k[0] == doc)


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "tea"), (2, None)], "doc_id long, text string")
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in crf.identify(docs, empty).collect()} == {"und"}
    one = spark.createDataFrame([(1, "tea", "en")], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in crf.identify(docs, one).collect()} == {"en", "und"}


def test_held_out_accuracy(spark):
    docs, _ = corpus(spark)
    lang = {r["doc_id"]: r["lang"] for r in docs}
    held = [r for r in op3_language_crf(spark, DATA).collect() if r["held_out"]]
    assert held and sum(lang[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held)
