from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import decontamination as dc
from broadsheet.llm.queries import SQL, op12_decontamination
from tests.llm.helpers import frame, prose
from tests.oracle import compare, connect
from tests.test_registered import DATA, plan_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def plain(docs, items, window=10):
    spans = {}
    for i, text in items:
        w = words(text)
        n = min(window, len(w))
        if n and i is not None:
            for k in range(len(w) - n + 1):
                spans.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(s) for s in spans}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in spans:
                    hit |= set(range(k, k + n))
                    found |= spans[tuple(w[k : k + n])]
        out.append((i, len(w), len(hit), tuple(sorted(found))))
    return out


def got(spark, docs, items, **other):
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, term int, doc string")
    told = dc.decontaminate(frame(spark, docs), bench, **other)
    return [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in told.collect()]


def cases():
    draw = random.Random(5)
    items = [(i, " ".join(prose(100 + i, draw.randint(1, 40), 60))) for i in range(25)]
    items += [(50, "Ünïque Words-here 123abc"), (51, None), (52, ""), (53, " .,! "), (None, "the only one without an id"), (54, items[3][1].upper())]
    items += [(55, "the " * 12), (56, items[4][1]), (57, "x"), (3, "other text of the third item"), items[2]]
    docs = []
    for i in range(60):
        w = prose(i, draw.randint(0, 120), 60)
        for _ in range(draw.randint(0, 2)):
            source = words(draw.choice(items)[1])
            at, cut = draw.randint(0, len(w)), draw.randint(0, max(0, len(source) - 10))
            w[at:at] = source[cut:]
        docs.append((i, draw.choice([" ", ", ", "\n--"]).join(w)))
    docs += [(70, None), (71, ""), (72, "..."), (None, items[0][1]), (None, None), docs[5], (6, docs[7][1]), (73, "the the the " * 9)]
    docs += [(74, "ünïque words HERE 123ABC"), (75, "x " * 500), (76, " ".join(w.title() for w in words(items[1][1])))]
    return docs, items


@pytest.mark.parametrize("window, slop", [(10, 2), (4, 0)])
def test_against_plain_version(spark, window, slop):
    docs, items = cases()
    assert sorted(got(spark, docs, items, window=window, slop=slop), key=repr) == sorted(plain(docs, items, window), key=repr)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a b c")]) == []
    assert got(spark, [(1, "a b c")], []) == [(1, 3, 0, ())]


def test_proximity_allows_words_between(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    texts = {
        1: item,
        2: item.replace("delta", "delta so"),
        3: item.replace("beta", "beta one two").replace("theta", "theta three four five six"),
        4: " ".join(reversed(item.split())),
        5: item.replace(" kappa", ""),
    }
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    told = {r["doc_id"]: r for r in dc.decontaminate(frame(spark, texts.items()), bench, slop=2).collect()}
    assert {i for i, r in told.items() if r["n_hit"]} == {1}
    near = {i for i, r in told.items() if r["near_items"]}
    # kappa, missing in one document, is the rarest term; alpha and beta are next.
    assert near >= {1} and 4 not in near and 5 not in near
    wide = dc.decontaminate(frame(spark, texts.items()), bench, slop=8)
    assert {r["doc_id"] for r in wide.where(F.size("near_items") > 0).collect()} == {1, 2, 3}


def test_common_passage_costs_what_it_covers(spark):
    item = " ".join(f"w{i}" for i in range(30))
    docs = [(i, f"before{i % 7} {item} after") for i in range(200)]
    index = dc.build_index(frame(spark, docs), spark.createDataFrame([(1, item)], "item_id long, text string"))
    found = dc.candidates(index)
    assert found.count() <= 200 * 21  # at most one a window
    assert dc.phrase_matches(index, found).count() == 200


def test_plan_has_no_python(spark):
    docs, items = (spark.read.parquet(f"{DATA}/{n}.parquet") for n in ("documents", "benchmark"))
    index = dc.build_index(docs, items)
    found = dc.candidates(index)
    told = [index.postings, found, dc.phrase_matches(index, found), dc.proximity_matches(index, found), op12_decontamination(spark, DATA)]
    for df in told:
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan_of(df))


def test_query_and_sql(spark):
    assert compare(op12_decontamination(spark, DATA), connect(DATA), SQL["op12_decontamination"]) is None
