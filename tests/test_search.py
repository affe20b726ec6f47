from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import analysis, filters as flt, group, highlight as hl, search as se, similar
from broadsheet.plans.jobs import discover

DOCS = [
    (1, "tea time", "tea and milk and tea", 3.0),
    (2, "milk", "milk only", 1.0),
    (3, "the tea time of day", "nothing here", None),
    (4, None, "tea", 10.0),
    (5, "other", None, 0.0),
    (6, "time tea", "long text about tea time with many more words than the others have", 2.0),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id int, title string, content string, boost double").cache()


def brute(terms, weights, mm):
    """Scores by the published formula, in plain Python."""
    cols = {"title": 1, "content": 2}
    texts = {f: {d[0]: d[cols[f]].split() for d in DOCS if d[cols[f]] is not None} for f in weights}
    out = {}
    for doc in (d[0] for d in DOCS):
        score, matched = 0.0, 0
        for t in terms:
            best = 0.0
            for f, w in weights.items():
                words = texts[f].get(doc, [])
                tf = words.count(t)
                if tf:
                    n = len(texts[f])
                    df = sum(t in x for x in texts[f].values())
                    avg = sum(map(len, texts[f].values())) / n
                    idf = math.log(1 + (n - df + 0.5) / (df + 0.5))
                    best = max(best, w * idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(words) / avg)))
            matched += best > 0
            score += best
        if matched >= mm:
            out[doc] = (matched, round(score, 9))
    return out


def as_dict(df):
    return {r.id: (r.matched, round(r.score, 9)) for r in df.collect()}


@pytest.mark.parametrize(
    "terms, weights, mm, needed",
    [
        (["tea"], {"content": 1.0}, 1.0, 1),
        (["tea", "milk"], {"content": 1.0}, 1.0, 2),
        (["tea", "milk", "time"], {"content": 1.0, "title": 3.0}, 0.67, 2),
        (["tea", "time"], {"title": 2.0, "content": 0.5}, 1, 1),
    ],
)
def test_scores_match_the_formula(docs, terms, weights, mm, needed):
    want = brute(terms, weights, needed)
    assert want
    assert as_dict(se.search_fields(docs, terms, weights, mm=mm)) == want
    fields = list(weights)
    stored = se.search_postings(
        analysis.postings(docs, "id", fields), analysis.field_lengths(docs, "id", fields), terms, weights, mm=mm
    )
    assert as_dict(stored) == want


def test_stored_index_round_trip(spark, docs, tmp_path):
    se.write_index(docs, str(tmp_path), "id", ["content"], buckets=4)
    rows, lengths = se.read_index(spark, str(tmp_path), ["tea"], buckets=4)
    assert as_dict(se.search_postings(rows, lengths, ["tea"], {"content": 1.0})) == brute(["tea"], {"content": 1.0}, 1)
    assert {r.term for r in rows.select("term").collect()} == {"tea"}


def test_phrase_and_boost(docs):
    plain = as_dict(se.search_fields(docs, ["tea", "time"], {"title": 1.0}))
    phrase = as_dict(se.search_title(docs, ["tea", "time"], "title"))
    assert {k for k in phrase if phrase[k][1] > plain[k][1]} == {1, 3} and phrase[6] == plain[6]
    boosted = as_dict(se.search(docs, ["tea"], boost="boost"))
    assert boosted[4][1] - as_dict(se.search(docs, ["tea"]))[4][1] == pytest.approx(10.0)


def test_empty_query_and_limits(docs):
    assert se.search(docs, []).count() == len(DOCS)
    with pytest.raises(ValueError):
        se.search(docs, [f"t{i}" for i in range(1025)])
    assert se.required_matches(4, 0.5) == 2 and se.required_matches(3, 0.5) == 1 and se.required_matches(3, 9) == 3


def test_filters_do_not_change_scores(docs):
    full = as_dict(se.search(docs, ["tea"]))
    part = as_dict(se.search(docs, ["tea"], filters=[F.col("id") > 1]))
    assert part == {k: v for k, v in full.items() if k > 1}


def test_paging_is_a_top_k(docs):
    hits = se.search(docs, [])
    pages = [[r.id for r in se.page(hits, [F.col("id")], 4, se.page_start(n, 4)).collect()] for n in (1, 2, 3)]
    assert pages == [[1, 2, 3, 4], [5, 6], []]
    (c,) = se.num_found(hits, 4).collect()
    assert (c.num_found, c.page_count) == (6, 2)


def test_named_sorts(spark):
    rows = [("a", "x", 1), ("b", "x", 2), ("c", None, 3)]
    df = spark.createDataFrame(rows, "id string, article_title_s string, issue_pub_date_tdt int")
    assert [r.id for r in df.orderBy(*se.order_columns("title")).collect()] == ["b", "a", "c"]
    assert [r.id for r in df.orderBy(*se.order_columns("date")).collect()] == ["c", "b", "a"]


def test_groups_with_a_null_group(spark):
    rows = [(i, "hot" if i % 3 else None, float(i)) for i in range(1, 31)] + [(99, "cold", 0.5)]
    hits = spark.createDataFrame(rows, "id int, g string, score double")
    out = group.group_hits(hits, "g", [F.col("score").desc(), F.col("id")], per_group=2, groups=2).collect()
    assert {(r.g, r.rank_in_group, r.id) for r in out} == {(None, 1, 30), (None, 2, 27), ("hot", 1, 29), ("hot", 2, 28)}
    assert Counter((r.g, r.group_size, r.matches) for r in out) == {(None, 10, 31): 2, ("hot", 20, 31): 2}


def test_more_like_this_excludes_self_and_ranks(spark):
    texts = ["apple apple pear", "apple pear pear", "apple apple", "kiwi kiwi", "plum plum", "plum plum plum"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    out = similar.more_like_this(df, [0, 4], {"content": 1.0}, min_df=1, count=2)
    got = {(r.seed, r["rank"]): r.id for r in out.collect()}
    assert got == {(0, 1): 2, (0, 2): 1, (4, 1): 5}


def test_more_like_this_joined_either_way(spark):
    texts = ["apple apple pear", "apple pear pear", "apple apple", "kiwi kiwi"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")

    def rows():
        return sorted(map(tuple, similar.more_like_this(df, [0], {"content": 1.0}, min_df=1).collect()))

    small = rows()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert small and rows() == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    with pytest.raises(ValueError):
        similar.more_like_this(df, list(range(1025)), {"content": 1.0})


def test_curated(spark, docs):
    rules = spark.createDataFrame(
        [("tea", 5, 1, False), ("tea", 2, 2, False), ("tea", 1, 0, True), ("tea", 777, 3, False), ("milk", 6, 1, True)],
        "query string, id int, rank int, exclude boolean",
    )
    hits = se.search(docs, ["tea"])
    got = {r.id: r.pin_rank for r in se.curated(hits, rules, "tea", docs).collect()}
    assert got == {5: 1, 2: 2, 4: None, 6: None}
    only = {r.id: r.pin_rank for r in se.curated(hits, rules, "tea").collect()}
    assert only == {4: None, 6: None}


def test_discovery_page(docs):
    found = discover(docs, ["tea"], {"content": 1.0}, facet_fields=["title"], shown=["title"], rows=2)
    assert [r.id for r in found.page.collect()] == [4, 1]
    assert found.num_found.first().num_found == 3
    assert sum(r.n for r in found.facets.collect()) == 2
    assert discover(docs, facet_fields=["title"], shown=["title"]).num_found.first().num_found == 6


def test_range_filter_brackets(spark):
    df = spark.createDataFrame([(v,) for v in (1, 2, 3, None)], "v int")

    def kept(*args, **kw):
        return [r.v for r in df.where(flt.in_range("v", *args, **kw)).collect()]

    assert kept(1, 3) == [1, 2] and kept(1, 3, include_low=False, include_high=True) == [2, 3]
    assert kept(2) == [2, 3] and kept(high=2) == [1] and kept() == [1, 2, 3]


def test_bounding_box_wraps_and_poles(spark):
    df = spark.createDataFrame([(0.0, 179.9), (0.0, -179.9), (0.0, 170.0), (89.99, 10.0)], "lat double, lon double")

    def kept(*args):
        return [(r.lat, r.lon) for r in df.where(flt.bounding_box("lat", "lon", *args)).collect()]

    assert kept(0.0, 179.95, 50.0) == [(0.0, 179.9), (0.0, -179.9)]
    assert kept(0.0, -179.95, 50.0) == [(0.0, 179.9), (0.0, -179.9)]
    assert kept(89.95, -100.0) == [(89.99, 10.0)]
    assert kept(0.0, 170.0) == [(0.0, 170.0)]


def test_word_breaks_look_at_every_term(spark):
    from broadsheet.operators.spelling import word_breaks

    df = spark.createDataFrame([("elevenjoined tail end",)], "t string")
    terms = [f"w{i}" for i in range(10)] + ["eleven", "joined", "tailend"]
    got = {(r.kind, r.query, r.suggestion) for r in word_breaks(df, "t", terms).collect()}
    assert got == {("join", "eleven joined", "elevenjoined"), ("split", "tailend", "tail end")}


@pytest.mark.parametrize(
    "chain, query, text",
    [
        (analysis.Analyser(fold=True), ["café"], "le café noir"),
        (analysis.Analyser(fold=True), ["cafe"], "le Café noir"),
        (analysis.Analyser(elision="fr"), ["L'Café"], "dans le café"),
        (analysis.PLAIN, ["tea-room"], "the tea room"),
        (analysis.Analyser(stems={"ran": "run"}), ["ran"], "they ran"),
        (analysis.Analyser(synonyms=analysis.synonym_table({"pixima": ["pixma"]}, [])), ["pixima"], "a pixima"),
        (analysis.Analyser(stopwords=["the"]), ["the", "tea"], "tea"),
    ],
)
def test_query_is_analysed_like_the_text(spark, chain, query, text):
    df = spark.createDataFrame([(1, text), (2, "other words")], "id int, content string")
    assert [r.id for r in se.search(df, query, analyser=chain, mm=1.0).collect()] == [1]
    rows, lengths = analysis.postings(df, "id", ["content"], chain, lengths=True), analysis.field_lengths(df, "id", ["content"], chain)
    want = as_dict(se.search(df, query, analyser=chain, mm=1.0))
    assert as_dict(se.search_postings(rows, lengths, query, {"content": 1.0}, mm=1.0, analyser=chain)) == want
    shown = df.select(hl.highlight(F.col("content"), query, analyser=chain).alias("h")).collect()
    assert "<b>" in shown[0].h and "<b>" not in shown[1].h


def test_synonyms_in_one_place_count_once(spark):
    chain = analysis.Analyser(synonyms=analysis.synonym_table({}, [["tv", "television"]]))
    df = spark.createDataFrame([(1, "a television set"), (2, "a set"), (3, "tv")], "id int, content string")
    got = {r.id: r.matched for r in se.search(df, ["tv", "set"], analyser=chain, mm=1).collect()}
    assert got == {1: 2, 2: 1, 3: 1}
    rows, lengths = analysis.postings(df, "id", ["content"], chain, lengths=True), analysis.field_lengths(df, "id", ["content"], chain)
    assert as_dict(se.search_postings(rows, lengths, ["tv", "set"], {"content": 1.0}, mm=1, analyser=chain)) == as_dict(
        se.search(df, ["tv", "set"], analyser=chain, mm=1)
    )


def test_phrase_keeps_repeated_words(spark):
    texts = ["to be or not to be", "to be or not now", "be to not or be to", "to be or to be not"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content string")
    query = "to be or not to be".split()
    ranked = se.search_fields(df, query, {"content": 1.0}, phrase_weights={"content": 2.0}, mm=1).orderBy(F.col("score").desc())
    assert ranked.first().id == 0
    gained = {r.id: r.score for r in ranked.collect()}
    base = {r.id: r.score for r in se.search_fields(df, query, {"content": 1.0}, mm=1).collect()}
    assert {i for i in base if gained[i] > base[i]} == {0}


def sloppy(words, query, slop):
    """Beginnings by trying every choice of positions."""
    import itertools

    held = [[p for p, w in enumerate(words, 1) if w == q] for q in query]
    moved = {p - i for i, ps in enumerate(held) for p in ps}
    out = set()
    for start in moved:
        near = [[p for p in ps if start <= p - i <= start + slop] for i, ps in enumerate(held)]
        if any(len(set(c)) == len(c) for c in itertools.product(*near)):
            out.add(start)
    return len(out)


@pytest.mark.parametrize("query", [["a", "b"], ["a", "b", "a"], ["b", "a", "a", "c"], ["a"], ["c", "b", "c", "b"], ["a", "x"]])
@pytest.mark.parametrize("slop", [0, 1, 3])
def test_phrase_positions_from_postings(spark, query, slop):
    import random

    draw = random.Random(len(query) * 7 + slop)
    texts = [(i, " ".join(draw.choices("abcd", k=draw.randint(0, 14)))) for i in range(60)]
    df = spark.createDataFrame(texts, "id int, content string")
    rows, lengths = analysis.postings(df, "id", ["content"], lengths=True), analysis.field_lengths(df, "id", ["content"])
    found = se.search_phrase_postings(rows, se.field_statistics(lengths), query, "content", slop)
    want = {i: n for i, t in texts if (n := sloppy(t.split(), query, slop))}
    assert {r.id: int(r.tf) for r in found.collect()} == want


def test_phrase_search_places_gaps_of_stop_words(spark):
    chain = analysis.Analyser(stopwords=["the"], fold=True)
    df = spark.createDataFrame([(1, "lord of the rings"), (2, "lord of rings")], "id int, content string")
    rows, lengths = analysis.postings(df, "id", ["content"], chain, lengths=True), analysis.field_lengths(df, "id", ["content"], chain)
    found = se.search_phrase_postings(rows, se.field_statistics(lengths), ["lord", "of", "the", "rings"], "content", analyser=chain)
    assert [r.id for r in found.collect()] == [1]


def test_an_index_is_written_in_segments_without_moving_postings(spark, tmp_path):
    rows = [(i, f"tea number{i} tea") for i in range(30)]
    df = spark.createDataFrame(rows, "id int, content string").repartition(3, "id")
    assert df.rdd.getNumPartitions() == 3
    df.write.parquet(f"{tmp_path}/articles")
    parts = spark.read.parquet(*sorted(str(f) for f in (tmp_path / "articles").glob("*.parquet")))
    se.write_index(parts, f"{tmp_path}/index", "id", ["content"], buckets=1)
    stored, _ = se.read_index(spark, f"{tmp_path}/index")
    files = stored.where("term = 'tea'").select(F.input_file_name().alias("f")).distinct().count()
    assert files == parts.rdd.getNumPartitions() > 1
    assert sorted(r.id for r in stored.where("term = 'tea' and tf = 2 and positions = array(1, 3)").collect()) == list(range(30))


def test_postings_of_some_terms_only(spark):
    df = spark.createDataFrame([(1, "tea and tea"), (2, "salt"), (3, None)], "id int, content string")
    every = analysis.postings(df, "id", ["content"], lengths=True)
    some = analysis.postings(df, "id", ["content"], lengths=True, only=["tea", "salt"])
    assert sorted(some.collect()) == sorted(every.where("term in ('tea', 'salt')").collect())
    assert {(r.id, r.term, r.tf, r.dl) for r in some.collect()} == {(1, "tea", 2, 3), (2, "salt", 1, 1)}
