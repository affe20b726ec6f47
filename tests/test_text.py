from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import analysis as an, highlight as hl, spelling, spelling_index, terms as tm, word_breaks as wb
from broadsheet.operators.analysis import Analyser
from broadsheet.session import written


def words(spark, text, chain=an.PLAIN):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(chain.words(F.col("t")).alias("w")).first().w


def test_tokens_and_folding(spark):
    assert words(spark, "Ça va? L'été 1894—Œuvre ß") == ["ça", "va", "l", "été", "1894", "œuvre", "ß"]
    assert words(spark, "Ça ﬁn L'été Œuvre ß", Analyser(fold=True)) == ["ca", "fin", "l", "ete", "oeuvre", "ss"]
    assert words(spark, None) is None and words(spark, " .. ") == []


def test_elision_and_hyphens(spark):
    assert words(spark, "L'homme d’eau, jusqu'ici", Analyser(elision="fr")) == ["homme", "eau", "ici"]
    assert words(spark, "dell'arte", Analyser(elision="it")) == ["arte"]
    assert words(spark, "an t-uisce h-arán", Analyser(hyphen_prefix=True)) == ["an", "uisce", "arán"]


def test_stop_words_leave_gaps_and_synonyms_share_positions(spark):
    chain = Analyser(stopwords=an.STOPWORDS_EN, synonyms=an.synonym_table(an.SYNONYM_REPLACE | {"bbbfoo": ["bbbfoo", "bbbbar"]}))
    df = spark.createDataFrame([("the TV of pixima bbbfoo",)], "t string")
    got = [(p.pos, p.term) for p in df.select(chain.terms(F.col("t")).alias("p")).first().p]
    tv = [(2, w) for w in ("television", "televisions", "tv", "tvs")]
    assert got == tv + [(4, "pixma"), (5, "bbbfoo"), (5, "bbbbar")]


def test_stem_overrides_respect_protected_words(spark):
    assert words(spark, "kind ei huis", Analyser(stems=an.STEMS_NL)) == ["kinder", "eier", "huis"]
    assert words(spark, "kind ei", Analyser(stems=an.STEMS_NL, protected=["kind"])) == ["kind", "eier"]


def test_fixed_tables():
    assert len(an.FOLD_FROM) == len(an.FOLD_TO) == 58 and len(an.FOLD_FROM) + len(an.FOLD_MANY) == 74
    assert len(an.STOPWORDS_EN) == 33 and [len(v) for v in an.CONTRACTIONS.values()] == [6, 13, 3, 21]


def test_language_detection_ties_and_fallback(spark):
    df = spark.createDataFrame([("der hund",), ("le chien the",), ("xyz",)], "t string")
    lists = {"de": ["der"], "fr": ["le"], "en": ["the"]}
    assert [r.language for r in an.detect_language(df, "t", lists).collect()] == ["de", "en", "en"]


def test_postings(spark):
    df = spark.createDataFrame([(1, "a b a", "x"), (2, "b", None)], "id int, content string, title string")
    got = {(r.id, r.field, r.term): (r.tf, r.positions) for r in an.postings(df, "id", ["content", "title"]).collect()}
    assert got[(1, "content", "a")] == (2, [1, 3]) and got[(1, "title", "x")] == (1, [1]) and len(got) == 4
    lengths = {(r.id, r.field): r.dl for r in an.field_lengths(df, "id", ["content", "title"]).collect()}
    assert lengths == {(1, "content"): 3, (1, "title"): 1, (2, "content"): 1}


def test_term_lists(spark):
    df = spark.createDataFrame([(1, "tea tea top"), (2, "tea to"), (3, "xx")], "id int, t string")
    assert [(r.term, r.n) for r in tm.terms(df, "t", "t", 2).collect()] == [("tea", 2), ("to", 1)]
    vectors = {r.id: [(x.term, x.tf) for x in r.terms] for r in tm.term_vectors(df, "id", "t").collect()}
    assert vectors[1] == [("tea", 2), ("top", 1)]
    (stats,) = tm.field_stats(df, ["t"]).collect()
    assert (stats.docs, stats.distinct_terms) == (3, 4)
    assert {(r.bucket, r.n) for r in tm.frequency_histogram(df, ["t"]).collect()} == {(1, 3), (2, 1)}


def vocabulary(spark):
    rows = [(i, "paper paper press") for i in range(5)] + [(i, "papers prose pepper") for i in range(5, 8)] + [(8, "news paper")]
    return spark.createDataFrame(rows, "id int, t string")


def test_spelling(spark):
    rows = spelling.suggest(vocabulary(spark), "t", ["papre", "prss", "pap"]).collect()
    got = {(r.query, r.rank): (r.suggestion, r.distance, r.n) for r in rows}
    assert got[("papre", 1)] == ("paper", 2, 6) and got[("papre", 2)] == ("papers", 2, 3)
    assert got[("prss", 1)] == ("press", 1, 5) and got[("prss", 2)] == ("prose", 2, 3)
    assert not [r for r in rows if r.query == "pap"]


def test_frequent_terms_are_not_corrected(spark):
    assert spelling.suggest(vocabulary(spark), "t", ["paper"]).count() == 0
    assert spelling.suggest(vocabulary(spark), "t", ["paper"], max_query_frequency=1.0).count() > 0
    limited = spelling.suggest(vocabulary(spark), "t", ["paper"], max_query_frequency=1.0, alternative_count=1)
    assert limited.count() == 1
    assert spelling.suggest(vocabulary(spark), "t", []).count() == 0


def test_word_breaks(spark):
    df = spark.createDataFrame([("news paper newspaper boy",), ("paper",)], "t string")
    got = {(r.kind, r.query, r.suggestion, r.n) for r in spelling.word_breaks(df, "t", ["news", "paper", "paperboy"]).collect()}
    assert got == {("join", "news paper", "newspaper", 1), ("split", "paperboy", "paper boy", 1)}


def test_rewrites_must_have_hits_and_are_ordered(spark):
    got = [(r.rewrite, r.hits) for r in spelling.collations(vocabulary(spark), "t", ["papre", "prss"]).orderBy("rank").collect()]
    assert got[0] == ("paper press", 5) and ("papers prose", 3) in got and len(got) <= 3
    assert spelling.collations(vocabulary(spark), "t", ["papre", "prss"], max_results=-1).count() == 0


def test_beam_of_rewrites_is_exact(spark):
    """The cheapest five combinations, against brute force."""
    from itertools import product

    options = [[(1, "a"), (2, "b"), (3, "c")], [(1, "d"), (2, "e"), (5, "f")], [(1, "g"), (4, "h")]]
    df = spark.range(1)
    col = F.array(F.struct(F.lit(0).alias("cost"), F.array().cast("array<string>").alias("words")))
    for choice in options:
        col = spelling._best_extensions(col, F.array(*[F.struct(F.lit(c).alias("cost"), F.lit(w).alias("word")) for c, w in choice]), 5)
    got = [(r.cost, r.words) for r in df.select(col.alias("x")).first().x]
    want = sorted((sum(c for c, _ in p), [w for _, w in p]) for p in product(*options))[:5]
    assert got == want


def shown(spark, text, terms, **options):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(hl.highlight(F.col("t"), terms, **options).alias("h")).first().h


def test_highlight_marks_whole_words_and_escapes(spark):
    assert shown(spark, "Tea & <tea> steam amp", ["tea", "amp"]) == "<b>Tea</b> &amp; &lt;<b>tea</b>&gt; steam <b>amp</b>"


def test_highlight_picks_best_fragments_in_text_order_for_ties(spark):
    filler = "word " * 38
    text = filler + "tea yes   " + filler + "tea tea   " + filler + "tea yes   " + filler
    got = shown(spark, text, ["tea"], snippets=2)
    first, second = got.split(" ... ")
    assert first.count("<b>") == 2 and second.count("<b>") == 1
    assert max(len(p) for p in spark.createDataFrame([(text,)], "t string").select(hl.gap_fragments(F.col("t")).alias("f")).first().f) <= 201


def test_fragments_cover_the_whole_text(spark):
    text = ("lorem ipsum, dolor. " * 60) + "x" * 450 + " end"
    df = spark.createDataFrame([(text,)], "t string")
    assert "".join(df.select(hl.gap_fragments(F.col("t")).alias("f")).first().f) == text
    wide = df.select(hl.boundary_fragments(F.col("t")).alias("f")).first().f
    assert all(len(w) <= 220 for w in wide) and len(wide) == -(-len(text) // 200)


def test_highlight_alternate_and_colours(spark):
    assert shown(spark, "a<b " * 400, ["zzz"]) == ("a<b " * 400)[:750].replace("<", "&lt;")
    got = shown(spark, "tea and milk", ["milk", "tea"], coloured=True)
    assert got == '<b style="background:lawgreen">tea</b> and <b style="background:yellow">milk</b>'
    assert shown(spark, "tea " * 300, ["tea"], fragments=None).count("<b>") == 300


@pytest.mark.parametrize("text", ["", None])
def test_highlight_of_nothing(spark, text):
    assert shown(spark, text, ["tea"]) == text


def plain_fragments(text, size=70, slop=0.5):
    least, most = int(size * (1 - slop)), int(size * (1 + slop))
    places = {m.end() for m in re.finditer(hl.REGEX_FRAGMENT, text, re.ASCII)}
    stretches, at = [], 0
    for end in sorted(places | {len(text)}):
        while at < end:
            part = text[at:end]
            if len(part) > most:
                cuts = [i for i in range(1, most + 1) if part[i - 1] in " \t\n\r\f"]
                part = part[: max(cuts)] if cuts else part[:most]
            stretches.append(part)
            at += len(part)
    out, now = [], ""
    for s in stretches:
        longer = len(now) + len(s)
        if now and (longer > most or len(now) >= least and abs(len(now) - size) <= abs(longer - size)):
            out.append(now)
            now = ""
        now += s
    return out + [now] if now else out


def test_pattern_fragments_lose_no_text(spark):
    draw = random.Random(2)
    words = ["tea", "é", "naïve;", "(trade)", "1801,", "Größe.", "x" * 40, "y" * 300, "\n", "-", "and/or", '"quoted"', "ends!"]
    texts = [" ".join(draw.choices(words, weights=[9, 2, 1, 1, 2, 1, 1, 0.2, 1, 1, 1, 1, 1], k=draw.randint(0, 90))) for _ in range(60)]
    texts += ["", "a", "é" * 500, "word " * 100, "Sentence one is here. " * 20, "\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(-1, None)], "id int, t string")
    got = {r.id: r.p for r in df.select("id", hl.regex_fragments(F.col("t")).alias("p")).collect()}
    assert got.pop(-1) is None
    for i, text in enumerate(texts):
        assert "".join(got[i]) == text and got[i] == plain_fragments(text)
        assert all(len(p) <= 105 for p in got[i])
    shown = df.where("id = 62").select(hl.highlight(F.col("t"), ["é" * 500], fragments=hl.regex_fragments)).first()[0]
    assert shown.startswith("é")


def test_deletions_meet_within_two_edits(spark):
    draw = random.Random(4)
    pairs = []
    for _ in range(3000):
        a = "".join(draw.choices("abcd", k=draw.randint(1, 12)))
        b = list(a)
        for _ in range(draw.randint(0, 2)):
            k = draw.randint(1, len(b)) if len(b) else 0
            b[k : k + draw.randint(0, 1)] = draw.choice(["", "a", "é"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    told = df.select(
        "a", "b", F.levenshtein("a", "b").alias("d"), F.arrays_overlap(spelling_index.deletions(F.col("a")), spelling_index.deletions(F.col("b"))).alias("met"),
        F.size(spelling_index.deletions(F.col("a"))).alias("n"),
    ).collect()
    assert all(r.met for r in told if r.d <= 2 and r.a[:1] == r.b[:1]) and max(r.n for r in told) <= 22


def test_suggestions_for_a_table_are_those_of_each_word(spark, tmp_path):
    draw = random.Random(6)
    stems = ["".join(draw.choices("abcdeé", k=draw.randint(3, 9))) for _ in range(300)]
    docs = spark.createDataFrame([(" ".join(draw.choices(stems, k=8)),) for _ in range(400)], "t string")
    asked = list(dict.fromkeys(["".join(draw.sample(s, len(s))) if i % 3 == 0 else s[:2] + s[3:] + "e" for i, s in enumerate(stems[:90])] + ["abc", "a" * 60]))
    vocabulary = written(tm.document_frequencies(docs, "t"), "vocabulary")
    path = str(tmp_path / "deletions")
    spelling_index.write_deletions(vocabulary, path)
    words = spark.createDataFrame([(w,) for w in asked + asked[:9]], "query string")
    got = spelling_index.suggest_batch(spark.read.parquet(path), vocabulary, words, docs.agg(F.count(F.lit(1))))
    want = spelling.suggest(docs, "t", asked)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()} and got.count() > 50
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "split(" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def plain_break(word, vocabulary, max_changes, min_part):
    ways = []

    def walk(at, parts):
        if at == len(word):
            ways.append(parts)
        for end in range(at + min_part, len(word) + 1):
            if word[at:end] in vocabulary and word[at:end] != word and len(parts) <= max_changes:
                walk(end, [*parts, word[at:end]])

    walk(0, [])
    ways = [w for w in ways if 2 <= len(w) <= max_changes + 1]
    return min(((len(w), -sum(vocabulary[p] for p in w), " ".join(w)) for w in ways), default=None)


def test_words_break_into_many_parts(spark):
    draw = random.Random(7)
    vocabulary = {"".join(draw.choices("abé", k=draw.randint(1, 4))): draw.randint(1, 9) for _ in range(40)}
    asked = ["".join(draw.choices("abé", k=draw.randint(1, 11))) for _ in range(120)] + [*list(vocabulary)[:5], "zzz", "a"]
    v = spark.createDataFrame(list(vocabulary.items()), "term string, n bigint")
    words = spark.createDataFrame([(w,) for w in asked], "query string")
    for max_changes, min_part in ((10, 1), (2, 2)):
        got = {r.query: (r.changes + 1, -r.n, r.suggestion) for r in wb.breaks(v, words, max_changes, min_part).collect()}
        want = {w: b for w in asked if (b := plain_break(w, vocabulary, max_changes, min_part))}
        assert got == want and len(got) > (20 if min_part == 1 else 3)


def test_runs_of_neighbours_join(spark):
    v = spark.createDataFrame([("newspaper", 5), ("newspaperboy", 2), ("paperboy", 3), ("other", 1)], "term string, n bigint")
    queries = spark.createDataFrame([(1, ["news", "paper", "boy"]), (2, ["other"]), (3, []), (4, None), (5, ["news", "paper", "news", "paper"])], "id int, words array<string>")
    got = {(r.id, r.query, r.suggestion, r.changes, r.n) for r in wb.joins(v, queries).collect()}
    assert got == {
        (1, "news paper", "newspaper", 1, 5), (1, "news paper boy", "newspaperboy", 2, 2), (1, "paper boy", "paperboy", 1, 3),
        (5, "news paper", "newspaper", 1, 5),
    }
    assert {r.query for r in wb.joins(v, queries, max_changes=1).collect()} == {"news paper", "paper boy"}
    both = {(r.kind, r.query, r.suggestion) for r in wb.word_breaks_many(v.union(spark.createDataFrame([("news", 1), ("paper", 1)], "term string, n bigint")), queries.union(spark.createDataFrame([(6, ["newspaper"])], "id int, words array<string>"))).collect()}
    assert ("split", "newspaper", "news paper") in both and ("join", "paper boy", "paperboy") in both
