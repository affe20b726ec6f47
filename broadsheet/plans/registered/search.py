"""Ranked search, filters, sorting, paging, grouping, similarity and curated results."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from broadsheet.functions.text import natural_key, utc_format
from broadsheet.operators import analysis, filters as flt, group, label_clusters as lc, phrase_clusters as pc, search as se, similar
from broadsheet.operators.terms import terms_of_index
from broadsheet.plans import bindings as bind, jobs
from broadsheet.plans.registered.registry import Tables, query, tokens_sql
from broadsheet.session import shared_dir, written

_TITLE = "article_title_s"
_WEIGHTS = {"content": 1.0, _TITLE: 2.5}


def _idf(n: str, df: str) -> str:
    return f"ln(1 + ({n} - {df} + 0.5) / ({df} + 0.5))"


def _bm25(tf: str, dl: str, n: str, avg: str, df: str) -> str:
    return f"({_idf(n, df)} * {tf} * 2.2 / ({tf} + 1.2 * (0.25 + 0.75 * {dl} / {avg})))"


def _search_ctes(terms: list[str], weights: dict[str, float]) -> str:
    """CTEs ending in ``scored`` (id, term, part): per term the best weighted field."""
    listed = ", ".join(f"'{x}'" for x in terms)
    fields = " UNION ALL ".join(
        f"SELECT id, '{f}' AS field, CAST({w} AS DOUBLE) AS weight, {tokens_sql(f)} AS w FROM a" for f, w in weights.items()
    )
    return f"""a AS {bind.ARTICLES_SQL}, f AS ({fields}),
    st AS (SELECT field, CAST(count(*) AS DOUBLE) AS n, avg(len(w)) AS avg_dl FROM f GROUP BY field),
    tf AS (SELECT id, field, weight, len(w) AS dl, q.term, CAST(len(list_filter(w, lambda x: x = q.term)) AS DOUBLE) AS tf
      FROM f, (SELECT unnest([{listed}]) AS term) q),
    df AS (SELECT field, term, CAST(count(*) AS DOUBLE) AS df FROM tf WHERE tf > 0 GROUP BY field, term),
    scored AS (SELECT id, term, max(weight * {_bm25('tf.tf', 'dl', 'st.n', 'st.avg_dl', 'df.df')}) AS part
      FROM tf JOIN df USING (field, term) JOIN st USING (field) WHERE tf.tf > 0 GROUP BY id, term)"""


def _ranked(matching: str = "count(*) >= 1", extra: str = "") -> str:
    return f"SELECT id, CAST(count(*) AS INTEGER) AS matched, round(sum(part){extra}, 6) AS score FROM scored GROUP BY id HAVING {matching}"


def _shown(hits):
    return hits.withColumn("score", F.round("score", 6))


@query("search_one_field", f"WITH {_search_ctes(['the', 'tion', 'von'], {'content': 1.0})} {_ranked()}")
def search_one_field(t: Tables):
    return _shown(se.search(bind.articles(t.documents), ["the", "tion", "von"]))


@query("search_weighted_fields", f"WITH {_search_ctes(['the', 'of', 'and'], _WEIGHTS)} {_ranked('count(*) = 3')}")
def search_weighted_fields(t: Tables):
    return _shown(se.search_fields(bind.articles(t.documents), ["the", "of", "and"], _WEIGHTS))


@query("search_minimum_match", f"WITH {_search_ctes(['la', 'que', 'des', 'un'], _WEIGHTS)} {_ranked('count(*) >= 3')}")
def search_minimum_match(t: Tables):
    return _shown(se.search_fields(bind.articles(t.documents), ["la", "que", "des", "un"], _WEIGHTS, mm=0.75))


@query("search_stored_postings", f"WITH {_search_ctes(['la', 'que', 'des', 'un'], _WEIGHTS)} {_ranked('count(*) >= 3')}")
def search_stored_postings(t: Tables):
    articles = bind.articles(t.documents)
    fields, terms = list(_WEIGHTS), ["la", "que", "des", "un"]
    rows = analysis.postings(articles, "id", fields, lengths=True, only=terms)
    lengths = analysis.field_lengths(articles, "id", fields)
    return _shown(se.search_postings(rows, lengths, terms, _WEIGHTS, mm=0.75))


_INDEXES: dict[tuple[str, str], str] = {}


def written_index(t: Tables) -> str:
    """An index of the articles in the shared folder, written once an application for all requests; its path."""
    known = (t.spark.sparkContext.applicationId, t._folder)
    if known not in _INDEXES:
        path = shared_dir(t.spark, "index")
        se.write_index(bind.articles(t.documents), path, "id", list(_WEIGHTS))
        _INDEXES[known] = path
    return _INDEXES[known]


@query("search_written_index", f"WITH {_search_ctes(['la', 'que', 'des', 'un'], _WEIGHTS)} {_ranked('count(*) >= 3')}")
def search_written_index(t: Tables):
    """The ranking from an index on disk: the buckets of four terms and one row of statistics a field."""
    path, terms = written_index(t), ["la", "que", "des", "un"]
    rows, lengths = se.read_index(t.spark, path, terms)
    return _shown(se.search_postings(rows, lengths, terms, _WEIGHTS, mm=0.75, statistics=se.read_statistics(t.spark, path)))


@query(
    "terms_written_index",
    f"""WITH d AS (SELECT unnest(list_distinct({tokens_sql('text')})) AS term FROM documents)
    SELECT term, CAST(count(*) AS BIGINT) AS n FROM d WHERE term LIKE 'th%' GROUP BY term ORDER BY n DESC, term LIMIT 20""",
)
def terms_written_index(t: Tables):
    return terms_of_index(se.read_vocabulary(t.spark, written_index(t)), "content", "th", 20)


_NEAR_SLOP = 4
_EXACT, _NEAR = ["la", "de"], ["the", "of", "the"]


def _phrase_sql(words: list[str], slop: int) -> str:
    """Beginnings of a phrase: a position of its own for each word, moved back by its place, within the slop."""
    n = len(words)
    slots = ", ".join(f"pos s{i}" for i in range(n))
    tests = [f"s{i}.id = s0.id AND s{i}.term = '{w}' AND s{i}.p - {i} BETWEEN m.start AND m.start + {slop}" for i, w in enumerate(words)]
    tests += [f"s{i}.p <> s{j}.p" for i in range(n) for j in range(i) if words[i] == words[j]]
    starts = " UNION ".join(f"SELECT id, p - {i} AS start FROM pos WHERE term = '{w}'" for i, w in enumerate(words))
    return f"(SELECT m.id, count(DISTINCT m.start) AS tf FROM ({starts}) m, {slots} WHERE s0.id = m.id AND {' AND '.join(tests)} GROUP BY m.id)"


def _phrase_score_sql(kind: str, words: list[str], slop: int) -> str:
    listed = ", ".join(f"'{w}'" for w in dict.fromkeys(words))
    return f"""SELECT '{kind}' AS kind, id, CAST(x.tf AS DOUBLE) AS tf,
      round(i.idf * x.tf * 2.2 / (x.tf + 1.2 * (0.25 + 0.75 * dl / avg_dl)), 6) AS score
      FROM {_phrase_sql(words, slop)} x JOIN f USING (id), st,
       (SELECT sum({_idf('st.n', 'd.df')}) AS idf FROM st, (SELECT term, count(DISTINCT id) AS df FROM pos WHERE term IN ({listed}) GROUP BY term) d) i"""


@query(
    "search_phrase_written_index",
    f"""WITH f AS MATERIALIZED (SELECT doc_id AS id, {tokens_sql('text')} AS w, len({tokens_sql('text')}) AS dl FROM documents),
    st AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(dl) AS avg_dl FROM f),
    pos AS MATERIALIZED (SELECT id, term, p FROM (SELECT id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS p FROM f) WHERE term IN ('la', 'de', 'the', 'of'))
    {_phrase_score_sql('exact', _EXACT, 0)} UNION ALL {_phrase_score_sql('near', _NEAR, _NEAR_SLOP)}""",
)
def search_phrase_written_index(t: Tables):
    """A phrase, and one with a repeated word and some slop, from the positions of an index on disk."""
    path = written_index(t)
    found = []
    for kind, terms, slop in (("exact", _EXACT, 0), ("near", _NEAR, _NEAR_SLOP)):
        rows, _ = se.read_index(t.spark, path, terms)
        hits = se.search_phrase_postings(rows, se.read_statistics(t.spark, path), terms, "content", slop)
        found.append(_shown(hits).withColumn("kind", F.lit(kind)))
    return found[0].unionByName(found[1])


_FOLD = analysis.Analyser(fold=True)
_MANY = "content"
for _char, _plain in analysis.FOLD_MANY.items():
    _MANY = f"replace({_MANY}, '{_char}', '{_plain}')"
_FOLDED = f"translate({_MANY}, '{analysis.FOLD_FROM}', '{analysis.FOLD_TO}')"


@query(
    "search_folded",
    f"WITH {_search_ctes(['cion', 'fur'], {'content': 1.0}).replace(tokens_sql('content'), tokens_sql(_FOLDED))} {_ranked()}",
)
def search_folded(t: Tables):
    """Accents of the query are folded as those of the text are."""
    return _shown(se.search(bind.articles(t.documents), ["Ción", "für"], analyser=_FOLD))


_SETS = [["der", "die", "das"], ["the", "that"]]
_SYNONYMS = analysis.Analyser(synonyms=analysis.synonym_table({}, _SETS))
_SLOT_OF = "CASE " + " ".join(f"WHEN term IN ({', '.join(repr(x) for x in s)}) THEN {i}" for i, s in enumerate(_SETS)) + " END"
_SET_SIZE = "CASE " + " ".join(f"WHEN term IN ({', '.join(repr(x) for x in s)}) THEN {len(s)}" for s in _SETS) + " ELSE 1 END"


@query(
    "search_synonyms",
    f"""WITH tok AS MATERIALIZED (SELECT doc_id AS id, unnest({tokens_sql('text')}) AS term FROM documents),
    dl AS (SELECT doc_id AS id, coalesce(sum({_SET_SIZE}), 0) AS dl FROM documents LEFT JOIN tok ON tok.id = doc_id WHERE text IS NOT NULL GROUP BY doc_id),
    st AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(dl) AS avg_dl FROM dl),
    tf AS (SELECT id, {_SLOT_OF} AS slot, CAST(sum({_SET_SIZE}) AS DOUBLE) AS tf FROM tok WHERE {_SLOT_OF} IS NOT NULL GROUP BY 1, 2),
    df AS (SELECT slot, CAST(count(*) AS DOUBLE) AS df FROM tf GROUP BY slot)
    SELECT id, CAST(count(*) AS INTEGER) AS matched, round(sum({_bm25('tf.tf', 'dl.dl', 'st.n', 'st.avg_dl', 'df.df')}), 6) AS score
    FROM tf JOIN df USING (slot) JOIN dl USING (id), st GROUP BY id HAVING count(*) = 2""",
)
def search_synonyms(t: Tables):
    """A query of two words, each of which stands for a set; a set counts once towards the match."""
    return _shown(se.search(bind.articles(t.documents), ["die", "the"], analyser=_SYNONYMS, mm=1.0))


_PHRASE = ["of", "the"]


@query(
    "search_title_phrase",
    f"""WITH {_search_ctes(_PHRASE, {_TITLE: 1.0})},
    base AS (SELECT id, count(*) AS matched, sum(part) AS score FROM scored GROUP BY id HAVING count(*) = 2),
    ph AS (SELECT id, len(w) AS dl, CAST(len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the')) AS DOUBLE) AS ptf FROM f),
    idf AS (SELECT sum({_idf('st.n', 'df.df')}) AS s, any_value(st.avg_dl) AS avg_dl FROM df JOIN st USING (field))
    SELECT base.id, CAST(matched AS INTEGER) AS matched,
     round(score + CASE WHEN ptf > 0 THEN 2 * idf.s * ptf * 2.2 / (ptf + 1.2 * (0.25 + 0.75 * dl / idf.avg_dl)) ELSE 0 END, 6) AS score
    FROM base JOIN ph USING (id), idf""",
)
def search_title_phrase(t: Tables):
    return _shown(se.search_title(bind.articles(t.documents), _PHRASE))


@query(
    "search_boosted",
    f"""WITH {_search_ctes(['der', 'die'], {'content': 1.0})}
    SELECT id, CAST(count(*) AS INTEGER) AS matched, round(sum(part) + any_value(article_text_length_ti), 6) AS score
    FROM scored JOIN a USING (id) GROUP BY id""",
)
def search_boosted(t: Tables):
    return _shown(se.search(bind.articles(t.documents), ["der", "die"], boost="article_text_length_ti"))


@query(
    "search_filtered",
    f"""WITH {_search_ctes(['the', 'is'], {'content': 1.0})}
    SELECT id, CAST(count(*) AS INTEGER) AS matched, round(sum(part), 6) AS score FROM scored JOIN a USING (id)
    WHERE article_type_s = 'en' AND issue_year_s = '1801' GROUP BY id""",
)
def search_filtered(t: Tables):
    tests = [flt.field_is("article_type_s", "en"), flt.field_is("issue_year_s", "1801")]
    return _shown(se.search(bind.articles(t.documents), ["the", "is"], filters=tests))


@query("search_empty_query", "SELECT doc_id AS id, 0 AS matched, CAST(0 AS DOUBLE) AS score FROM documents WHERE source = 'src2'")
def search_empty_query(t: Tables):
    return se.search(bind.articles(t.documents), [], filters=[flt.match_all(), flt.field_is("newspaper_title_s", "src2")])


@query(
    "search_page_three",
    f"""WITH {_search_ctes(['the', 'tion', 'von'], {'content': 1.0})}, r AS ({_ranked()})
    SELECT id, score FROM r ORDER BY score DESC, id LIMIT 10 OFFSET 20""",
)
def search_page_three(t: Tables):
    hits = _shown(se.search(bind.articles(t.documents), ["the", "tion", "von"])).select("id", "score")
    return se.page(hits, se.order_columns([("score", "desc")]), rows=10, start=se.page_start(3))


@query(
    "hit_counts",
    f"""WITH {_search_ctes(['the', 'tion', 'von'], {'content': 1.0})}
    SELECT CAST(count(DISTINCT id) AS BIGINT) AS num_found, CAST(ceil(count(DISTINCT id) / 10) AS BIGINT) AS page_count FROM scored""",
)
def hit_counts(t: Tables):
    return se.num_found(se.search(bind.articles(t.documents), ["the", "tion", "von"]))


@query(
    "sorted_by_title",
    f"""SELECT id, article_title_s, strftime(issue_pub_date, '%Y-%m-%dT%H:%M:%SZ') AS issue_pub_date FROM {bind.ARTICLES_SQL}
    ORDER BY article_title_s, issue_pub_date DESC, id LIMIT 50""",
)
def sorted_by_title(t: Tables):
    rows = bind.articles(t.documents).select("id", _TITLE, "issue_pub_date_tdt")
    top = se.page(rows, se.order_columns("title"), rows=50)
    return top.select("id", _TITLE, utc_format(F.col("issue_pub_date_tdt")).alias("issue_pub_date"))


@query(
    "discovery_page",
    f"""WITH {_search_ctes(['the', 'of'], _WEIGHTS)}, r AS ({_ranked('count(*) = 2')})
    SELECT r.id, r.score, article_title_s, issue_year_s FROM r JOIN a USING (id) ORDER BY issue_pub_date DESC, article_title_s, id LIMIT 10""",
)
def discovery_page(t: Tables):
    found = jobs.discover(bind.articles(t.documents), ["the", "of"], _WEIGHTS, sort="date")
    return _shown(found.page).select("id", "score", _TITLE, "issue_year_s")


@query(
    "discovery_facets",
    f"""WITH {_search_ctes(['the', 'of'], _WEIGHTS)}, r AS ({_ranked('count(*) = 2')}), h AS (SELECT a.* FROM r JOIN a USING (id))
    SELECT 'issue_year_s' AS field, issue_year_s AS value, CAST(count(*) AS BIGINT) AS n FROM h GROUP BY 2
    UNION ALL SELECT 'newspaper_title_s', newspaper_title_s, CAST(count(*) AS BIGINT) FROM h GROUP BY 2""",
)
def discovery_facets(t: Tables):
    found = jobs.discover(bind.articles(t.documents), ["the", "of"], _WEIGHTS, facet_fields=("issue_year_s", "newspaper_title_s"))
    return found.facets


@query(
    "hits_grouped",
    f"""WITH {_search_ctes(['the', 'tion', 'von'], {'content': 1.0})}, r AS ({_ranked()}),
    h AS (SELECT r.id, r.score, a.newspaper_title_s FROM r JOIN a USING (id)),
    w AS (SELECT *, row_number() OVER (PARTITION BY newspaper_title_s ORDER BY score DESC, id) AS rank_in_group,
      count(*) OVER (PARTITION BY newspaper_title_s) AS group_size, count(*) OVER () AS matches FROM h),
    g AS (SELECT newspaper_title_s FROM w WHERE rank_in_group = 1 ORDER BY score DESC, id LIMIT 5)
    SELECT id, score, newspaper_title_s, CAST(rank_in_group AS INTEGER) AS rank_in_group, CAST(group_size AS BIGINT) AS group_size,
     CAST(matches AS BIGINT) AS matches FROM w JOIN g USING (newspaper_title_s) WHERE rank_in_group <= 3""",
)
def hits_grouped(t: Tables):
    hits = _shown(se.search(bind.articles(t.documents), ["the", "tion", "von"], keep=["newspaper_title_s"])).drop("matched")
    return group.group_hits(hits, "newspaper_title_s", se.order_columns([("score", "desc")]), per_group=3, groups=5)


@query(
    "more_like_this",
    f"""WITH {_search_ctes(['the', 'of'], {'content': 1.0})}, r AS ({_ranked('count(*) = 2')}),
    seeds AS (SELECT id AS seed FROM r ORDER BY score DESC, id LIMIT 10),
    tok AS (SELECT id, unnest(w) AS term FROM f), counts AS (SELECT id, term, count(*) AS n_tf FROM tok GROUP BY id, term),
    dfs AS (SELECT term, count(*) AS n_df FROM counts GROUP BY term),
    picked AS (SELECT seed, term, n_df FROM (
      SELECT seed, c.term, n_df, row_number() OVER (PARTITION BY seed ORDER BY n_tf * (1 + ln((st.n + 1) / (n_df + 1))) DESC, c.term) AS k
      FROM seeds JOIN counts c ON c.id = seed JOIN dfs USING (term), st WHERE n_tf >= 2 AND n_df >= 5) WHERE k <= 25),
    lens AS (SELECT id, len(w) AS dl FROM f),
    pairs AS (SELECT p.seed, c.id, round(sum({_bm25('c.n_tf', 'lens.dl', 'st.n', 'st.avg_dl', 'p.n_df')}), 6) AS score
      FROM picked p JOIN counts c USING (term) JOIN lens ON lens.id = c.id, st WHERE c.id <> p.seed GROUP BY p.seed, c.id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY score DESC, id) AS rank FROM pairs)
    SELECT seed, id, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 3""",
)
def more_like_this(t: Tables):
    articles = bind.articles(t.documents)
    hits = _shown(se.search_fields(articles, ["the", "of"], {"content": 1.0}))
    shown = se.page(hits, se.order_columns([("score", "desc")]), rows=10).select("id").collect()
    return similar.more_like_this(articles, [r.id for r in shown], {"content": 1.0})


@query(
    "curated_results",
    f"""WITH {_search_ctes(['der', 'die'], {'content': 1.0})}, r AS ({_ranked('count(*) = 2')}),
    pins AS (SELECT id, CAST(row_number() OVER (ORDER BY article_text_length_ti DESC, id) AS INTEGER) AS pin_rank FROM a QUALIFY pin_rank <= 3),
    gone AS (SELECT id FROM a ORDER BY article_text_length_ti, id LIMIT 100)
    SELECT id, matched, score, pin_rank FROM r FULL OUTER JOIN pins USING (id) WHERE id NOT IN (SELECT id FROM gone)""",
)
def curated_results(t: Tables):
    """Curators pin the three longest articles and exclude the hundred shortest."""
    from pyspark.sql import Window

    articles = bind.articles(t.documents)
    hits = _shown(se.search_fields(articles, ["der", "die"], {"content": 1.0}))
    longest = articles.orderBy(F.col("article_text_length_ti").desc(), "id").limit(3)
    # Three rows only: a constant amount of work in one window.
    order = Window.partitionBy(F.lit(1)).orderBy(F.col("article_text_length_ti").desc(), "id")
    pins = longest.select(F.lit("der die").alias("query"), "id", F.row_number().over(order).alias("rank"), F.lit(False).alias("exclude"))
    shortest = articles.orderBy("article_text_length_ti", "id").limit(100)
    gone = shortest.select(F.lit("der die").alias("query"), "id", F.lit(0).alias("rank"), F.lit(True).alias("exclude"))
    return se.curated(hits, pins.unionByName(gone), "der die", articles)


@query(
    "range_filters",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 1000 AND o_totalprice < 200000
    AND o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1998-01-01' AND o_custkey >= 10 AND o_orderstatus = 'F'""",
)
def range_filters(t: Tables):
    from datetime import datetime

    tests = [
        flt.in_range("o_totalprice", 1000.0, 200000.0),
        flt.in_range("o_orderdate", datetime(1996, 1, 1), datetime(1998, 1, 1), include_low=False, include_high=True),
        flt.in_range("o_custkey", 10),
    ]
    return flt.apply_filters(t.orders, tests, always=[flt.field_is("o_orderstatus", "F")]).select("o_orderkey", "o_totalprice")


@query("breadcrumb_filters", "SELECT p_partkey FROM part WHERE p_type = 'SMALL' AND p_size <= 20")
def breadcrumb_filters(t: Tables):
    trail = [flt.field_is("p_type", "SMALL"), flt.in_range("p_size", high=20, include_high=True), flt.field_is("p_brand", "Brand#1")]
    return flt.apply_filters(t.part, flt.breadcrumb(trail, 2)).select("p_partkey")


@query("articles_by_id", "SELECT doc_id AS id, text AS content FROM documents WHERE doc_id IN (3, 77, 150)")
def articles_by_id(t: Tables):
    return flt.get_by_ids(bind.articles(t.documents), [3, 77, 150]).select("id", "content")


_D_LAT = 2000.0 / flt.KM_PER_DEGREE
_D_LON = 2000.0 / (flt.KM_PER_DEGREE * math.cos(math.radians(20.0)))


@query(
    "near_a_point",
    f"""SELECT c_custkey, c_acctbal / 200 AS lat, CAST(c_nationkey * 10 - 120 AS DOUBLE) AS lon FROM customer
    WHERE c_acctbal / 200 BETWEEN {20.0 - _D_LAT!r} AND {20.0 + _D_LAT!r} AND c_nationkey * 10 - 120 BETWEEN {-10.0 - _D_LON!r} AND {-10.0 + _D_LON!r}""",
)
def near_a_point(t: Tables):
    places = t.customer.select(
        "c_custkey", (F.col("c_acctbal") / 200).alias("lat"), (F.col("c_nationkey") * 10 - 120).cast("double").alias("lon")
    )
    return places.where(flt.bounding_box("lat", "lon", 20.0, -10.0, 2000.0))


@query(
    "natural_order_keys",
    "SELECT p_partkey, 'Brand#' || lpad(length(ltrim(string_split(p_brand, '#')[2], '0'))::VARCHAR, 10, '0') || ltrim(string_split(p_brand, '#')[2], '0') AS sort_key FROM part",
)
def natural_order_keys(t: Tables):
    return t.part.select("p_partkey", natural_key(F.col("p_brand")).alias("sort_key"))


@query(
    "natural_order_page",
    """SELECT p_brand, p_partkey FROM part ORDER BY CAST(string_split(p_brand, '#')[2] AS INTEGER), p_partkey LIMIT 25""",
)
def natural_order_page(t: Tables):
    return t.part.orderBy(natural_key(F.col("p_brand")), "p_partkey").limit(25).select("p_brand", "p_partkey")


_STOP = ", ".join(f"'{w}'" for w in analysis.STOPWORDS_EN)
_PHRASES = " UNION ALL ".join(
    f"""SELECT id, {n} AS words, array_to_string(w[i : i + {n - 1}], ' ') AS phrase FROM (SELECT id, w, unnest(range(1, len(w) - {n - 2})) AS i FROM h)
    WHERE w[i] NOT IN ({_STOP}) AND w[i + {n - 1}] NOT IN ({_STOP})"""
    for n in range(1, pc.MAX_WORDS + 1)
)


@query(
    "hit_phrase_clusters",
    f"""WITH RECURSIVE {_search_ctes(['the', 'of', 'that'], {'content': 1.0})}, r AS ({_ranked('count(*) = 3')}),
    h AS MATERIALIZED (SELECT id, {tokens_sql('content')} AS w FROM r JOIN a USING (id)),
    p AS MATERIALIZED (SELECT DISTINCT id, phrase, words FROM ({_PHRASES})),
    c AS (SELECT phrase, words, list(id ORDER BY id) AS ids FROM p GROUP BY phrase, words HAVING count(*) >= {pc.MIN_HITS}),
    named AS (SELECT phrase, words, ids FROM c QUALIFY row_number() OVER (PARTITION BY ids ORDER BY words DESC, phrase) = 1),
    best AS MATERIALIZED (SELECT phrase, ids, row_number() OVER (ORDER BY len(ids) * CASE WHEN words = 1 THEN {pc.SINGLE} ELSE least(words, {pc.LONG}) END DESC, phrase) AS rank
      FROM named QUALIFY rank <= {pc.BASE}),
    links AS MATERIALIZED (SELECT x.rank AS a, y.rank AS b FROM best x JOIN best y ON x.rank <> y.rank
      AND len(list_intersect(x.ids, y.ids)) > {pc.OVERLAP} * greatest(len(x.ids), len(y.ids))),
    reach AS (SELECT rank AS a, rank AS b FROM best UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
    placed AS (SELECT a AS rank, min(b) AS cluster FROM reach GROUP BY a),
    names AS (SELECT cluster, best.rank, phrase FROM placed JOIN best USING (rank)),
    own_names AS (SELECT * FROM names x WHERE NOT EXISTS (SELECT 1 FROM names y WHERE y.cluster = x.cluster AND y.rank < x.rank
      AND contains(' ' || y.phrase || ' ', ' ' || x.phrase || ' '))),
    labels AS (SELECT cluster, array_to_string(list(phrase ORDER BY rank)[1 : {pc.LABEL_PHRASES}], ', ') AS label FROM own_names GROUP BY cluster),
    told AS (SELECT DISTINCT unnest(ids) AS id, cluster FROM best JOIN placed USING (rank)),
    every AS (SELECT id, cluster, label FROM told JOIN labels USING (cluster)
      UNION ALL SELECT id, 0, '{pc.OTHER}' FROM h WHERE id NOT IN (SELECT id FROM told))
    SELECT id, CAST(cluster AS INTEGER) AS cluster, label, CAST(count(*) OVER (PARTITION BY cluster) AS BIGINT) AS size FROM every""",
)
def hit_phrase_clusters(t: Tables):
    """Clusters of all hits of a query by shared phrases."""
    articles = bind.articles(t.documents)
    hits = se.search_fields(articles, ["the", "of", "that"], {"content": 1.0}, keep=["content"])
    return pc.phrase_clusters(written(hits, "hits"), "content")


@query("hit_label_clusters")
def hit_label_clusters(t: Tables):
    """Clusters of all hits of a query, named by the phrases that match the concepts of their wording."""
    articles = bind.articles(t.documents)
    hits = se.search_fields(articles, ["the", "of", "that"], {"content": 1.0}, keep=["content"])
    hits = written(hits, "hits")
    return lc.label_clusters(hits, "content")


@query(
    "discovery_written_index",
    f"""WITH {_search_ctes(['the', 'of'], _WEIGHTS)}, r AS ({_ranked('count(*) = 2')})
    SELECT r.id, r.score, article_title_s, issue_year_s FROM r JOIN a USING (id) ORDER BY issue_pub_date DESC, article_title_s, id LIMIT 10""",
)
def discovery_written_index(t: Tables):
    """The page from an index on disk, with the facets' and the page's columns of the hits only."""
    articles = bind.articles(t.documents)
    found = jobs.discover_index(articles, written_index(t), ["the", "of"], _WEIGHTS, sort="date")
    return _shown(found.page).select("id", "score", _TITLE, "issue_year_s")


@query(
    "more_like_this_written_index",
    f"""WITH {_search_ctes(['the', 'of'], {'content': 1.0})}, r AS ({_ranked('count(*) = 2')}),
    seeds AS (SELECT id AS seed FROM r ORDER BY score DESC, id LIMIT 10),
    tok AS (SELECT id, unnest(w) AS term FROM f), counts AS (SELECT id, term, count(*) AS n_tf FROM tok GROUP BY id, term),
    dfs AS (SELECT term, count(*) AS n_df FROM counts GROUP BY term),
    picked AS (SELECT seed, term, n_df FROM (
      SELECT seed, c.term, n_df, row_number() OVER (PARTITION BY seed ORDER BY n_tf * (1 + ln((st.n + 1) / (n_df + 1))) DESC, c.term) AS k
      FROM seeds JOIN counts c ON c.id = seed JOIN dfs USING (term), st WHERE n_tf >= 2 AND n_df >= 5) WHERE k <= 25),
    lens AS (SELECT id, len(w) AS dl FROM f),
    pairs AS (SELECT p.seed, c.id, round(sum({_bm25('c.n_tf', 'lens.dl', 'st.n', 'st.avg_dl', 'p.n_df')}), 6) AS score
      FROM picked p JOIN counts c USING (term) JOIN lens ON lens.id = c.id, st WHERE c.id <> p.seed GROUP BY p.seed, c.id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY score DESC, id) AS rank FROM pairs)
    SELECT seed, id, score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 3""",
)
def more_like_this_written_index(t: Tables):
    """The same from an index on disk: only the ten seeds' texts are tokenized."""
    articles, path = bind.articles(t.documents), written_index(t)
    rows, lengths = se.read_index(t.spark, path, ["the", "of"])
    hits = _shown(se.search_postings(rows, lengths, ["the", "of"], {"content": 1.0}, statistics=se.read_statistics(t.spark, path)))
    shown = se.page(hits, se.order_columns([("score", "desc")]), rows=10).select("id").collect()
    return similar.more_like_this_index(articles, path, [r.id for r in shown], {"content": 1.0})
