"""Analysis, postings, term lists, spelling and highlighting."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.operators import analysis, highlight as hl, search as se, spelling, spelling_index, terms as tm, word_breaks
from broadsheet.operators.analysis import Analyser
from broadsheet.plans import bindings as bind
from broadsheet.plans.registered.registry import Tables, query, tokens_sql
from broadsheet.plans.registered.search import written_index
from broadsheet.session import shared_dir, written

_TOK = tokens_sql("text")
_STOP = ", ".join(f"'{w}'" for w in analysis.STOPWORDS_EN)

_ONE = list(zip(analysis.FOLD_FROM, analysis.FOLD_TO))
_MANY = "text"
for _char, _plain in analysis.FOLD_MANY.items():
    _MANY = f"replace({_MANY}, '{_char}', '{_plain}')"
_FOLDED = f"translate({_MANY}, '{analysis.FOLD_FROM}', '{analysis.FOLD_TO}')"


@query("fold_text", f"SELECT doc_id, md5({_FOLDED}) AS folded FROM documents")
def fold_text(t: Tables):
    return t.documents.select("doc_id", F.md5(analysis.fold_chars(F.col("text"))).alias("folded"))


@query(
    "tokens",
    f"""WITH d AS (SELECT doc_id, {_TOK} AS w FROM documents)
    SELECT doc_id, CAST(len(w) AS INTEGER) AS n, md5(array_to_string(w, ' ')) AS words FROM d""",
)
def tokens(t: Tables):
    words = t.documents.select("doc_id", analysis.tokenize(F.col("text")).alias("w"))
    return words.select("doc_id", F.size("w").alias("n"), F.md5(F.array_join("w", " ")).alias("words"))


@query(
    "token_positions",
    f"""WITH d AS (SELECT {_TOK} AS w FROM documents), e AS (SELECT u.term, u.pos FROM d, unnest(d.w) WITH ORDINALITY AS u(term, pos))
    SELECT term, CAST(count(*) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS position_sum FROM e GROUP BY term""",
)
def token_positions(t: Tables):
    rows = analysis.exploded_terms(t.documents, "doc_id", ["text"])
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("position_sum"))


@query(
    "stopwords_removed",
    f"""WITH d AS (SELECT doc_id, list_filter({_TOK}, lambda w: w NOT IN ({_STOP})) AS w FROM documents)
    SELECT doc_id, CAST(len(w) AS INTEGER) AS n, md5(array_to_string(w, ' ')) AS words FROM d""",
)
def stopwords_removed(t: Tables):
    words = t.documents.select("doc_id", Analyser(stopwords=analysis.STOPWORDS_EN).words(F.col("text")).alias("w"))
    return words.select("doc_id", F.size("w").alias("n"), F.md5(F.array_join("w", " ")).alias("words"))


_STOP_TABLE = f"""stop AS (SELECT lang, word FROM (
   SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS r
   FROM (SELECT lang, unnest({_TOK}) AS word FROM documents) GROUP BY lang, word) WHERE r <= 20)"""


@query(
    "stopwords_removed_by_language",
    f"""WITH {_STOP_TABLE}, d AS (SELECT doc_id, lang, unnest({_TOK}) AS term FROM documents)
    SELECT d.lang, d.term, CAST(count(*) AS BIGINT) AS n FROM d
    WHERE NOT EXISTS (SELECT 1 FROM stop s WHERE s.lang = d.lang AND s.word = d.term) GROUP BY d.lang, d.term""",
)
def stopwords_removed_by_language(t: Tables):
    """Each language's own 20 most frequent words are its stop words."""
    from pyspark.sql import Window

    docs = t.documents
    counts = docs.select("lang", F.explode(analysis.tokenize(F.col("text"))).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "word")
    stop = counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= 20).select("lang", "word")
    tokens = docs.select("lang", F.explode(analysis.tokenize(F.col("text"))).alias("term"))
    left = analysis.remove_stopwords_join(tokens, stop)
    return left.groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n"))


_SYN_REPLACE = {"the": ["ye"], "und": ["and", "plus"]}
_SYN_EXPAND = [["de", "des", "der"]]


@query(
    "synonyms_expanded",
    f"""WITH d AS (SELECT {_TOK} AS w FROM documents), e AS (SELECT u.tk, u.pos FROM d, unnest(d.w) WITH ORDINALITY AS u(tk, pos)),
    s AS (SELECT pos, unnest(CASE WHEN tk = 'the' THEN ['ye'] WHEN tk = 'und' THEN ['and', 'plus']
      WHEN tk IN ('de', 'des', 'der') THEN ['de', 'des', 'der'] ELSE [tk] END) AS term FROM e)
    SELECT term, CAST(count(*) AS BIGINT) AS n, CAST(sum(pos) AS BIGINT) AS position_sum FROM s GROUP BY term""",
)
def synonyms_expanded(t: Tables):
    table = analysis.synonym_table(_SYN_REPLACE, _SYN_EXPAND)
    rows = analysis.exploded_terms(t.documents, "doc_id", ["text"], Analyser(synonyms=table))
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("pos").alias("position_sum"))


_FR = "|".join(analysis.CONTRACTIONS["fr"])


@query(
    "elision_stripped",
    rf"""WITH d AS (SELECT doc_id, replace(text, 'le ', 'l''') AS t FROM documents)
    SELECT doc_id, md5(regexp_replace(t, '(^|[^\p{{L}}\p{{N}}])(?:{_FR})[''’]', '\1', 'gi')) AS stripped FROM d""",
)
def elision_stripped(t: Tables):
    text = F.replace(F.col("text"), F.lit("le "), F.lit("l'"))
    return t.documents.select("doc_id", F.md5(analysis.strip_elision(text, "fr")).alias("stripped"))


@query(
    "hyphen_prefix_stripped",
    r"""WITH d AS (SELECT doc_id, replace(text, ' th', ' t-h') AS t FROM documents)
    SELECT doc_id, md5(regexp_replace(t, '(^|[^\p{L}\p{N}])(?:h|n|t)-', '\1', 'gi')) AS stripped FROM d""",
)
def hyphen_prefix_stripped(t: Tables):
    text = F.replace(F.col("text"), F.lit(" th"), F.lit(" t-h"))
    return t.documents.select("doc_id", F.md5(analysis.strip_hyphen_prefix(text)).alias("stripped"))


@query(
    "stems_overridden",
    f"""WITH d AS (SELECT doc_id, list_transform({_TOK}, lambda w: CASE w WHEN 'was' THEN 'be' WHEN 'is' THEN 'be' ELSE w END) AS w FROM documents)
    SELECT doc_id, md5(array_to_string(w, ' ')) AS words FROM d""",
)
def stems_overridden(t: Tables):
    chain = Analyser(stems={"was": "be", "is": "be", "are": "be"}, protected=["are"])
    return t.documents.select("doc_id", F.md5(F.array_join(chain.words(F.col("text")), " ")).alias("words"))


_LANG_WORDS = {
    "de": ["der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "nicht"],
    "en": ["the", "of", "and", "to", "in", "that", "it", "is", "was", "for"],
    "es": ["de", "la", "que", "el", "en", "los", "se", "las", "por", "una"],
    "fr": ["le", "la", "les", "et", "des", "un", "une", "que", "dans", "est"],
}


def _lang_hits(lang: str) -> str:
    words = ", ".join(f"'{w}'" for w in _LANG_WORDS[lang])
    return f"len(list_filter(w, lambda x: x IN ({words})))"


@query(
    "language_detected",
    f"""WITH d AS (SELECT doc_id, {_TOK} AS w FROM documents),
    h AS (SELECT doc_id, {', '.join(f'{_lang_hits(x)} AS {x}' for x in _LANG_WORDS)} FROM d)
    SELECT doc_id, CASE WHEN greatest(de, en, es, fr) = 0 THEN 'en' WHEN de >= greatest(en, es, fr) THEN 'de'
     WHEN en >= greatest(es, fr) THEN 'en' WHEN es >= fr THEN 'es' ELSE 'fr' END AS language FROM h""",
)
def language_detected(t: Tables):
    return analysis.detect_language(t.documents, "text", _LANG_WORDS).select("doc_id", "language")


@query(
    "postings",
    f"""WITH d AS (SELECT doc_id, {_TOK} AS w FROM documents), e AS (SELECT doc_id, u.term, u.pos FROM d, unnest(d.w) WITH ORDINALITY AS u(term, pos))
    SELECT doc_id, 'text' AS field, term, CAST(count(*) AS BIGINT) AS tf, string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS positions
    FROM e GROUP BY doc_id, term""",
)
def postings(t: Tables):
    rows = analysis.postings(t.documents, "doc_id", ["text"])
    return rows.withColumn("positions", F.array_join(F.col("positions").cast("array<string>"), " "))


@query(
    "field_lengths",
    f"""WITH a AS {bind.ARTICLES_SQL}
    SELECT id, 'content' AS field, CAST(len({tokens_sql('content')}) AS INTEGER) AS dl FROM a
    UNION ALL SELECT id, 'article_title_s', CAST(len({tokens_sql('article_title_s')}) AS INTEGER) FROM a""",
)
def field_lengths(t: Tables):
    return analysis.field_lengths(bind.articles(t.documents), "id", ["content", "article_title_s"])


@query(
    "terms_with_prefix",
    f"""WITH d AS (SELECT unnest(list_distinct({_TOK})) AS term FROM documents)
    SELECT term, CAST(count(*) AS BIGINT) AS n FROM d WHERE term LIKE 'th%' GROUP BY term ORDER BY n DESC, term LIMIT 20""",
)
def terms_with_prefix(t: Tables):
    return tm.terms(t.documents, "text", "th", 20)


@query(
    "document_frequencies",
    f"SELECT term, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest(list_distinct({_TOK})) AS term FROM documents) GROUP BY term",
)
def document_frequencies(t: Tables):
    return tm.document_frequencies(t.documents, "text")


@query(
    "term_vectors",
    f"""WITH e AS (SELECT conv_id || '/' || turn AS id, unnest({_TOK}) AS term FROM conversations), c AS (SELECT id, term, count(*) AS tf FROM e GROUP BY id, term)
    SELECT id, string_agg(term || ':' || tf, ' ' ORDER BY term) AS terms FROM c GROUP BY id""",
)
def term_vectors(t: Tables):
    turns = t.conversations.select(F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"), "text")
    vectors = tm.term_vectors(turns, "id", "text")
    shown = F.transform("terms", lambda x: F.concat_ws(":", x["term"], x["tf"].cast("string")))
    return vectors.select("id", F.array_join(shown, " ").alias("terms"))


_FIELD_TERMS = f"""ft AS (SELECT field, term, count(*) AS n FROM (
   SELECT 'content' AS field, unnest(list_distinct({tokens_sql('content')})) AS term FROM a
   UNION ALL SELECT 'article_title_s', unnest(list_distinct({tokens_sql('article_title_s')})) FROM a) GROUP BY field, term)"""


@query(
    "field_stats",
    f"""WITH a AS {bind.ARTICLES_SQL}, {_FIELD_TERMS}
    SELECT field, (SELECT count(*) FROM documents) AS docs, CAST(count(*) AS BIGINT) AS distinct_terms FROM ft GROUP BY field""",
)
def field_stats(t: Tables):
    return tm.field_stats(bind.articles(t.documents), ["content", "article_title_s"])


@query(
    "top_field_terms",
    f"""WITH a AS {bind.ARTICLES_SQL}, {_FIELD_TERMS}, r AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, term) AS rank FROM ft)
    SELECT field, term, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 10""",
)
def top_field_terms(t: Tables):
    return tm.top_field_terms(bind.articles(t.documents), ["content", "article_title_s"])


@query(
    "frequency_histogram",
    f"""WITH a AS {bind.ARTICLES_SQL}, {_FIELD_TERMS}
    SELECT field, CAST(pow(2, ceil(log2(n))) AS BIGINT) AS bucket, CAST(count(*) AS BIGINT) AS n FROM ft GROUP BY 1, 2""",
)
def frequency_histogram(t: Tables):
    return tm.frequency_histogram(bind.articles(t.documents), ["content", "article_title_s"])


_MISSPELT = ["thatt", "wichh", "frmo", "tionx", "the"]


def _distance(query: str, term: str) -> str:
    """Edit distance in characters: DuckDB's counts bytes, and the asked words are ASCII, so
    any other letter can be replaced by one that is in none of them."""
    return rf"levenshtein({query}, regexp_replace({term}, '[^\x00-\x7f]', '~', 'g'))"


_NEAR = _distance("c.query", "v.term")


@query(
    "spelling_suggestions",
    f"""WITH v AS (SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct({_TOK})) AS term FROM documents) GROUP BY term),
    q AS (SELECT unnest(['thatt', 'wichh', 'frmo', 'tionx']) AS query),
    c AS (SELECT q.query FROM q LEFT JOIN v ON v.term = q.query WHERE coalesce(v.n, 0) <= 0.01 * (SELECT count(*) FROM documents)),
    p AS (SELECT c.query, v.term AS suggestion, {_NEAR} AS distance, v.n FROM c JOIN v ON c.query[1] = v.term[1]
      WHERE {_NEAR} BETWEEN 1 AND 2 AND 1 - {_NEAR} / greatest(length(c.query), length(v.term)) >= 0.5),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, n DESC, suggestion) AS rank FROM p)
    SELECT query, suggestion, CAST(distance AS INTEGER) AS distance, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""",
)
def spelling_suggestions(t: Tables):
    return spelling.suggest(t.documents, "text", _MISSPELT)


# Letters beyond ASCII as capitals, as lower-cased terms have none and this distance counts bytes.
_BEYOND, _CAPITALS = "ßäçèéêíñóöü", "ABCDEFGHIJK"


def _letters(term: str) -> str:
    return f"translate({term}, '{_BEYOND}', '{_CAPITALS}')"


_TRUE_DISTANCE = f"levenshtein({_letters('c.query')}, {_letters('v.term')})"
_VOCABULARY = f"v AS MATERIALIZED (SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct({_TOK})) AS term FROM documents) GROUP BY term)"


@query(
    "spelling_batch",
    f"""WITH {_VOCABULARY},
    q AS (SELECT DISTINCT query FROM (SELECT unnest({_TOK}) AS query FROM benchmark) WHERE length(query) >= 4),
    c AS (SELECT q.query FROM q LEFT JOIN v ON v.term = q.query WHERE coalesce(v.n, 0) <= 0.01 * (SELECT count(*) FROM documents)),
    near AS (SELECT c.query, v.term AS suggestion, v.n, {_TRUE_DISTANCE} AS distance FROM c JOIN v ON c.query[1] = v.term[1]
      WHERE abs(length(c.query) - length(v.term)) <= 2 AND {_TRUE_DISTANCE} BETWEEN 1 AND 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, n DESC, suggestion) AS rank FROM near
      WHERE 1 - distance / greatest(length(query), length(suggestion)) >= 0.5)
    SELECT query, suggestion, CAST(distance AS INTEGER) AS distance, CAST(n AS BIGINT) AS n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""",
)
def spelling_batch(t: Tables):
    """Suggestions for all rare words of a whole table, from stored deletions of the vocabulary."""
    vocabulary = written(tm.document_frequencies(t.documents, "text"), "vocabulary")
    path = shared_dir(t.spark, "deletions")
    spelling_index.write_deletions(vocabulary, path)
    words = t.benchmark.select(F.explode(analysis.tokenize(F.col("text"))).alias("query"))
    n_docs = t.documents.agg(F.count(F.lit(1)))
    return spelling_index.suggest_batch(spelling_index.read_deletions(t.spark, path), vocabulary, words, n_docs)


_MIN_PART = 2
_BREAK_QUERIES = f"""q AS MATERIALIZED (SELECT doc_id AS id, [w[1] || w[2] || w[3], substr(w[4], 1, 2), substr(w[4], 3, 2), substr(w[4], 5)] AS words
    FROM (SELECT doc_id, {_TOK} AS w FROM documents) WHERE len(w) >= 4 AND length(w[4]) > 4)"""


@query(
    "word_breaks_many",
    f"""WITH RECURSIVE {_VOCABULARY}, {_BREAK_QUERIES},
    words AS MATERIALIZED (SELECT DISTINCT id, unnest(words) AS query FROM q),
    asked AS MATERIALIZED (SELECT DISTINCT query FROM words WHERE length(query) >= {2 * _MIN_PART}),
    subs AS MATERIALIZED (SELECT query, i, k, n, term FROM (
      SELECT query, i, k, substr(query, i + 1, k) AS term FROM (SELECT query, i, unnest(range({_MIN_PART}, length(query))) AS k
      FROM (SELECT query, unnest(range(0, length(query))) AS i FROM asked)) WHERE i + k <= length(query)) JOIN v USING (term)),
    walk AS (SELECT query, 0 AS place, 0 AS parts, CAST(0 AS BIGINT) AS n, '' AS said FROM asked
      UNION ALL SELECT w.query, w.place + s.k, w.parts + 1, CAST(w.n + s.n AS BIGINT), CASE WHEN w.parts = 0 THEN s.term ELSE w.said || ' ' || s.term END
      FROM walk w JOIN subs s ON s.query = w.query AND s.i = w.place WHERE w.parts <= 10),
    best AS (SELECT query, said, parts - 1 AS changes, n FROM walk WHERE place = length(query) AND parts > 1
      QUALIFY row_number() OVER (PARTITION BY query ORDER BY parts, n DESC, said) = 1),
    runs AS (SELECT DISTINCT id, array_to_string(words[i : i + k - 1], ' ') AS query, k - 1 AS changes FROM (
      SELECT id, words, i, unnest(range(2, least(len(words) - i + 1, 11) + 1)) AS k FROM (SELECT id, words, unnest(range(1, len(words))) AS i FROM q)))
    SELECT id, 'split' AS kind, query, said AS suggestion, CAST(changes AS INTEGER) AS changes, CAST(n AS BIGINT) AS n FROM words JOIN best USING (query)
    UNION ALL SELECT id, 'join', query, term, CAST(changes AS INTEGER), CAST(n AS BIGINT) FROM runs JOIN v ON v.term = replace(query, ' ', '')""",
)
def word_breaks_many(t: Tables):
    """Three words run together and one torn apart, from the beginning of each document."""
    w = F.col("w")
    queries = (
        t.documents.select(F.col("doc_id").alias("id"), analysis.tokenize(F.col("text")).alias("w"))
        .where((F.size(w) >= 4) & (F.length(F.get(w, 3)) > 4))
        .select(
            "id",
            F.array(
                F.concat(F.get(w, 0), F.get(w, 1), F.get(w, 2)), F.substring(F.get(w, 3), 1, 2), F.substring(F.get(w, 3), 3, 2),
                F.substring(F.get(w, 3), F.lit(5), F.length(F.get(w, 3))),
            ).alias("words"),
        )
    )
    vocabulary = written(tm.document_frequencies(t.documents, "text"), "vocabulary")
    return word_breaks.word_breaks_many(vocabulary, queries, min_part=_MIN_PART)


@query(
    "word_breaks",
    f"""WITH v AS (SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct({_TOK})) AS term FROM documents) GROUP BY term),
    q AS (SELECT unnest(['ofthe', 'an', 'other', 'th', 'at']) AS w),
    s AS (SELECT w, substr(w, 1, i) AS a, substr(w, i + 1) AS b FROM (SELECT w, unnest(range(1, length(w))) AS i FROM q)),
    j AS (SELECT unnest(['ofthe an', 'an other', 'other th', 'th at']) AS w)
    SELECT 'join' AS kind, w AS query, term AS suggestion, CAST(n AS BIGINT) AS n FROM j JOIN v ON v.term = replace(w, ' ', '')
    UNION ALL
    SELECT 'split', w, a || ' ' || b, CAST(least(x.n, y.n) AS BIGINT) FROM s JOIN v x ON x.term = a JOIN v y ON y.term = b""",
)
def word_breaks_two(t: Tables):
    return spelling.word_breaks(t.documents, "text", ["ofthe", "an", "other", "th", "at"])


@query(
    "query_rewrites",
    f"""WITH d AS (SELECT {_TOK} AS w FROM documents),
    v AS (SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct(w)) AS term FROM d) GROUP BY term),
    q AS (SELECT unnest(['thatt', 'frmo']) AS query),
    c AS (SELECT q.query FROM q LEFT JOIN v ON v.term = q.query WHERE coalesce(v.n, 0) <= 0.01 * (SELECT count(*) FROM documents)),
    p AS (SELECT c.query, v.term, {_NEAR} AS distance, v.n FROM c JOIN v ON c.query[1] = v.term[1]
      WHERE {_NEAR} BETWEEN 1 AND 2 AND 1 - {_NEAR} / greatest(length(c.query), length(v.term)) >= 0.5),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, n DESC, term) AS rank FROM p),
    k AS (SELECT query, term, rank FROM r WHERE rank <= 5),
    combos AS (SELECT a.term AS x, b.term AS y, a.rank + b.rank AS cost FROM k a JOIN k b ON a.query = 'thatt' AND b.query = 'frmo'
      ORDER BY cost, x, y LIMIT 5),
    hits AS (SELECT x || ' the ' || y AS rewrite, cost, count(*) AS hits FROM combos JOIN d ON list_contains(d.w, x) AND list_contains(d.w, y) AND list_contains(d.w, 'the') GROUP BY 1, 2),
    own AS (SELECT count(*) AS n FROM d WHERE list_contains(w, 'thatt') AND list_contains(w, 'the') AND list_contains(w, 'frmo')),
    ranked AS (SELECT *, row_number() OVER (ORDER BY cost, rewrite) AS rank FROM hits WHERE (SELECT n FROM own) <= 5)
    SELECT rewrite, CAST(cost AS INTEGER) AS cost, CAST(hits AS BIGINT) AS hits, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 3""",
)
def query_rewrites(t: Tables):
    return spelling.collations(t.documents, "text", ["thatt", "the", "frmo"])


@query(
    "rewrites_written_index",
    f"""WITH d AS (SELECT {_TOK} AS w FROM documents),
    v AS (SELECT term, count(*) AS n FROM (SELECT unnest(list_distinct(w)) AS term FROM d) GROUP BY term),
    q AS (SELECT unnest(['thatt', 'frmo']) AS query),
    c AS (SELECT q.query FROM q LEFT JOIN v ON v.term = q.query WHERE coalesce(v.n, 0) <= 0.01 * (SELECT count(*) FROM documents)),
    p AS (SELECT c.query, v.term, {_NEAR} AS distance, v.n FROM c JOIN v ON c.query[1] = v.term[1]
      WHERE {_NEAR} BETWEEN 1 AND 2 AND 1 - {_NEAR} / greatest(length(c.query), length(v.term)) >= 0.5),
    r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY distance, n DESC, term) AS rank FROM p),
    k AS (SELECT query, term, rank FROM r WHERE rank <= 5),
    combos AS (SELECT a.term AS x, b.term AS y, a.rank + b.rank AS cost FROM k a JOIN k b ON a.query = 'thatt' AND b.query = 'frmo'
      ORDER BY cost, x, y LIMIT 5),
    hits AS (SELECT x || ' the ' || y AS rewrite, cost, count(*) AS hits FROM combos JOIN d ON list_contains(d.w, x) AND list_contains(d.w, y) AND list_contains(d.w, 'the') GROUP BY 1, 2),
    own AS (SELECT count(*) AS n FROM d WHERE list_contains(w, 'thatt') AND list_contains(w, 'the') AND list_contains(w, 'frmo')),
    ranked AS (SELECT *, row_number() OVER (ORDER BY cost, rewrite) AS rank FROM hits WHERE (SELECT n FROM own) <= 5)
    SELECT rewrite, CAST(cost AS INTEGER) AS cost, CAST(hits AS BIGINT) AS hits, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 3""",
)
def rewrites_written_index(t: Tables):
    """The same from an index on disk: suggestions from its vocabulary, hits from its posting lists."""
    articles, path = bind.articles(t.documents), written_index(t)
    vocabulary = se.read_vocabulary(t.spark, path).where(F.col("field") == "content").select("term", "n")
    rows, _ = se.read_index(t.spark, path)
    return spelling.collations(articles, "content", ["thatt", "the", "frmo"], postings=rows, stored=vocabulary)


_TERMS = ["the", "und", "que"]
_IN = ", ".join(f"'{w}'" for w in _TERMS)


def _escape_sql(text: str) -> str:
    return f"replace(replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;')"


def _mark_sql(text: str, wrap: str = "'<b>' || {} || '</b>'") -> str:
    shown = _escape_sql("pc")
    return (
        rf"array_to_string(list_transform(regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'), "
        f"lambda pc: CASE WHEN lower(pc) IN ({_IN}) THEN {wrap.format(shown)} ELSE {shown} END), '')"
    )


def _highlight_sql(pieces: str, table: str = "documents", wrap: str = "'<b>' || {} || '</b>'") -> str:
    return f"""WITH f AS (SELECT doc_id, u.piece, u.i FROM {table}, unnest({pieces}) WITH ORDINALITY AS u(piece, i)),
    s AS (SELECT *, len(list_filter({tokens_sql('piece')}, lambda w: w IN ({_IN}))) AS hits FROM f),
    r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY hits DESC, i) AS rank FROM s WHERE hits > 0),
    h AS (SELECT doc_id, string_agg({_mark_sql('piece', wrap)}, ' ... ' ORDER BY rank) AS shown FROM r WHERE rank <= 3 GROUP BY doc_id)
    SELECT doc_id, coalesce(h.shown, {_escape_sql('substr(text, 1, 750)')}) AS snippet FROM {table} LEFT JOIN h USING (doc_id)"""


@query("highlights", _highlight_sql(r"regexp_extract_all(text, '(?s)(?:.{1,200}(?:\s|\z)|\S+\s?)')"))
def highlights(t: Tables):
    return t.documents.select("doc_id", hl.highlight(F.col("text"), _TERMS).alias("snippet"))


_SIZE, _LEAST, _MOST = hl.REGEX_SIZE, int(hl.REGEX_SIZE * (1 - hl.REGEX_SLOP)), int(hl.REGEX_SIZE * (1 + hl.REGEX_SLOP))
_MARKED = rf"""regexp_replace(text, '([-\w ,/\n"'']{{20,200}})', '\1' || chr(57346), 'g')"""
_STRETCHES = rf"""flatten(list_transform(string_split({_MARKED}, chr(57346)),
  lambda x: regexp_extract_all(x, '(?s)(?:.{{1,{_MOST}}}\z|.{{0,{_MOST - 1}}}\s|.{{1,{_MOST}}})')))"""
_LONGER = "(length(s.o) + length(x.o))"
_CLOSES = f"""({_LONGER} > {_MOST} OR (length(s.o) >= {_LEAST} AND abs(length(s.o) - {_SIZE}) <= abs({_LONGER} - {_SIZE})))"""
_SENTENCES = f"""list_transform([list_reduce(list_transform({_STRETCHES}, lambda p: {{'d': CAST([] AS VARCHAR[]), 'o': p}}),
  lambda s, x: CASE WHEN {_CLOSES} THEN {{'d': list_append(s.d, s.o), 'o': x.o}} ELSE {{'d': s.d, 'o': s.o || x.o}} END)], lambda z: list_append(z.d, z.o))[1]"""


@query("highlights_by_sentence", _highlight_sql(_SENTENCES, "(SELECT * FROM documents WHERE text <> '')"))
def highlights_by_sentence(t: Tables):
    told = t.documents.where("text <> ''")
    return told.select("doc_id", hl.highlight(F.col("text"), _TERMS, fragments=hl.regex_fragments).alias("snippet"))


@query(
    "sentence_fragments",
    f"""SELECT doc_id, len(p) AS n, array_to_string(p, '') = text AS whole, md5(array_to_string(p, '|')) AS pieces
    FROM (SELECT doc_id, text, {_SENTENCES} AS p FROM documents WHERE text <> '')""",
)
def sentence_fragments(t: Tables):
    """The pieces of each text, which put together are the text."""
    told = t.documents.where("text <> ''").select("doc_id", "text", hl.regex_fragments(F.col("text")).alias("p"))
    whole = F.array_join("p", "") == F.col("text")
    return told.select("doc_id", F.size("p").cast("bigint").alias("n"), whole.alias("whole"), F.md5(F.array_join("p", "|")).alias("pieces"))


_BACK = "substr(text, greatest(1, st - 9), least(st, 10))"
_AHEAD = "substr(text, st + 201, 10)"
_BS = r"[.,!? \t\n\r]"


@query(
    "highlights_to_boundaries",
    _highlight_sql(
        rf"""list_transform(range(0, length(text), 200), lambda st:
        (CASE WHEN regexp_matches({_BACK}, '{_BS}') THEN regexp_replace({_BACK}, '(?s)^.*{_BS}', '') ELSE '' END)
        || substr(text, st + 1, 200) ||
        (CASE WHEN regexp_matches({_AHEAD}, '{_BS}') THEN regexp_replace({_AHEAD}, '(?s){_BS}.*$', '') ELSE '' END))"""
    ),
)
def highlights_to_boundaries(t: Tables):
    return t.documents.select("doc_id", hl.highlight(F.col("text"), _TERMS, fragments=hl.boundary_fragments).alias("snippet"))


_COLOUR = (
    "(CASE lower(pc) WHEN 'the' THEN '<b style=\"background:yellow\">' WHEN 'und' THEN '<b style=\"background:lawgreen\">' "
    "ELSE '<b style=\"background:aquamarine\">' END) || {} || '</b>'"
)


@query(
    "highlights_coloured",
    _highlight_sql(r"regexp_extract_all(text, '(?s)(?:.{1,200}(?:\s|\z)|\S+\s?)')", wrap=_COLOUR),
)
def highlights_coloured(t: Tables):
    return t.documents.select("doc_id", hl.highlight(F.col("text"), _TERMS, coloured=True).alias("snippet"))


@query(
    "titles_marked",
    f"SELECT doc_id, {_mark_sql('string_split(text, chr(10))[1]')} AS title FROM documents",
)
def titles_marked(t: Tables):
    title = F.substring_index("text", "\n", 1)
    return t.documents.select("doc_id", hl.mark(title, _TERMS).alias("title"))
