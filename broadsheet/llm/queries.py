"""The registered queries of these operators, with production parameters, and their SQL.

Each takes (spark, folder of the tables), reads its whole table and derives digests from the
operator's results.
"""

from __future__ import annotations

from typing import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.llm import bpe, decontamination, fingerprint, language_crf, lattice_lm, line_dedup, near_dedup, source_mixing, substring_dedup, token_alignment, topk_search, url_filter, vector_code
from broadsheet.llm.work import ship

PIECES = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.tiktoken"
BYTE_LEVEL = "byte_bpe_50k.json"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each text that no earlier document holds within a window of 50 words."""
    kept = substring_dedup.dedup_substrings(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "factors")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without lines that occur before, or nearly so, with each line's source."""
    return line_dedup.dedup_lines(table(spark, folder, "documents"))


def _fold(modulus: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def op3_language_crf(spark: SparkSession, folder: str) -> DataFrame:
    """Language of each text, learned from the labelled rows outside fold 0 of 5."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    told = language_crf.identify(docs, docs.where(_fold(5) != 0).where("lang is not null"))
    return told.select("doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "spans")


def op4_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness."""
    told = fingerprint.edited_halves(table(spark, folder, "documents"))
    return told.withColumn("edited_sha256", F.sha2("edited", 256)).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def op5_lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Log-probability of each text, learned from the texts outside fold 1 of 5."""
    docs = table(spark, folder, "documents")
    return lattice_lm.score(docs, public_tokenizers.path(PIECES), held_out=_fold(5) == 1)


def op6_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of documents whose sets of two-word shingles overlap by four fifths."""
    return near_dedup.near_duplicates(table(spark, folder, "documents"), shingle=2, percent=80)


def op7_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten vectors of greatest inner product with every hundredth vector."""
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


OP7_SQL = """
WITH usable AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""


def op8_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of each text by the rank file, and the bytes that they decode to."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path(BYTE_BPE)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Documents replicated towards sources weighted by the root of their size."""
    mix = source_mixing.mixed_sources(table(spark, folder, "documents"), power=0.5)
    return mix.select("doc_id", "source", "copy", "rate", "position", "text")


# The rules of the URL contract.
URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on each page's URL, by rule or by boosted trees."""
    return url_filter.judged(table(spark, folder, "pages"), URL_RULES)

def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in each text."""
    docs = table(spark, folder, "documents")
    told = token_alignment.align(docs, public_tokenizers.path(BYTE_LEVEL), public_tokenizers.path(PIECES), digest=True)
    return told.withColumnRenamed("groups", "groups_sha256")


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document inside ten-word windows of benchmark items, and these items."""
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    told = decontamination.decontaminate(docs, items)
    return told.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


# Windows as lists of words, and for proximity the three rarest words of each window.
OP12_SQL = r"""
WITH docs AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), items AS MATERIALIZED (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), spans AS MATERIALIZED (
    SELECT item_id, s, least(10, len(w)) AS n, w[s : s + least(10, len(w)) - 1] AS x
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)
), places AS MATERIALIZED (
    SELECT r, n, p, w[p : p + n - 1] AS x
    FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM docs, (SELECT DISTINCT n FROM spans))
), met AS MATERIALIZED (
    SELECT DISTINCT r, p, places.n, item_id FROM places JOIN spans ON places.n = spans.n AND places.x = spans.x
), hit AS (
    SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(p, p + n)) FROM met) GROUP BY r
), told AS (
    SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT r, item_id FROM met) GROUP BY r
), postings AS MATERIALIZED (
    SELECT r, word, p FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs)
    WHERE word IN (SELECT DISTINCT unnest(w) FROM items)
), counts AS MATERIALIZED (
    SELECT word, count(*) AS c FROM postings GROUP BY word
), rare AS MATERIALIZED (
    SELECT item_id, s, list(o ORDER BY c, o) AS os, list(word ORDER BY c, o) AS ws
    FROM (SELECT item_id, s, n, unnest(x) AS word, unnest(range(s, s + n)) AS o FROM spans) JOIN counts USING (word)
    GROUP BY item_id, s, n HAVING count(*) = n
), near_items AS (
    SELECT m.r, count(DISTINCT item_id) AS n_near_items
    FROM (SELECT a.r, item_id, b.word, w3, a.p - o1 + o3 + unnest(range(-2, 3)) AS due
          FROM (SELECT r, item_id, p, o1, w2, o3, w3, p - o1 + o2 + unnest(range(-2, 3)) AS due
                FROM (SELECT DISTINCT item_id, os[1] AS o1, ws[1] AS w1, os[least(2, len(os))] AS o2, ws[least(2, len(os))] AS w2,
                          os[least(3, len(os))] AS o3, ws[least(3, len(os))] AS w3 FROM rare) JOIN postings ON word = w1) a
          JOIN postings b ON b.r = a.r AND b.word = w2 AND b.p = a.due) m
    JOIN postings d ON d.r = m.r AND d.word = w3 AND d.p = m.due
    GROUP BY m.r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0) AS n_near_items
FROM docs LEFT JOIN hit USING (r) LEFT JOIN told USING (r) LEFT JOIN near_items USING (r)
"""


def op13_vector_code(spark: SparkSession, folder: str) -> DataFrame:
    """Codes of all vectors by eight codebooks of sixteen entries, and their errors."""
    told = vector_code.encode(table(spark, folder, "embeddings"))
    return told.select("vec_id", vector_code.hexed(F.col("code")).alias("code"), "error", "label_error", "codebooks_sha256")


def _op13_sql(parts: int = vector_code.PARTS, entries: int = vector_code.ENTRIES, rounds: int = vector_code.ROUNDS) -> str:
    """Every round as tables of its own: assigned parts, then the entries that follow from them."""
    steps = [
        f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS place, vec_id, label, v FROM (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor({vector_code.SCALE} * x::DOUBLE)) AS v FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), parts AS MATERIALIZED (
    SELECT place, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) t(p)
), book0 AS MATERIALIZED (
    SELECT p, place - 1 AS e, x AS c FROM parts WHERE place <= {entries}
)"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""
near{k} AS MATERIALIZED (
    SELECT place, a.p, min({{'d': list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c), 'e': e}}) AS m, any_value(x) AS x
    FROM parts a JOIN book{k} b ON a.p = b.p GROUP BY place, a.p
)""")
        if k < rounds:
            steps.append(f"""
book{k + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN (
        SELECT p, e, list(mean ORDER BY i) AS c FROM (
            SELECT p, e, i, floor(sum(x[i]) / count(*)) AS mean
            FROM (SELECT p, m.e AS e, x, unnest(range(1, len(x) + 1)) AS i FROM near{k}) GROUP BY p, e, i)
        GROUP BY p, e) m ON b.p = m.p AND b.e = m.e
)""")
    steps.append(f"""
told AS MATERIALIZED (
    SELECT place, string_agg(lower(printf('%02x', m.e)), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM near{rounds} GROUP BY place
), sha AS (
    SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN told USING (place), sha
""")
    return ",".join(steps)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_line_dedup": op2_line_dedup,
    "op3_language_crf": op3_language_crf,
    "op4_fingerprint": op4_fingerprint,
    "op5_lattice_lm": op5_lattice_lm,
    "op6_near_dedup": op6_near_dedup,
    "op7_topk_search": op7_topk_search,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_source_mixing": op9_source_mixing,
    "op10_url_filter": op10_url_filter,
    "op11_token_alignment": op11_token_alignment,
    "op12_decontamination": op12_decontamination,
    "op13_vector_code": op13_vector_code,
}

# Rates above 64 are the sum of equal parts with a draw each, and each part's counts reach as far as its rate asks.
OP9_SQL = """
WITH sizes AS (
    SELECT source, coalesce(sum(length(text)), 0)::DOUBLE AS size FROM documents GROUP BY source
), weighed AS (
    SELECT source, size, pow(size, 0.5) AS weight FROM sizes
), rates AS (
    SELECT source, CASE WHEN size > 0
        THEN round(weight / (SELECT sum(weight) FROM weighed) * (SELECT sum(size) FROM weighed) * 1.0 / size, 9)
        ELSE 0.0 END AS rate
    FROM weighed
), parted AS (
    SELECT source, rate, greatest(1, ceil(rate / 64.0))::INTEGER AS parts FROM rates
), drawn AS (
    SELECT row_id, doc_id, source, text, rate, parts, rate / parts AS part_rate,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|17|' || part), 1, 13))::BIGINT / pow(16.0, 13) AS u
    FROM (SELECT row_number() OVER () AS row_id, d.*, r.rate, r.parts, unnest(range(1, r.parts + 1)) AS part
          FROM documents d JOIN parted r ON d.source IS NOT DISTINCT FROM r.source)
), steps AS (
    SELECT part_rate, k, sum(term) OVER (PARTITION BY part_rate ORDER BY k) AS reached
    FROM (SELECT part_rate, k,
              CASE WHEN part_rate > 0 THEN exp(k * ln(CASE WHEN part_rate > 0 THEN part_rate ELSE 1 END) - part_rate - lgamma(k + 1)) ELSE (k = 0)::INTEGER END AS term
          FROM (SELECT part_rate, unnest(range(0, ceil(part_rate + 12 * sqrt(part_rate) + 40)::BIGINT)) AS k
                FROM (SELECT DISTINCT part_rate FROM drawn)))
), counted AS (
    SELECT doc_id, source, text, rate,
        sum((SELECT count(*) FROM steps s WHERE s.part_rate = d.part_rate AND s.reached <= d.u)) AS n
    FROM drawn d GROUP BY row_id, doc_id, source, text, rate
), copies AS (
    SELECT doc_id, source, text, rate, unnest(range(1, n::BIGINT + 1)) AS copy FROM counted WHERE n > 0
)
SELECT doc_id, source, copy, rate,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|17|position|' || copy), 1, 13))::BIGINT / pow(16.0, 13) AS position,
    text
FROM copies
"""

SQL: dict[str, str] = {"op7_topk_search": OP7_SQL, "op9_source_mixing": OP9_SQL, "op12_decontamination": OP12_SQL, "op13_vector_code": _op13_sql()}
