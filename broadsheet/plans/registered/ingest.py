"""Manifests, issue XML, article records, rejects, counters and record formats."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from broadsheet.functions import display, naming, ring, text as fx
from broadsheet.functions.typed import cast_by_suffix
from broadsheet.operators import counters, extract, facets
from broadsheet.operators.search import order_columns, page
from broadsheet.plans import bindings as bind, jobs
from broadsheet.plans.registered.registry import Tables, query, tokens_sql
from broadsheet.session import shared_dir
from broadsheet.sources import lookup, manifest, marc, records, sinks

PREFIX = "art-"

_DAY = "(DATE '1800-01-01' + CAST(doc_id % 30000 AS INTEGER))"
_ISSUES = f"""issues AS (
 SELECT doc_id, lang, source, n_chars, text, {_DAY} AS day,
  CASE WHEN source = 'src13' THEN 'BAD_LINE' WHEN source = 'src17' THEN 'BAD_FILENAME' ELSE 'OK' END AS status
 FROM documents)"""
_PARTS = f"""{_ISSUES}, parts AS (
 SELECT i.*, u.line, CAST(u.n AS INTEGER) AS n FROM issues i, unnest(string_split(i.text, chr(10))) WITH ORDINALITY AS u(line, n)
 WHERE status = 'OK' AND source NOT IN ('src5', 'src6'))"""
_CONTENT = r"trim(regexp_replace(trim(line, ' ' || chr(9)), '[ \t]+', ' ', 'g') || ' <end>')"
_STAMP = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"
_DIGI = "TIMESTAMP '2010-08-27 11:09:00' + to_seconds(doc_id % 60)"


@query(
    "manifest_rows",
    f"""WITH {_ISSUES}
    SELECT status, CAST(CASE WHEN status <> 'BAD_LINE' THEN doc_id END AS VARCHAR) AS domid,
     CASE WHEN status <> 'BAD_LINE' THEN 'The "' || source || '" Times, daily' END AS simpletitle,
     CASE WHEN status <> 'BAD_LINE' THEN upper(source) END AS npid,
     CASE status WHEN 'OK' THEN CAST(year(day) AS VARCHAR) WHEN 'BAD_FILENAME' THEN '1899' END AS year,
     CASE WHEN status = 'OK' THEN {_STAMP.format('day')} END AS pub_date,
     CASE WHEN status <> 'BAD_LINE' THEN {_STAMP.format(_DIGI)} END AS digi_date
    FROM issues
    UNION ALL
    SELECT 'HEADER', NULL, NULL, NULL, NULL, NULL, NULL FROM (SELECT DISTINCT source FROM documents)""",
)
def manifest_rows(t: Tables):
    rows = manifest.parse_manifest(bind.manifest_lines(t.documents))
    shown = F.col("status").isin(manifest.OK, manifest.BAD_FILENAME)
    return rows.select(
        "status",
        *[F.when(shown, F.col(c)).alias(c) for c in ("domid", "simpletitle", "npid", "year")],
        F.when(shown, fx.utc_format(F.col("pub_date"))).alias("pub_date"),
        F.when(shown, fx.utc_format(F.col("digi_date"))).alias("digi_date"),
    )


@query(
    "manifest_rows_ctrl_a",
    f"""SELECT CASE WHEN source = 'src17' THEN 'BAD_FILENAME' ELSE 'OK' END AS status,
     CAST(doc_id AS VARCHAR) AS domid, 'The "' || source || '" Times, daily' AS simpletitle,
     CASE WHEN source = 'src17' THEN 'SRC17-1899.xml' ELSE upper(source) || '-' || strftime({_DAY}, '%Y-%m-%d') || '.xml' END AS originalname
    FROM documents""",
)
def manifest_rows_ctrl_a(t: Tables):
    rows = manifest.parse_manifest_ctrl_a(bind.manifest_lines_ctrl_a(t.documents))
    return rows.select("status", "domid", "simpletitle", "originalname")


@query(
    "manifest_rejects",
    f"""WITH {_ISSUES} SELECT status AS reason, CAST(count(*) AS BIGINT) AS n FROM issues WHERE status <> 'OK' GROUP BY status""",
)
def manifest_rejects(t: Tables):
    rejects = manifest.rejected(manifest.parse_manifest(bind.manifest_lines(t.documents)))
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "issues_missing",
    "SELECT CAST(doc_id AS VARCHAR) AS domid, upper(source) AS npid FROM documents WHERE source = 'src5'",
)
def issues_missing(t: Tables):
    good = manifest.accepted(manifest.parse_manifest(bind.manifest_lines(t.documents)))
    return extract.missing_issues(good, bind.issue_xml(t.documents)).select("domid", "npid")


def _articles(t: Tables):
    good = manifest.accepted(manifest.parse_manifest(bind.manifest_lines(t.documents)))
    return extract.extract_articles(good, bind.issue_xml(t.documents), PREFIX)


@query(
    "article_table",
    f"""WITH {_PARTS}
    SELECT '{PREFIX}' || doc_id || '-' || n AS id, doc_id || '-' || n AS article_id_s,
     'Item ' || n || ' of "' || doc_id || '"' AS article_title_s, lang AS article_type_s,
     CAST(doc_id % 100 AS DOUBLE) / 100 AS article_ocr_quality_td,
     CASE WHEN n_chars > 1000 THEN 'yes' ELSE 'no' END AS article_ocr_relevant_s,
     {_CONTENT} AS content, CAST(length({_CONTENT}) AS INTEGER) AS article_text_length_ti,
     CAST((n - 1) // 5 + 1 AS INTEGER) AS page_i, CAST((n - 1) % 5 + 1 AS INTEGER) AS article_i,
     dayname(day) AS issue_day_of_week_s, 'I' || doc_id AS issue_id_s, source AS newspaper_id_s,
     'The "' || source || '" Times, daily' AS newspaper_title_s, upper(source) AS newspaper_internal_id_s,
     upper(source) || '-' || strftime(day, '%Y-%m-%d') || '.xml' AS issue_original_filename_s,
     doc_id AS issue_domid_l, {_STAMP.format('day')} AS issue_pub_date_tdt,
     {_STAMP.format(_DIGI)} AS issue_digi_date_tdt, CAST(year(day) AS VARCHAR) AS issue_year_s
    FROM parts""",
)
def article_table(t: Tables):
    rows = _articles(t)
    dates = {c: fx.utc_format(F.col(c)) for c in ("issue_pub_date_tdt", "issue_digi_date_tdt")}
    return rows.withColumns(dates)


@query(
    "issue_status",
    f"""WITH {_ISSUES}
    SELECT CAST(doc_id AS VARCHAR) AS domid,
     CASE source WHEN 'src5' THEN 'NO_DOCUMENT' WHEN 'src6' THEN 'BAD_XML' ELSE 'PARSED' END AS status,
     CAST(CASE WHEN source IN ('src5', 'src6') THEN 0 ELSE len(string_split(text, chr(10))) END AS BIGINT) AS n_articles
    FROM issues WHERE status = 'OK'""",
)
def issue_status(t: Tables):
    good = manifest.accepted(manifest.parse_manifest(bind.manifest_lines(t.documents)))
    return extract.issue_status(good, extract.parse_issues(bind.issue_xml(t.documents)))


@query(
    "articles_per_issue",
    f"WITH {_PARTS} SELECT doc_id AS issue_domid_l, CAST(count(*) AS BIGINT) AS n FROM parts GROUP BY doc_id",
)
def articles_per_issue(t: Tables):
    return counters.articles_per_issue(_articles(t))


@query(
    "job_status_counts",
    f"""WITH {_ISSUES}
    SELECT CASE WHEN source IN ('src5', 'src6') THEN 'FAILED' ELSE 'GOOD' END AS status,
     CAST(sum(CASE WHEN source IN ('src5', 'src6') THEN 0 ELSE len(string_split(text, chr(10))) END) AS BIGINT) AS n
    FROM issues WHERE status = 'OK' GROUP BY 1""",
)
def job_status_counts(t: Tables):
    docs = t.documents
    return jobs.index_articles(bind.manifest_lines(docs), bind.issue_xml(docs), PREFIX).status


@query(
    "job_rejects",
    f"""WITH {_ISSUES}
    SELECT CASE WHEN status <> 'OK' THEN status WHEN source = 'src5' THEN 'NO_DOCUMENT' ELSE 'BAD_XML' END AS reason,
     CAST(count(*) AS BIGINT) AS n FROM issues WHERE status <> 'OK' OR source IN ('src5', 'src6') GROUP BY 1""",
)
def job_rejects(t: Tables):
    docs = t.documents
    rejects = jobs.index_articles(bind.manifest_lines(docs), bind.issue_xml(docs), PREFIX).rejects
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _without_ids(docs):
    """The issues' XML, in which every seventh issue's articles have no id."""
    xml = bind.issue_xml(docs)
    bare = F.regexp_replace("xml", "<article><id>[^<]*</id>", "<article>")
    return xml.select("domid", F.when(F.col("domid").cast("bigint") % 7 == 0, bare).otherwise(F.col("xml")).alias("xml"))


@query(
    "rejects_without_id",
    f"""WITH {_PARTS} SELECT CASE source WHEN 'src17' THEN 'SRC17-1899.xml' ELSE upper(source) || '-' || strftime(day, '%Y-%m-%d') || '.xml' END AS what,
     'NO_ID' AS reason, CAST(count(*) AS BIGINT) AS n FROM parts WHERE doc_id % 7 = 0 GROUP BY 1""",
)
def rejects_without_id(t: Tables):
    """Articles without an id are told by their issue's file."""
    docs = t.documents
    rejects = jobs.index_articles(bind.manifest_lines(docs), _without_ids(docs), PREFIX).rejects
    return rejects.where(F.col("reason") == "NO_ID").groupBy("what", "reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "indexed_once",
    f"""WITH {_PARTS}
    SELECT 'article' AS kind, '{PREFIX}' || doc_id || '-' || n AS what, CAST(1 AS BIGINT) AS n FROM parts WHERE doc_id % 7 <> 0
    UNION ALL SELECT 'reject', reason, CAST(count(*) AS BIGINT) FROM (
      SELECT CASE WHEN status <> 'OK' THEN status WHEN source = 'src5' THEN 'NO_DOCUMENT' ELSE 'BAD_XML' END AS reason
      FROM issues WHERE status <> 'OK' OR source IN ('src5', 'src6')
      UNION ALL SELECT 'NO_ID' FROM parts WHERE doc_id % 7 = 0) GROUP BY reason
    UNION ALL SELECT 'status', CASE WHEN source IN ('src5', 'src6') THEN 'FAILED' ELSE 'GOOD' END,
     CAST(sum(CASE WHEN source IN ('src5', 'src6') THEN 0 ELSE len(string_split(text, chr(10))) END) AS BIGINT)
    FROM issues WHERE status = 'OK' GROUP BY 2""",
)
def indexed_once(t: Tables):
    """Articles, rejects and status counts from one written parse."""
    docs = t.documents
    job = jobs.index_once(bind.manifest_lines(docs), _without_ids(docs), shared_dir(t.spark, "parsed"), PREFIX)
    rows = job.articles.select(F.lit("article").alias("kind"), F.col("id").alias("what"), F.lit(1).cast("bigint").alias("n"))
    rejects = job.rejects.groupBy(F.lit("reject").alias("kind"), F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return rows.unionByName(rejects).unionByName(job.status.select(F.lit("status").alias("kind"), F.col("status").alias("what"), "n"))


@query(
    "status_written",
    f"""WITH {_ISSUES}
    SELECT CASE WHEN source IN ('src5', 'src6') THEN 'FAILED' ELSE 'GOOD' END AS key,
     CAST(sum(CASE WHEN source IN ('src5', 'src6') THEN 0 ELSE len(string_split(text, chr(10))) END) AS BIGINT) AS n
    FROM issues WHERE status = 'OK' GROUP BY 1""",
)
def status_written(t: Tables):
    """The job's counters as a status file, read back."""
    docs = t.documents
    path = shared_dir(t.spark, "status")
    status = jobs.index_articles(bind.manifest_lines(docs), bind.issue_xml(docs), PREFIX).status
    sinks.write_status(status.withColumnRenamed("status", "key"), path)
    return t.spark.read.schema("key string, n bigint").option("sep", "\t").csv(path)


_SHARD = "CAST(CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) % 4 AS INTEGER)"


@query(
    "shard_assignment",
    f"SELECT doc_id, {_SHARD.format('CAST(doc_id AS VARCHAR)')} AS shard FROM documents",
)
def shard_assignment(t: Tables):
    return t.documents.select("doc_id", naming.shard_of(F.col("doc_id"), 4).alias("shard"))


_ROT = "((({x}) * {up} % 4294967296) + ({x}) // {down})"


def _rot(x: str, bits: int) -> str:
    return _ROT.format(x=x, up=1 << bits, down=1 << (32 - bits))


def _xor(a: str, b: str) -> str:
    return f"CAST(xor(CAST({a} AS UBIGINT), CAST({b} AS UBIGINT)) AS HUGEINT)"


# The published hash step by step, each block of four bytes scrambled and folded in; the last one is the tail.
_RING_SQL = f"""ids AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source || '!' || doc_id ELSE 'art-' || doc_id END AS id FROM documents),
    p AS (SELECT doc_id, 'w' AS part, id AS text FROM ids WHERE NOT contains(id, '!')
      UNION ALL SELECT doc_id, 'u', string_split(id, '!')[1] FROM ids WHERE contains(id, '!')
      UNION ALL SELECT doc_id, 'l', string_split(id, '!')[2] FROM ids WHERE contains(id, '!')),
    x AS (SELECT *, hex(encode(text)) AS hx, octet_length(encode(text)) AS size FROM p),
    k0 AS (SELECT *, list_transform(range(0, size // 4 + 1), lambda b: list_sum(list_transform(range(0, 4), lambda j:
      CASE WHEN 4 * b + j < size THEN CAST('0x' || substr(hx, CAST(2 * (4 * b + j) + 1 AS BIGINT), 2) AS BIGINT) * (1 << (8 * j)) ELSE 0 END))::HUGEINT) AS k FROM x),
    k1 AS (SELECT * EXCLUDE (k), list_transform(k, lambda v: v * {ring.C1} % 4294967296) AS k FROM k0),
    k2 AS (SELECT * EXCLUDE (k), list_transform(k, lambda v: {_rot('v', 15)} * {ring.C2} % 4294967296) AS k FROM k1),
    h0 AS (SELECT *, list_reduce(list_concat([CAST(0 AS HUGEINT)], k[1 : size // 4]),
      lambda h, v: ({_rot(_xor('h', 'v'), 13)} * 5 + {ring.ADD}) % 4294967296) AS h FROM k2),
    h1 AS (SELECT * EXCLUDE (h), {_xor(_xor('h', 'k[size // 4 + 1]'), 'size')} AS h FROM h0),
    h2 AS (SELECT * EXCLUDE (h), {_xor('h', 'h // 65536')} * {ring.MIX1} % 4294967296 AS h FROM h1),
    h3 AS (SELECT * EXCLUDE (h), {_xor('h', 'h // 8192')} * {ring.MIX2} % 4294967296 AS h FROM h2),
    h4 AS (SELECT doc_id, part, {_xor('h', 'h // 65536')} AS h FROM h3),
    ring AS (SELECT doc_id, sum(CASE part WHEN 'w' THEN h WHEN 'u' THEN h - h % 65536 ELSE h % 65536 END) AS place FROM h4 GROUP BY doc_id),
    signed AS (SELECT doc_id, CAST(CASE WHEN place > 2147483647 THEN place - 4294967296 ELSE place END AS BIGINT) AS place FROM ring)"""


@query(
    "shard_ring",
    f"""WITH {_RING_SQL} SELECT doc_id, CAST(place AS INTEGER) AS place,
     CAST((((place + 2147483648) >> 16) * 5) >> 16 AS INTEGER) AS shard FROM signed""",
)
def shard_ring(t: Tables):
    """Every third id is composite, so that its newspaper's articles lie together."""
    key = F.when(F.col("doc_id") % 3 == 0, F.concat(F.col("source"), F.lit("!"), F.col("doc_id").cast("string"))).otherwise(
        F.concat(F.lit("art-"), F.col("doc_id").cast("string"))
    )
    return t.documents.select("doc_id", ring.ring_hash(key).alias("place"), ring.ring_shard(key, 5).alias("shard"))


@query(
    "shard_counts",
    f"""WITH s AS (SELECT CAST({_SHARD.format('CAST(doc_id AS VARCHAR)')} AS VARCHAR) AS shard, n_chars > 5000 AS failed FROM documents),
    c AS (SELECT shard, count(*) AS n, count(*) FILTER (failed) AS f FROM s GROUP BY shard)
    SELECT shard AS key, CAST(n - f AS BIGINT) AS n FROM c
    UNION ALL SELECT 'TOTAL ' || shard, CAST(n AS BIGINT) FROM c
    UNION ALL SELECT 'FAILURES ' || shard, CAST(f AS BIGINT) FROM c""",
)
def shard_counts(t: Tables):
    placed = sinks.with_shard(t.documents, 4, "doc_id").withColumn("failed", F.col("n_chars") > 5000)
    return counters.shard_counts(placed, "failed")


@query(
    "shards_written",
    f"""WITH s AS (SELECT CAST({_SHARD.format('CAST(doc_id AS VARCHAR)')} AS VARCHAR) AS shard FROM documents),
    c AS (SELECT shard, count(*) AS n FROM s GROUP BY shard)
    SELECT shard AS key, CAST(n AS BIGINT) AS n FROM c
    UNION ALL SELECT 'TOTAL ' || shard, CAST(n AS BIGINT) FROM c
    UNION ALL SELECT 'FAILURES ' || shard, 0 FROM c""",
)
def shards_written(t: Tables):
    articles = bind.articles(t.documents)
    return jobs.load_shards(articles, f"{shared_dir(t.spark, 'shards')}/out", 4)


@query(
    "year_facet_of_index",
    f"""WITH {_PARTS} SELECT CAST(year(day) AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n FROM parts GROUP BY 1""",
)
def year_facet_of_index(t: Tables):
    return facets.facet_field(_articles(t), "issue_year_s")


@query(
    "newest_articles_page",
    f"""WITH {_PARTS} SELECT '{PREFIX}' || doc_id || '-' || n AS id, 'Item ' || n || ' of "' || doc_id || '"' AS article_title_s,
     {_STAMP.format('day')} AS issue_pub_date FROM parts
     ORDER BY day DESC, article_title_s ASC, id ASC LIMIT 10""",
)
def newest_articles_page(t: Tables):
    top = page(_articles(t).select("id", "article_title_s", "issue_pub_date_tdt"), order_columns("date"))
    return top.select("id", "article_title_s", fx.utc_format(F.col("issue_pub_date_tdt")).alias("issue_pub_date"))


@query(
    "clean_text",
    r"""SELECT conv_id, turn, trim(regexp_replace(text, '[ \n\t]+', ' ', 'g')) AS collapsed,
     replace(trim(text, ' ' || chr(9) || chr(10) || chr(13)), chr(10), ' ') AS label,
     CAST(length(text) AS INTEGER) AS n, substr(text, 1, 100) AS preview FROM conversations""",
)
def clean_text(t: Tables):
    return t.conversations.select(
        "conv_id",
        "turn",
        fx.collapse_ws(F.col("text")).alias("collapsed"),
        fx.clean_label(F.col("text")).alias("label"),
        fx.text_length(F.col("text")).alias("n"),
        fx.preview(F.col("text"), 100).alias("preview"),
    )


@query(
    "file_names_and_dates",
    """SELECT o_orderkey, 'ORD' AS npid, CAST(year(o_orderdate) AS VARCHAR) AS year, strftime(o_orderdate, '%m') AS month,
     strftime(o_orderdate, '%d') AS day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS pub_date,
     'ord-' || o_orderkey AS id, '/archive/' || o_orderkey || '.xml' AS address FROM orders""",
)
def file_names_and_dates(t: Tables):
    name = F.concat(F.lit("ORD-"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".xml"))
    parts = t.orders.select("o_orderkey", naming.parse_filename(name).alias("p"))
    key = F.col("o_orderkey").cast("string")
    return parts.select(
        "o_orderkey",
        "p.*",
        fx.utc_format(naming.pub_date(F.col("p.year"), F.col("p.month"), F.col("p.day"))).alias("pub_date"),
        naming.prefixed_id(key, "ord-").alias("id"),
        naming.issue_address(key, "/archive", ".xml").alias("address"),
    )


@query(
    "typed_fields",
    """SELECT o_orderkey AS key_l, o_totalprice AS price_td, CAST(o_orderkey % 7 AS INTEGER) AS lines_i,
     strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ordered, o_orderstatus = 'F' AS done_b,
     CAST(NULL AS INTEGER) AS status_i, array_to_string([CAST(o_custkey AS VARCHAR), '7'], ',') AS ids,
     CAST(o_totalprice AS DOUBLE) AS lat, CAST(o_custkey AS DOUBLE) AS lon, 'EUR' AS code FROM orders""",
)
def typed_fields(t: Tables):
    text = t.orders.select(
        F.col("o_orderkey").cast("string").alias("key_l"),
        F.col("o_totalprice").cast("string").alias("price_td"),
        F.pmod("o_orderkey", F.lit(7)).cast("string").alias("lines_i"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ordered_dt"),
        (F.col("o_orderstatus") == "F").cast("string").alias("done_b"),
        F.col("o_orderpriority").alias("status_i"),
        F.array(F.col("o_custkey").cast("string"), F.lit("7")).alias("ids_ls"),
        F.concat_ws(",", F.col("o_totalprice").cast("string"), F.col("o_custkey").cast("string")).alias("at_p"),
        F.concat_ws(",", F.col("o_totalprice").cast("string"), F.lit("EUR")).alias("cost_c"),
        F.col("o_orderpriority").alias("ignored_note"),
    )
    typed = cast_by_suffix(text)
    return typed.select(
        "key_l",
        "price_td",
        "lines_i",
        fx.utc_format(F.col("ordered_dt")).alias("ordered"),
        "done_b",
        "status_i",
        F.array_join(F.col("ids_ls").cast("array<string>"), ",").alias("ids"),
        F.col("at_p.lat").alias("lat"),
        F.col("at_p.lon").alias("lon"),
        F.col("cost_c.code").alias("code"),
    )


@query(
    "hit_display",
    """SELECT page_id, CASE WHEN contains(url, 'page=') THEN 'pdf' WHEN contains(url, '#') THEN 'html'
      ELSE list_last(string_split(url, '.')) END AS file_type,
     CASE WHEN contains(url, '//m.') THEN 'file:///' || page_id || '.html' WHEN contains(url, '#') THEN CAST(page_id AS VARCHAR) ELSE url END AS link,
     CASE WHEN contains(url, '#') THEN '[' || page_id || ']' ELSE url END AS title FROM pages""",
)
def hit_display(t: Tables):
    url = F.col("url")
    mime = F.when(url.contains("page="), "application/pdf;v=1.4").when(url.contains("#"), "text/html; charset=utf-8").otherwise("x/unknown")
    mobile, anchor = url.contains("//m."), url.contains("#")
    shown_url = F.when(~mobile & ~anchor, url)
    resource = F.when(mobile, F.concat(F.col("page_id").cast("string"), F.lit(".html")))
    return t.pages.select(
        "page_id",
        display.file_type(mime, url).alias("file_type"),
        display.display_url(shown_url, resource, F.col("page_id")).alias("link"),
        display.display_title(F.when(~anchor, url), F.col("page_id")).alias("title"),
    )


@query(
    "field_names",
    "SELECT p_partkey, CASE WHEN p_size > 25 THEN 'p_brand,p_name' ELSE 'p_name' END AS fields FROM part",
)
def field_names(t: Tables):
    pairs = F.map_filter(
        F.create_map(
            F.lit("p_name"), F.col("p_name"),
            F.lit("p_brand"), F.when(F.col("p_size") > 25, F.col("p_brand")),
            F.lit("p_type"), F.col("p_type"),
        ),
        lambda k, v: v.isNotNull(),
    )
    return t.part.select("p_partkey", F.array_join(fx.field_list(pairs, "^p_(name|brand)$"), ",").alias("fields"))


@query(
    "export_long",
    f"""SELECT doc_id AS doc, 'doc_id' AS field, CAST(doc_id AS VARCHAR) AS value FROM documents
    UNION ALL SELECT doc_id, 'lang', lang FROM documents
    UNION ALL SELECT doc_id, 'long', 'yes' FROM documents WHERE n_chars > 1000
    UNION ALL SELECT doc_id, 'words', w FROM (SELECT doc_id, unnest({tokens_sql('text')}) AS w FROM documents)""",
)
def export_long(t: Tables):
    from broadsheet.operators.analysis import tokenize

    docs = t.documents.select(
        "doc_id",
        "lang",
        F.when(F.col("n_chars") > 1000, "yes").alias("long"),
        tokenize(F.col("text")).alias("words"),
        F.lit(1.5).alias("score"),
    )
    return records.export_long(docs, "doc_id")


_PART_SCHEMA = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)
_PART_SQL = "SELECT p_partkey, p_name, CAST(p_size AS INTEGER) AS p_size, p_retailprice FROM part"
_PART_COLUMNS = _PART_SCHEMA.fieldNames()


@query("records_from_csv", _PART_SQL)
def records_from_csv(t: Tables):
    return records.parse_csv_docs(t.part.select(F.to_csv(F.struct(*_PART_COLUMNS)).alias("value")), _PART_SCHEMA)


@query("records_from_json", _PART_SQL)
def records_from_json(t: Tables):
    return records.parse_json_docs(t.part.select(F.to_json(F.struct(*_PART_COLUMNS)).alias("value")), _PART_SCHEMA)


@query(
    "records_from_xml",
    "SELECT p_partkey, p_name, array_to_string(string_split(p_name, ' '), '|') AS words_ss FROM part",
)
def records_from_xml(t: Tables):
    def xml_field(name: str, value):
        return F.concat(F.lit(f'<field name="{name}">'), value.cast("string"), F.lit("</field>"))

    words = F.array_join(F.transform(F.split("p_name", " "), lambda w: xml_field("words_ss", w)), "")
    doc = F.concat(F.lit("<doc>"), xml_field("p_partkey", F.col("p_partkey")), xml_field("p_name", F.col("p_name")), words, F.lit("</doc>"))
    schema = T.StructType([*_PART_SCHEMA.fields[:2], T.StructField("words_ss", T.ArrayType(T.StringType()))])
    return records.parse_xml_docs(t.part.select(doc.alias("value")), schema).withColumn(
        "words_ss", F.array_join("words_ss", "|")
    )


@query(
    "lookup_entries",
    """SELECT 'N' || n_nationkey AS key, CASE WHEN n_regionkey = 3 THEN NULL ELSE n_name END AS label FROM nation""",
)
def lookup_entries(t: Tables):
    label = F.when(F.col("n_regionkey") == 3, "null").otherwise(F.col("n_name"))
    entry = F.concat(F.lit(" N"), F.col("n_nationkey").cast("string"), F.lit(" =  "), label, F.lit(" "))
    lines = t.nation.select(F.explode(F.array(entry, F.concat(F.lit("# "), F.col("n_name")), F.lit(""))).alias("value"))
    return lookup.parse_lookup(lines)


@query(
    "catalogue_records_assembled",
    """SELECT CAST(l_orderkey AS VARCHAR) AS record_id, CAST(count(*) + 1 AS INTEGER) AS n_fields,
     string_agg(l_partkey || ',' || l_suppkey, ' ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS content
    FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (l_quantity >= 50) = 0""",
)
def catalogue_records_assembled(t: Tables):
    """Orders as records: a 001 field and a field per line; some lines have a bad tag."""
    key = F.col("l_orderkey").cast("string")
    number = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    tag = F.when(F.col("l_quantity") >= 50, "50").otherwise("500")
    none = F.lit(None).cast("string")
    line = t.lineitem.select(
        key.alias("record_id"),
        F.lit("leader").alias("leader"),
        number.alias("field_no"),
        tag.alias("tag"),
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("sub_no"), F.lit("a").alias("code"), F.col("l_partkey").cast("string").alias("value")),
                F.struct(F.lit(2).alias("sub_no"), F.lit("b").alias("code"), F.col("l_suppkey").cast("string").alias("value")),
            )
        ).alias("s"),
    ).select("record_id", "leader", "field_no", "tag", F.lit(" ").alias("ind1"), F.lit(" ").alias("ind2"), none.alias("data"), "s.*")
    zero = F.struct(
        F.lit(0).alias("l_linenumber"), F.lit(0).cast("bigint").alias("l_partkey"), F.lit(0).cast("bigint").alias("l_suppkey"), F.lit(0.0).alias("l_quantity")
    )
    control = t.lineitem.select(key.alias("record_id")).distinct().select(
        "record_id", F.lit("leader").alias("leader"), zero.alias("field_no"), F.lit("001").alias("tag"), none.alias("ind1"), none.alias("ind2"),
        F.col("record_id").alias("data"), F.lit(0).alias("sub_no"), none.alias("code"), none.alias("value"),
    )
    nested = marc.assemble_marc(line.unionByName(control))
    texts = F.transform(
        F.filter("fields", lambda f: f["tag"] == "500"),
        lambda f: F.array_join(F.transform(f["subfields"], lambda s: s["value"]), ","),
    )
    return nested.select("record_id", F.size("fields").alias("n_fields"), F.array_join(texts, " ").alias("content"))


# Letters of the texts in the older escape-coded set: a mark before its letter, or a letter of its own.
_ENCODED = {"ß": "\xc7", "ä": "\xe8a", "ç": "\xf0c", "è": "\xe1e", "é": "\xe2e", "ê": "\xe3e", "í": "\xe2i", "ñ": "\xe4n", "ó": "\xe2o", "ö": "\xe8o", "ü": "\xe8u"}
_ENCODED |= {k.upper(): v[:-1] + v[-1].upper() for k, v in _ENCODED.items() if k != "ß"}


@query(
    "catalogue_charsets",
    """SELECT CAST(doc_id AS VARCHAR) AS record_id, 'OK' AS status,
     substr(string_split(text, chr(10))[1], 1, 200) || CASE WHEN doc_id % 3 = 0 THEN ' x' || chr(178) || '!' ELSE '' END AS title
     FROM documents WHERE doc_id % 11 <> 0 AND text IS NOT NULL
    UNION ALL SELECT CAST(doc_id AS VARCHAR), 'BAD_CHARSET', NULL FROM documents WHERE doc_id % 11 = 0 AND text IS NOT NULL""",
)
def catalogue_charsets(t: Tables):
    """Titles of records in the older set, some with a superscript, some with a byte that means nothing."""
    pairs = [F.lit(x) for kv in _ENCODED.items() for x in kv]
    title = F.substring(F.substring_index("text", "\n", 1), 1, 200)
    coded = F.array_join(F.transform(F.split(title, ""), lambda c: F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)), "")
    more = F.when(F.col("doc_id") % 3 == 0, F.lit(" x\x1bp2\x1bs!")).otherwise("")
    rows = t.documents.where("text is not null").select(
        F.col("doc_id").cast("string").alias("record_id"),
        F.lit("00000nam  2200000 a 4500").alias("leader"),
        F.lit(None).cast("string").alias("data"),
        F.concat(coded, more, F.when(F.col("doc_id") % 11 == 0, F.lit("\xff")).otherwise("")).alias("value"),
    )
    good, bad = marc.split_by_charset(rows)
    return good.select("record_id", F.lit("OK").alias("status"), F.col("value").alias("title")).unionByName(
        bad.select("record_id", F.col("reason").alias("status"), F.lit(None).cast("string").alias("title"))
    )
