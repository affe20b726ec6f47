"""Facet counts by value, predicate, range and pivot."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.functions.text import utc_format
from broadsheet.operators import facets as fc
from broadsheet.operators.analysis import tokenize
from broadsheet.plans import bindings as bind
from broadsheet.plans.registered.registry import Tables, query, tokens_sql


@query(
    "facet_year",
    f"""SELECT issue_year_s AS value, CAST(count(*) AS BIGINT) AS n FROM {bind.ARTICLES_SQL} GROUP BY 1""",
)
def facet_year(t: Tables):
    return fc.facet_field(bind.articles(t.documents), "issue_year_s")


@query(
    "facet_limited",
    """SELECT source AS value, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, value LIMIT 7""",
)
def facet_limited(t: Tables):
    return fc.facet_field(t.documents, "source", mincount=2, limit=7)


@query(
    "facet_multi_valued",
    f"""SELECT w AS value, CAST(count(*) AS BIGINT) AS n FROM (SELECT unnest({tokens_sql('p_name')}) AS w FROM part) GROUP BY 1""",
)
def facet_multi_valued(t: Tables):
    return fc.facet_field(t.part.select(tokenize(F.col("p_name")).alias("words")), "words")


@query(
    "facet_several_fields",
    """WITH c AS (
      SELECT 'lang' AS field, lang AS value, count(*) AS n FROM documents GROUP BY 2
      UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY field ORDER BY n DESC, value) AS k FROM c)
    SELECT field, value, CAST(n AS BIGINT) AS n FROM r WHERE k <= 3""",
)
def facet_several_fields(t: Tables):
    return fc.facet_fields(t.documents, ["lang", "source"], limit=3)


@query(
    "facet_several_fields_all_values",
    """SELECT 'l_returnflag' AS field, l_returnflag AS value, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 2
      UNION ALL SELECT 'l_linestatus', l_linestatus, CAST(count(*) AS BIGINT) FROM lineitem GROUP BY 2
      UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), CAST(count(*) AS BIGINT) FROM lineitem GROUP BY 2""",
)
def facet_several_fields_all_values(t: Tables):
    return fc.facet_fields(t.lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])


@query(
    "facet_queries",
    """SELECT 'long' AS query, CAST(count(*) AS BIGINT) AS n FROM documents WHERE n_chars > 2000
    UNION ALL SELECT 'german', CAST(count(*) AS BIGINT) FROM documents WHERE lang = 'de'
    UNION ALL SELECT 'long french', CAST(count(*) AS BIGINT) FROM documents WHERE lang = 'fr' AND n_chars > 2000""",
)
def facet_queries(t: Tables):
    long = F.col("n_chars") > 2000
    return fc.facet_query(
        t.documents,
        {"long": long, "german": F.col("lang") == "de", "long french": long & (F.col("lang") == "fr"), "none": F.col("lang") == "??"},
    )


@query(
    "facet_price_range",
    """WITH b AS (SELECT CASE WHEN o_totalprice < 100000 THEN 'before' WHEN o_totalprice >= 430000 THEN 'after' ELSE 'range' END AS bucket,
      floor((o_totalprice - 100000) / 30000) AS k FROM orders)
    SELECT 'range' AS bucket, 100000 + k * 30000 AS lower, CAST(count(*) AS BIGINT) AS n FROM b WHERE bucket = 'range' GROUP BY k
    UNION ALL SELECT bucket, NULL, CAST(count(*) AS BIGINT) FROM b WHERE bucket <> 'range' GROUP BY bucket""",
)
def facet_price_range(t: Tables):
    return fc.facet_range(t.orders, "o_totalprice", 100000, 420000, 30000, other=["before", "after"])


@query(
    "facet_discount_range",
    """WITH k AS (SELECT unnest(range(0, 12)) AS k),
    b AS (SELECT CAST(floor(round(l_discount * 100, 0)) AS BIGINT) AS k, l_discount FROM lineitem),
    n AS (SELECT k, count(*) AS n FROM b WHERE k < 12 GROUP BY k)
    SELECT 'range' AS bucket, CAST(CAST(k.k AS DECIMAL(18, 2)) / 100 AS DOUBLE) AS lower, CAST(coalesce(n, 0) AS BIGINT) AS n FROM k LEFT JOIN n USING (k)
    UNION ALL SELECT 'before', NULL, CAST(count(*) FILTER (WHERE k < 0) AS BIGINT) FROM b
    UNION ALL SELECT 'between', NULL, CAST(count(*) FILTER (WHERE k BETWEEN 0 AND 11) AS BIGINT) FROM b
    UNION ALL SELECT 'after', NULL, CAST(count(*) FILTER (WHERE k > 11) AS BIGINT) FROM b""",
)
def facet_discount_range(t: Tables):
    """Hundredths as buckets, empty ones too, and all rows beside them."""
    return fc.facet_range(t.lineitem, "l_discount", 0, 0.12, 0.01, other=["all"], mincount=0)


@query(
    "facet_value_range",
    """SELECT 'range' AS bucket, floor(value / 5) * 5 AS lower, CAST(count(*) AS BIGINT) AS n FROM events WHERE value >= 0 AND value < 100 GROUP BY 2""",
)
def facet_value_range(t: Tables):
    return fc.facet_range(t.events, "value", 0, 100, 5)


@query(
    "facet_order_years",
    """WITH b AS (SELECT CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'before' WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN 'after' ELSE 'range' END AS bucket, o_orderdate FROM orders)
    SELECT 'range' AS bucket, strftime(date_trunc('year', o_orderdate), '%Y-%m-%dT%H:%M:%SZ') AS lower, CAST(count(*) AS BIGINT) AS n FROM b WHERE bucket = 'range' GROUP BY 2
    UNION ALL SELECT bucket, NULL, CAST(count(*) AS BIGINT) FROM b WHERE bucket <> 'range' GROUP BY bucket""",
)
def facet_order_years(t: Tables):
    """Five years up to the year that holds a given "now", by date math."""
    now = F.lit("2000-06-15 12:00:00").cast("timestamp")
    rows = fc.facet_range_dates(
        t.orders, "o_orderdate", fc.rounded(now, "YEAR", -4), now, 1, "YEAR", other=["before", "after"]
    )
    return rows.withColumn("lower", utc_format(F.col("lower")))


@query(
    "facet_order_quarters",
    """WITH b AS (SELECT o_orderdate, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 - CASE WHEN day(o_orderdate) < 16 THEN 1 ELSE 0 END AS m FROM orders
      WHERE o_orderdate >= TIMESTAMP '1995-01-16' AND o_orderdate < TIMESTAMP '2000-01-16')
    SELECT 'range' AS bucket, strftime(TIMESTAMP '1995-01-16' + to_months(CAST(m // 3 * 3 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS lower, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY 2""",
)
def facet_order_quarters(t: Tables):
    start, end = (F.lit(d).cast("timestamp") for d in ("1995-01-16", "1999-12-01"))
    rows = fc.facet_range_dates(t.orders, "o_orderdate", start, end, 3, "MONTH")
    return rows.withColumn("lower", utc_format(F.col("lower")))


@query(
    "facet_event_days",
    """WITH b AS (SELECT CASE WHEN ts < TIMESTAMP '2024-01-05' THEN 'before' WHEN ts >= TIMESTAMP '2024-01-25' THEN 'after' ELSE 'range' END AS bucket,
      datediff('day', TIMESTAMP '2024-01-05', ts) // 2 AS k FROM events)
    SELECT 'range' AS bucket, strftime(TIMESTAMP '2024-01-05' + to_days(CAST(k * 2 AS INTEGER)), '%Y-%m-%dT%H:%M:%SZ') AS lower, CAST(count(*) AS BIGINT) AS n FROM b WHERE bucket = 'range' GROUP BY 2
    UNION ALL SELECT bucket, NULL, CAST(count(*) AS BIGINT) FROM b WHERE bucket <> 'range' GROUP BY bucket""",
)
def facet_event_days(t: Tables):
    start, end = (F.lit(d).cast("timestamp") for d in ("2024-01-05", "2024-01-24"))
    rows = fc.facet_range_dates(t.events, "ts", start, end, 2, "DAY", other=["before", "after"])
    return rows.withColumn("lower", utc_format(F.col("lower")))


@query(
    "facet_pivot",
    """SELECT 1 AS level, lang, NULL AS source, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY lang
    UNION ALL SELECT 2, lang, source, CAST(count(*) AS BIGINT) FROM documents GROUP BY lang, source""",
)
def facet_pivot(t: Tables):
    return fc.facet_pivot(t.documents, "lang", "source")


@query(
    "facet_pivot_orders",
    """SELECT 1 AS level, o_orderpriority, NULL AS o_orderstatus, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY o_orderpriority HAVING count(*) >= 100
    UNION ALL SELECT 2, o_orderpriority, o_orderstatus, CAST(count(*) AS BIGINT) FROM orders GROUP BY o_orderpriority, o_orderstatus HAVING count(*) >= 100""",
)
def facet_pivot_orders(t: Tables):
    return fc.facet_pivot(t.orders, "o_orderpriority", "o_orderstatus", mincount=100)
