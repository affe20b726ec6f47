"""Bookmarks, search history, accounts and joined documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from broadsheet.functions.text import utc_format
from broadsheet.operators import activity as ac
from broadsheet.plans import bindings as bind
from broadsheet.plans.registered.registry import Tables, query

_BOOKMARKS = """b AS (SELECT CAST(user_id AS INTEGER) AS user_id, json_extract_string(props, '$.k') AS document_id, event_type AS title, ts
  FROM events WHERE event_type IN ('click', 'purchase'))"""
_SEARCHES = """s AS (SELECT event_id AS search_id, props, CAST(user_id AS INTEGER) AS user_id, ts FROM events WHERE event_type = 'view')"""


@query("bookmarks_per_user", f"WITH {_BOOKMARKS} SELECT user_id, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY 1")
def bookmarks_per_user(t: Tables):
    return ac.bookmarks_per_user(bind.bookmarks(t.events))


@query(
    "most_bookmarked",
    f"WITH {_BOOKMARKS} SELECT document_id, CAST(count(*) AS BIGINT) AS n FROM b GROUP BY 1 ORDER BY n DESC, document_id LIMIT 10",
)
def most_bookmarked(t: Tables):
    return ac.most_bookmarked(bind.bookmarks(t.events))


def _article_ids(t: Tables):
    return t.documents.select(F.col("doc_id").cast("string").alias("id"), "lang", "source")


@query(
    "saved_documents",
    f"""WITH {_BOOKMARKS} SELECT user_id, document_id, title, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS created, lang, source
    FROM b JOIN documents d ON CAST(d.doc_id AS VARCHAR) = b.document_id""",
)
def saved_documents(t: Tables):
    rows = ac.saved_documents(bind.bookmarks(t.events), _article_ids(t))
    return rows.select("user_id", "document_id", "title", utc_format(F.col("created_at")).alias("created"), "lang", "source")


@query(
    "bookmarked_articles",
    f"""WITH {_BOOKMARKS} SELECT CAST(doc_id AS VARCHAR) AS id, lang, source FROM documents WHERE CAST(doc_id AS VARCHAR) IN (SELECT document_id FROM b)""",
)
def bookmarked_articles(t: Tables):
    return ac.bookmarked_articles(bind.bookmarks(t.events), _article_ids(t))


@query(
    "parents_with_children",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
)
def parents_with_children(t: Tables):
    return ac.related(t.orders, t.customer, "o_custkey", "c_custkey").select("c_custkey", "c_name")


@query(
    "recent_searches",
    f"""WITH {_SEARCHES}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, search_id DESC) AS rank FROM s)
    SELECT user_id, search_id, props AS query_params, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""",
)
def recent_searches(t: Tables):
    return ac.recent_searches(bind.searches(t.events), 5).select("user_id", "search_id", "query_params", "rank")


@query(
    "popular_params",
    f"""WITH {_SEARCHES} SELECT json_extract_string(props, '$.k') AS value, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY 1 ORDER BY n DESC, value LIMIT 15""",
)
def popular_params(t: Tables):
    return ac.popular_params(bind.searches(t.events), "k", 15)


@query(
    "activity_by_account",
    f"""WITH {_SEARCHES}, c AS (SELECT user_id, count(*) AS n FROM s GROUP BY user_id)
    SELECT c_mktsegment = 'HOUSEHOLD' AS guest, CAST(count(*) AS BIGINT) AS users, CAST(sum(coalesce(n, 0)) AS BIGINT) AS searches,
     CAST(sum(c_nationkey % 9) AS BIGINT) AS sign_ins FROM customer LEFT JOIN c ON c.user_id = c_custkey GROUP BY 1""",
)
def activity_by_account(t: Tables):
    return ac.activity_by_account(bind.searches(t.events), bind.users(t.customer))
