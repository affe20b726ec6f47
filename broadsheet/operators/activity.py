"""Reports on bookmarks, search history and users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def bookmarks_per_user(bookmarks: DataFrame) -> DataFrame:
    return bookmarks.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


def most_bookmarked(bookmarks: DataFrame, limit: int = 10) -> DataFrame:
    """Documents by number of bookmarks; ties by id."""
    counts = bookmarks.groupBy("document_id").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col("document_id").asc()).limit(limit)


def saved_documents(bookmarks: DataFrame, articles: DataFrame, key: str = "id") -> DataFrame:
    """Bookmarks with the article they point at; those to missing articles drop out."""
    return bookmarks.join(articles, bookmarks["document_id"] == articles[key])


def bookmarked_articles(bookmarks: DataFrame, articles: DataFrame, key: str = "id") -> DataFrame:
    """Articles that anybody has bookmarked."""
    wanted = bookmarks.select(F.col("document_id").alias(key)).distinct()  # combined before the shuffle
    return articles.join(wanted, key, "left_semi")


def related(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str = "id") -> DataFrame:
    """Parent documents that some child document refers to."""
    wanted = children.select(F.col(child_key).alias(parent_key)).distinct()  # combined before the shuffle
    return parents.join(wanted, parent_key, "left_semi")


def recent_searches(searches: DataFrame, per_user: int = 10) -> DataFrame:
    """Each user's latest searches. The top-k is cut before the shuffle, so one very busy user
    is no hot spot. ``search_id`` settles equal times."""
    latest = Window.partitionBy("user_id").orderBy(F.col("created_at").desc(), F.col("search_id").desc())
    return searches.withColumn("rank", F.row_number().over(latest)).where(F.col("rank") <= per_user)


def popular_params(searches: DataFrame, param: str, limit: int = 10) -> DataFrame:
    """(value, n): values of one search parameter by how often they were asked."""
    value = F.get_json_object("query_params", f"$.{param}")
    counts = searches.select(value.alias("value")).where(F.col("value").isNotNull()).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col("value").asc()).limit(limit)


def activity_by_account(searches: DataFrame, users: DataFrame) -> DataFrame:
    """(guest, users, searches, sign_ins): guest against registered accounts.

    Searches are counted per user before the join, so no user's history is shuffled whole.
    """
    per_user = searches.groupBy("user_id").agg(F.count(F.lit(1)).alias("searches"))
    return (
        users.join(per_user, "user_id", "left")
        .groupBy("guest")
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.sum(F.coalesce("searches", F.lit(0))).alias("searches"),
            F.sum("sign_in_count").alias("sign_ins"),
        )
    )
