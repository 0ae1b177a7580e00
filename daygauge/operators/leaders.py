"""Leaderboards. Ties are broken by ascending id, NULL last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygauge.functions.columns import LIKES, VIEWS, exprs, ratio

TOP = 100


def leader_order(metric: str, id_col: str) -> list[Column]:
    return [F.desc(metric), F.asc_nulls_last(id_col)]


def top_by_count(actions: DataFrame, id_col: str, metric: str, k: int = TOP) -> DataFrame:
    """Rows per ``id_col``, the ``k`` largest. Rows without an id count for nobody: NULL has 0."""
    counts = actions.groupBy(id_col).agg(F.count(id_col).alias(metric))
    return counts.orderBy(*leader_order(metric, id_col)).limit(k)


def post_counts(feed: DataFrame) -> DataFrame:
    """Views and likes of every post."""
    return feed.groupBy("post_id").agg(*exprs(f"{VIEWS} AS views", f"{LIKES} AS likes"))


def top_posts(feed: DataFrame, k: int = TOP, counts: DataFrame | None = None) -> DataFrame:
    """The ``k`` posts with most views: views, likes, likes per view (unrounded), distinct users.

    Distinct users need every (post, user) pair, which is close to the whole log,
    so they are counted for the winners only: views and likes pick the ``k`` posts
    first, and a second scan of two columns keeps the rows of those posts.
    ``counts`` may give ``post_counts`` from a stored table instead of the first scan.

    The join has no hint. Spark knows the winners' size from ``k`` and broadcasts few of
    them; many are joined by a shuffle, in which adaptive execution splits a hot post.
    Rows without a post are a post of their own.
    """
    order = leader_order("views", "post_id")
    leaders = (post_counts(feed) if counts is None else counts).orderBy(*order).limit(k)
    leaders = leaders.select(F.col("post_id").alias("leader"), "views", "likes")
    rows = feed.select("post_id", "user_id").join(leaders, F.col("post_id").eqNullSafe(F.col("leader")))
    posts = rows.groupBy("post_id", "views", "likes").agg(F.countDistinct("user_id").alias("users"))
    return (
        posts.selectExpr("post_id", "views", "likes", f"{ratio('likes', 'views')} AS ctr", "users")
        .orderBy(*order)
        .limit(k)
    )
