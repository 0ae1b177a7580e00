"""The same results from the plans a direct reading of the queries would give.

Tests check that the operators return the same rows; ``benchmarks/compare_forms.py``
times both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daygauge.functions.columns import day, ratio
from daygauge.operators.activity import user_active_days, user_start_date


def overlap_by_join(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Full outer join of the two distinct (user, day) sets."""
    f = user_active_days(feed).select(F.col("user_id").alias("f_user"), F.col("dt").alias("f_dt"))
    m = user_active_days(messages).select(F.col("user_id").alias("m_user"), F.col("dt").alias("m_dt"))
    joined = f.join(m, (F.col("f_user") == F.col("m_user")) & (F.col("f_dt") == F.col("m_dt")), "full")
    users = joined.select(
        F.coalesce("f_user", F.lit(0)).alias("feed_user"),
        F.coalesce("m_user", F.lit(0)).alias("messenger_user"),
        F.coalesce("f_dt", "m_dt").alias("dt"),
    )
    use_type = (
        F.when(F.least("feed_user", "messenger_user") > 0, "Both")
        .when(F.col("feed_user") > 0, "Feed only")
        .when(F.col("messenger_user") > 0, "Messenger only")
        .otherwise("OutOfType")
    )
    return users.withColumn("use_type", use_type).distinct()


def _cohorts(active: DataFrame, horizon: int) -> DataFrame:
    duration = (F.datediff("dt", "start_date") + 1).cast("bigint")
    grouped = (
        active.withColumn("duration", duration)
        .where(F.col("duration") <= horizon)
        .groupBy("start_date", "dt", "duration")
        .agg(F.count("user_id").alias("users"))
    )
    return grouped.withColumn("first_day_users", F.max("users").over(W.partitionBy("start_date")))


def cohorts_by_join(feed: DataFrame, horizon: int = 7) -> DataFrame:
    """Active days joined with start dates: two scans."""
    return _cohorts(user_active_days(feed).join(user_start_date(feed), "user_id"), horizon)


def cohorts_by_window(feed: DataFrame, horizon: int = 7) -> DataFrame:
    """Distinct (user, day), then the minimum over each user's days."""
    start = F.min("dt").over(W.partitionBy("user_id"))
    return _cohorts(user_active_days(feed).withColumn("start_date", start), horizon)


def top_posts_one_pass(feed: DataFrame, k: int = 100) -> DataFrame:
    """Distinct users of every post, then the top k."""
    views = F.count_if(F.col("action") == "view")
    likes = F.count_if(F.col("action") == "like")
    posts = feed.groupBy("post_id").agg(
        views.alias("views"), likes.alias("likes"), F.countDistinct("user_id").alias("users")
    )
    return (
        posts.selectExpr("post_id", "views", "likes", f"{ratio('likes', 'views')} AS ctr", "users")
        .orderBy(F.desc("views"), "post_id")
        .limit(k)
    )


def both_users_by_intersect(feed: DataFrame, messages: DataFrame, d) -> DataFrame:
    """Users of both logs on one day, id 0 left out."""
    f = feed.where((day(feed) == F.lit(d)) & (F.col("user_id") > 0)).select("user_id")
    m = messages.where((day(messages) == F.lit(d)) & (F.col("user_id") > 0)).select("user_id")
    return f.intersect(m).agg(F.count("*").alias("both_users"))
