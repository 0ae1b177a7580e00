"""Who was active on which day: the grain that every user-level metric needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygauge.functions.columns import day, exprs


def user_active_days(actions: DataFrame) -> DataFrame:
    """Distinct (user_id, dt)."""
    return actions.select("user_id", day(actions).alias("dt")).distinct()


def user_start_date(feed: DataFrame) -> DataFrame:
    """First active day per user."""
    return feed.groupBy("user_id").agg(F.min(day(feed)).alias("start_date"))


def user_day_activity(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """One row per user and day with counts from both logs.

    The logs are stacked and grouped rather than joined: counts are combined
    before the one shuffle, so a user who owns much of a log still sends at most
    one row per task and day, and nothing has to be sorted. Every count adds up
    over days, so a stored result can grow day by day (``daygauge.plans.rollup``).
    """
    feed_counts = feed.withColumn("dt", day(feed)).selectExpr(
        "user_id",
        "dt",
        "bigint(action <=> 'view') AS views",
        "bigint(action <=> 'like') AS likes",
        "1L AS feed_actions",
        "0L AS messages",
    )
    message_counts = messages.withColumn("dt", day(messages)).selectExpr(
        "user_id", "dt", "0L AS views", "0L AS likes", "0L AS feed_actions", "1L AS messages"
    )
    counts = ("views", "likes", "feed_actions", "messages")
    return (
        feed_counts.union(message_counts)
        .groupBy("user_id", "dt")
        .agg(*exprs(*(f"sum({c}) AS {c}" for c in counts)))
    )
