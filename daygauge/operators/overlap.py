"""Users of one product, of the other, or of both on the same day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygauge.functions.columns import on_day
from daygauge.operators.activity import user_day_activity

# The four class names.
USE_TYPE = """
CASE WHEN user_id > 0 THEN
       CASE WHEN feed_actions > 0 AND messages > 0 THEN 'Both'
            WHEN feed_actions > 0 THEN 'Feed only'
            ELSE 'Messenger only' END
     ELSE 'OutOfType' END
"""


def with_use_type(activity: DataFrame) -> DataFrame:
    """Add feed_user, messenger_user and use_type to ``user_day_activity`` rows.

    A user is 0 in the column of a product not used that day. Id 0 itself thus
    reads as "in neither product": a real user 0 is always ``OutOfType``, and so
    are actions without a user, which have 0 too.
    """
    return activity.selectExpr(
        "*",
        "CASE WHEN feed_actions > 0 THEN coalesce(user_id, 0L) ELSE 0L END AS feed_user",
        "CASE WHEN messages > 0 THEN coalesce(user_id, 0L) ELSE 0L END AS messenger_user",
        f"{USE_TYPE} AS use_type",
    )


def user_overlap(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """(feed_user, messenger_user, dt, use_type), one row per user and day with any activity.

    Same rows as the full outer join of the two distinct (user, day) sets, from
    one hash aggregation instead of two plus a sorted join. No user and user 0 are
    one row.
    """
    known = F.coalesce("user_id", F.lit(0).cast("bigint"))
    activity = user_day_activity(feed.withColumn("user_id", known), messages.withColumn("user_id", known))
    return with_use_type(activity).select("feed_user", "messenger_user", "dt", "use_type")


def overlap_by_day(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Users per day and class."""
    return user_overlap(feed, messages).groupBy("dt", "use_type").agg(F.count("*").alias("users"))


def both_users_day(feed: DataFrame, messages: DataFrame, d: date) -> DataFrame:
    """Users active in both products on ``d``; only that day is read."""
    overlap = user_overlap(on_day(feed, d), on_day(messages, d))
    return overlap.agg(F.expr("count_if(use_type = 'Both') AS both_users"))
