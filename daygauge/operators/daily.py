"""Metrics of one day and of a run of days.

The day operators read one day. The series share one grouped scan per log, so
asking for several columns of ``daily_feed_metrics`` costs the same scan once.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygauge.functions.clock import WEEK, last_days
from daygauge.functions.columns import LIKES, VIEWS, between_days, ctr_pct, day, exprs, on_day


def dau_day(actions: DataFrame, d: date) -> DataFrame:
    """Exact number of distinct users with any action on ``d``; for messages, senders."""
    return on_day(actions, d).agg(F.countDistinct("user_id").alias("users"))


def ctr_day(feed: DataFrame, d: date) -> DataFrame:
    """Likes per hundred views on ``d``; NULL on a day without views."""
    return on_day(feed, d).agg(*exprs(f"{ctr_pct(LIKES, VIEWS)} AS ctr_pct"))


def action_count_day(feed: DataFrame, d: date, kind: str) -> DataFrame:
    return on_day(feed, d).where(F.col("action") == kind).agg(F.count("*").alias("actions"))


def message_count_day(messages: DataFrame, d: date) -> DataFrame:
    return on_day(messages, d).agg(F.count("*").alias("messages"))


def daily_feed_metrics(feed: DataFrame, first: date, last: date) -> DataFrame:
    """One row per day that has feed actions: views, likes, ctr_pct, actions, users."""
    return (
        between_days(feed, first, last)
        .groupBy(day(feed).alias("dt"))
        .agg(
            *exprs(
                f"{VIEWS} AS views",
                f"{LIKES} AS likes",
                f"{ctr_pct(LIKES, VIEWS)} AS ctr_pct",
                "count(*) AS actions",
                "count(DISTINCT user_id) AS users",
            )
        )
    )


def daily_message_metrics(messages: DataFrame, first: date, last: date) -> DataFrame:
    """One row per day that has messages: messages, users (distinct senders)."""
    return (
        between_days(messages, first, last)
        .groupBy(day(messages).alias("dt"))
        .agg(*exprs("count(*) AS messages", "count(DISTINCT user_id) AS users"))
    )


def dense_days(metrics: DataFrame, first: date, last: date) -> DataFrame:
    """Per-day metrics with a row for every day: a day without rows has 0 for counts and NULL for ratios.

    The calendar is the left side of a join with the metrics, which have a row for each day at most.
    """
    days = metrics.sparkSession.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("dt"))
    zeros = {f.name: 0 for f in metrics.schema.fields if isinstance(f.dataType, T.IntegralType)}
    joined = days.join(metrics.where(F.col("dt").between(F.lit(first), F.lit(last))), "dt", "left")
    return joined.fillna(zeros) if zeros else joined


def feed_series(feed: DataFrame, as_of: date, metric: str, days: int = WEEK, dense: bool = False) -> DataFrame:
    """(dt, metric) for the last full days, one column of ``daily_feed_metrics``.

    Days without actions have no row, or with ``dense`` the row of ``dense_days``.
    """
    window = last_days(as_of, days)
    series = daily_feed_metrics(feed, *window).select("dt", metric)
    return (dense_days(series, *window) if dense else series).orderBy("dt")


def message_series(
    messages: DataFrame, as_of: date, metric: str, days: int = WEEK, dense: bool = False
) -> DataFrame:
    """(dt, metric) for the last full days, one column of ``daily_message_metrics``; ``dense`` as there."""
    window = last_days(as_of, days)
    series = daily_message_metrics(messages, *window).select("dt", metric)
    return (dense_days(series, *window) if dense else series).orderBy("dt")
