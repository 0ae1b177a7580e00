"""The two action logs as views of a generic ``events`` table.

``event_id`` modulo ``targets`` stands in for the post or the receiver; kinds of
event other than view and click stay in the feed as ``other``, so that "any
action" and "view or like" differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygauge.sources.logs import FEED_CONTRACT, MESSAGE_CONTRACT, conform

FEED_TYPES = ("view", "click", "error")
MESSAGE_TYPES = ("purchase", "signup")
TARGETS = 400
# Given, so that reading starts no schema job. Columns not used here are left out.
SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(f"{sf_dir}/events.parquet")


def feed_from_events(events: DataFrame, targets: int = TARGETS) -> DataFrame:
    kind = F.col("event_type")
    feed = events.where(kind.isin(*FEED_TYPES)).select(
        "user_id",
        (F.col("event_id") % targets).alias("post_id"),
        F.when(kind == "view", "view").when(kind == "click", "like").otherwise("other").alias("action"),
        F.col("ts").alias("time"),
    )
    return conform(feed, FEED_CONTRACT)


def messages_from_events(events: DataFrame, targets: int = TARGETS) -> DataFrame:
    messages = events.where(F.col("event_type").isin(*MESSAGE_TYPES)).select(
        "user_id",
        (F.col("event_id") % targets).alias("receiver_id"),
        F.col("ts").alias("time"),
    )
    return conform(messages, MESSAGE_CONTRACT)
