"""User days landed in buckets by user: overlap and cohorts of all history without an exchange.

The table has one row per user and day with the counts of both logs, partitioned by day and, within
a day, in buckets by user. Every day has the same buckets, so all days of a user are read by one task
and group there. The logs themselves are not bucketed: a user who owns a third of the actions would
fill one bucket, while here each user has one row a day.

Buckets need a name in the catalog. ``known_user`` is the user, or 0 without one, as overlap reads it;
``user_id`` stays NULL there, as no cohort has such a row.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygauge.functions.columns import day, exprs
from daygauge.operators.activity import user_day_activity
from daygauge.operators.overlap import with_use_type
from daygauge.operators.retention import cohort_sizes

# Buckets of a day. All days of a bucket are read by one task, whose size this sets for good.
BUCKETS = 64
COLUMNS = ("known_user", "user_id", "views", "likes", "feed_actions", "messages")


def _rows(feed: DataFrame, messages: DataFrame, buckets: int) -> DataFrame:
    rows = user_day_activity(feed, messages).withColumn("known_user", F.coalesce("user_id", F.lit(0).cast("bigint")))
    # A task of the write has one bucket, so a day has at most one file a bucket.
    return rows.repartition(buckets, "known_user")


def land_user_days(
    feed: DataFrame, messages: DataFrame, table: str, path: str, buckets: int = BUCKETS
) -> None:
    """Land all days of the logs as a new ``table`` at ``path``. Rows without a day are left out."""
    rows = _rows(feed, messages, buckets).where("dt IS NOT NULL").select(*COLUMNS, "dt")
    rows.write.partitionBy("dt").bucketBy(buckets, "known_user").option("path", path).saveAsTable(table)


def land_days(feed: DataFrame, messages: DataFrame, table: str, days: Iterable[date]) -> None:
    """Land days again, new, changed or emptied ones, each in place of what the table has of it.

    Only these days of the logs are read. A run that breaks is repeated as it was.
    """
    spark = feed.sparkSession
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first()
    for each in sorted(set(days)):
        own = [log.where(day(log) == F.lit(each)) for log in (feed, messages)]
        rows = _rows(*own, int(described.data_type)).select(*COLUMNS)
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (dt = DATE'{each}') SELECT * FROM {{rows}}", rows=rows)


def read_user_days(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def landed_overlap(user_days: DataFrame) -> DataFrame:
    """``user_overlap`` from the landed days. No user and user 0 are one row."""
    counts = [f"sum({c}) AS {c}" for c in COLUMNS[2:]]
    activity = user_days.groupBy(F.col("known_user").alias("user_id"), "dt").agg(*exprs(*counts))
    return with_use_type(activity).select("feed_user", "messenger_user", "dt", "use_type")


def landed_cohort_sizes(user_days: DataFrame, **horizon: int) -> DataFrame:
    """``cohort_sizes`` from the landed days; the only exchange is of start dates."""
    feed = user_days.where("user_id IS NOT NULL AND feed_actions > 0")
    return cohort_sizes(feed.select(F.col("known_user").alias("user_id"), "dt"), **horizon)
