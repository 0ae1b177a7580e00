"""

The logs are views of the ``events`` table (``daygauge.sources.events``). Each
oracle states its query in another way than the Spark code wherever there is one
(full outer join, self-joined cohorts, one query per number).
"""

from __future__ import annotations

import importlib
import os
import sys
import uuid
from collections.abc import Callable
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygauge.functions.clock import last_days, yesterday
from daygauge.operators import activity, daily, leaders, overlap, retention
from daygauge.plans import daily_report, landing, report, state
from daygauge.plans import rollup as ru
from daygauge.sources import events, logs, sinks

AS_OF = date(2024, 1, 31)
# The last date whose week-old cohort exists at every scale.
COHORT_AS_OF = date(2024, 1, 8)

SQL_TEXT = """
SELECT to_date(time) AS dt, action, count(*) AS actions, count(DISTINCT user_id) AS users
FROM {feed} GROUP BY to_date(time), action
"""


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.feed_from_events(events.read_events(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.messages_from_events(events.read_events(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """The KPI row of the daily report."""
    return _both(lambda f, m: report.daily_kpis(f, m, COHORT_AS_OF))(spark, "/root/testdata/sf0.001")


Query = Callable[[SparkSession, str], DataFrame]


def _feed(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(feed(spark, sf_dir))


def _messages(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(messages(spark, sf_dir))


def _both(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = events.read_events(spark, sf_dir)
        return operator(events.feed_from_events(table), events.messages_from_events(table))

    return run


def _exported_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the post leaderboard as CSV and read the file back."""
    path = sinks.shared_path(spark)
    order = leaders.leader_order("views", "post_id")
    sinks.export_ranked_csv(leaders.top_posts(feed(spark, sf_dir)), path, order)
    schema = "row_index bigint, post_id bigint, views bigint, likes bigint, ctr double, users bigint"
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)


# An old day whose likes had come in as views, a date before the end of the logs, and one after it.
CORRECTED, EARLIER, LATER = date(2024, 1, 5), date(2024, 1, 25), date(2024, 12, 31)
# The last days of the logs and some after them.
DENSE_AS_OF, DENSE_DAYS = date(2024, 2, 5), 10


def _running(answer: Callable[[SparkSession, str], DataFrame]) -> Query:
    """The answer of a rollup that was made early, over a feed with a day that was corrected since, and then extended."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        f, m, path = feed(spark, sf_dir), messages(spark, sf_dir), sinks.shared_path(spark)
        f = f.withColumn("dt", F.to_date("time"))
        wrong = F.when(F.col("dt") == F.lit(CORRECTED), "view").otherwise(F.col("action"))
        landed = f"{path}/feed"
        ru.write_days(f.withColumn("action", wrong), landed)
        ru.extend_rollup(logs.feed_actions(spark, landed), m, path, EARLIER, by_content=True, running=True)
        ru.write_days(f.where(F.col("dt") == F.lit(CORRECTED)), landed)
        ru.extend_rollup(logs.feed_actions(spark, landed), m, path, LATER, by_content=True, running=True)
        return answer(spark, path)

    return run


def _landed(answer: Callable[[DataFrame], DataFrame]) -> Query:
    """The answer of user days landed in buckets, of which two were incomplete at first and landed again."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        f, m, path = feed(spark, sf_dir), messages(spark, sf_dir), sinks.shared_path(spark)
        f, m = (log.withColumn("dt", F.to_date("time")) for log in (f, m))
        early = f.where(F.col("dt") != F.lit(CORRECTED)), m.where(F.col("dt") != F.lit(EARLIER))
        table = f"user_days_{uuid.uuid4().hex}"
        landing.land_user_days(*early, table, f"{path}/days")
        landing.land_days(f, m, table, (CORRECTED, EARLIER))
        found = answer(landing.read_user_days(spark, table))
        found.write.parquet(f"{path}/answer")
        spark.sql(f"DROP TABLE {table}")
        return spark.read.schema(found.schema).parquet(f"{path}/answer")

    return run


def _scan_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the scan for the post counts has seen of the feed."""
    counted, seen = logs.scan_metrics(feed(spark, sf_dir), f"feed-{uuid.uuid4().hex}", *last_days(AS_OF))
    leaders.post_counts(counted).write.format("noop").mode("overwrite").save()
    return spark.range(1).select(*(F.lit(n).cast("bigint").alias(c) for c, n in seen.get.items()))


def _published_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the reports of two dates, and read the text of the last one as a reader does."""
    f, m, out = feed(spark, sf_dir), messages(spark, sf_dir), sinks.shared_path(spark)
    for as_of in (yesterday(COHORT_AS_OF), COHORT_AS_OF):
        daily_report.publish_daily_report(f, m, as_of, out, f"{out}/rollup")
    text = spark.read.text(f"{sinks.published(spark, out)}/report.txt", wholetext=True)
    lines = text.select(F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("k", "line"))
    return lines.selectExpr("bigint(k + 1) AS line_no", "line")


def _text_module(name: str):
    """A module of the text operators, or None where they are not installed."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if missing.name is None or not f"{name}.".startswith(f"{missing.name}."):
            raise
        return None


def _text_modules() -> tuple:
    """The queries of the text operators and the pipeline over them, which needs them; None where not installed."""
    text = _text_module("daygauge.llm.queries")
    return text, _text_module("corpus_pipeline") if text else None


def queries() -> dict[str, Query]:
    text, pipeline = _text_modules()
    return {
        **_log_queries(),
        **(text.queries() if text else {}),
        **({"pipeline": pipeline.run} if pipeline else {}),
    }


def _log_queries() -> dict[str, Query]:
    d = yesterday(AS_OF)
    window = last_days(AS_OF)
    return {
        "scan_feed_actions": feed,
        "scan_message_actions": messages,
        "sql_frame": lambda spark, sf_dir: logs.sql_frame(spark, SQL_TEXT, feed=feed(spark, sf_dir)),
        "preview_day": _feed(lambda f: logs.preview_day(f, d)),
        "feed_dau_day": _feed(lambda f: daily.dau_day(f, d)),
        "messenger_dau_day": _messages(lambda m: daily.dau_day(m, d)),
        "feed_ctr_day": _feed(lambda f: daily.ctr_day(f, d)),
        "feed_views_day": _feed(lambda f: daily.action_count_day(f, d, "view")),
        "feed_likes_day": _feed(lambda f: daily.action_count_day(f, d, "like")),
        "messages_day": _messages(lambda m: daily.message_count_day(m, d)),
        "both_users_day": _both(lambda f, m: overlap.both_users_day(f, m, d)),
        "user_overlap": _both(overlap.user_overlap),
        "overlap_by_day": _both(overlap.overlap_by_day),
        "user_start_date": _feed(activity.user_start_date),
        "user_active_days": _feed(activity.user_active_days),
        "user_day_activity": _both(activity.user_day_activity),
        "cohort_activity": _feed(retention.cohort_activity),
        "retention_long": _feed(retention.retention_long),
        "retention_pivot": _feed(retention.retention_pivot),
        "retention_week": _feed(lambda f: retention.retention_week(f, COHORT_AS_OF)),
        "views_series": _feed(lambda f: daily.feed_series(f, AS_OF, "views")),
        "likes_series": _feed(lambda f: daily.feed_series(f, AS_OF, "likes")),
        "ctr_series": _feed(lambda f: daily.feed_series(f, AS_OF, "ctr_pct")),
        "feed_dau_series": _feed(lambda f: daily.feed_series(f, AS_OF, "users")),
        "messenger_dau_series": _messages(lambda m: daily.message_series(m, AS_OF, "users")),
        "messages_series": _messages(lambda m: daily.message_series(m, AS_OF, "messages")),
        "daily_feed_metrics": _feed(lambda f: daily.daily_feed_metrics(f, *window)),
        "daily_message_metrics": _messages(lambda m: daily.daily_message_metrics(m, *window)),
        "top_posts": _feed(leaders.top_posts),
        "top_mailers": _messages(lambda m: leaders.top_by_count(m, "user_id", "sent")),
        "top_receivers": _messages(lambda m: leaders.top_by_count(m, "receiver_id", "received")),
        "top_feed_users": _feed(lambda f: leaders.top_by_count(f, "user_id", "actions")),
        "top_posts_rolled": _running(
            lambda spark, path: state.running_top_posts(
                state.read_totals(spark, path, "post_totals"), ru.read_days(spark, path, ru.POST_USERS)
            )
        ),
        "top_feed_users_running": _running(
            lambda spark, path: state.running_top(
                state.read_totals(spark, path, "user_totals"), "user_id", "feed_actions", "actions"
            )
        ),
        "cohort_activity_running": _running(
            lambda spark, path: retention.activity_of_sizes(state.cohort_sizes(state.read_words(spark, path)))
        ),
        "user_overlap_landed": _landed(landing.landed_overlap),
        "cohort_activity_landed": _landed(
            lambda days: retention.activity_of_sizes(landing.landed_cohort_sizes(days))
        ),
        "views_dense": _feed(lambda f: daily.feed_series(f, DENSE_AS_OF, "views", DENSE_DAYS, dense=True)),
        "ctr_dense": _feed(lambda f: daily.feed_series(f, DENSE_AS_OF, "ctr_pct", DENSE_DAYS, dense=True)),
        "scan_metrics": _scan_metrics,
        "published_report": _published_lines,
        "export_ranked_csv": _exported_posts,
        "daily_kpis": _both(lambda f, m: report.daily_kpis(f, m, COHORT_AS_OF)),
        "daily_kpis_without_cohort": _both(lambda f, m: report.daily_kpis(f, m, AS_OF)),
        "report_text": _both(lambda f, m: report.report_lines(report.daily_kpis(f, m, COHORT_AS_OF))),
        "chart_range_label": _both(lambda f, m: report.chart_series(f, m, AS_OF)),
    }


# --- oracle -----------------------------------------------------------------

_LOGS = """
feed AS (
  SELECT user_id, event_id % 400 AS post_id,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'like' ELSE 'other' END AS action,
         ts AS time, CAST(ts AS DATE) AS dt
  FROM events WHERE event_type IN ('view', 'click', 'error')),
messages AS (
  SELECT user_id, event_id % 400 AS receiver_id, ts AS time, CAST(ts AS DATE) AS dt
  FROM events WHERE event_type IN ('purchase', 'signup'))"""

_OVERLAP = """
pairs AS (
  SELECT coalesce(f.user_id, 0) AS feed_user, coalesce(m.user_id, 0) AS messenger_user,
         greatest(coalesce(f.dt, DATE '1970-01-01'), coalesce(m.dt, DATE '1970-01-01')) AS dt
  FROM (SELECT DISTINCT user_id, dt FROM feed) f
  FULL JOIN (SELECT DISTINCT user_id, dt FROM messages) m ON f.user_id = m.user_id AND f.dt = m.dt),
overlap AS (
  SELECT DISTINCT feed_user, messenger_user, dt,
         CASE WHEN least(feed_user, messenger_user) > 0 THEN 'Both'
              WHEN feed_user > 0 THEN 'Feed only'
              WHEN messenger_user > 0 THEN 'Messenger only'
              ELSE 'OutOfType' END AS use_type
  FROM pairs)"""

_COHORTS = """
starts AS (SELECT user_id, min(dt) AS start_date FROM feed GROUP BY user_id),
active AS (SELECT DISTINCT user_id, dt FROM feed),
grouped AS (
  SELECT start_date, dt, dt - start_date + 1 AS duration, count(DISTINCT user_id) AS users
  FROM active JOIN starts USING (user_id)
  WHERE dt - start_date + 1 <= 7 GROUP BY ALL),
cohorts AS (
  SELECT *, max(users) OVER (PARTITION BY start_date) AS first_day_users FROM grouped),
retention AS (
  SELECT dt, start_date, duration, users / first_day_users AS retention FROM cohorts)"""


def _week_sql(as_of: date) -> str:
    # Fixed value: the label of a day.
    return f"""
week AS (
  SELECT n AS duration, 'Day ' || n AS label, round_even(r.retention, 2) AS retention
  FROM range(1, 8) days(n)
  JOIN (SELECT DISTINCT start_date FROM retention) s ON s.start_date = DATE '{as_of}' - 7
  LEFT JOIN retention r ON r.start_date = s.start_date AND r.duration = n)"""


def _kpis_sql(as_of: date) -> str:
    feed_day = f"FROM feed WHERE dt = DATE '{as_of}' - 1"
    message_day = f"FROM messages WHERE dt = DATE '{as_of}' - 1"
    days = ",\n".join(f"(SELECT max(retention) FROM week WHERE duration = {n}) AS day_{n}" for n in range(1, 8))
    return f"""
kpis AS (
  SELECT DATE '{as_of}' - 1 AS report_date,
    (SELECT count(DISTINCT user_id) {feed_day}) AS feed_dau,
    (SELECT count(DISTINCT user_id) {message_day}) AS messenger_dau,
    (SELECT count(*) {feed_day} AND action = 'view') AS views,
    (SELECT count(*) {feed_day} AND action = 'like') AS likes,
    (SELECT {_CTR} {feed_day}) AS ctr_pct,
    (SELECT count(*) {message_day}) AS messages,
    (SELECT count(*) FROM overlap WHERE use_type = 'Both' AND dt = DATE '{as_of}' - 1) AS both_users,
    {days})"""


_VIEWS = "count(*) FILTER (WHERE action = 'view')"
_LIKES = "count(*) FILTER (WHERE action = 'like')"
_CTR = f"round_even({_LIKES} * 100 / nullif({_VIEWS}, 0), 2)"


def _with(select: str, *ctes: str) -> str:
    return "WITH " + ",".join((_LOGS, *ctes)) + "\n" + select


def _report_lines_sql(week_text: str, indent: str) -> str:
    # The wording and layout of the report.
    return f"""
    SELECT * FROM (
      SELECT CAST(1 AS BIGINT) AS line_no,
     'Report №-2 for ' || strftime(report_date, '%d-%m-%Y') || ':' AS line FROM kpis
      UNION ALL SELECT 2, 'Feed DAU = ' || feed_dau FROM kpis
      UNION ALL SELECT 3, '{indent}Messenger DAU = ' || messenger_dau FROM kpis
      UNION ALL SELECT 4, 'Views = ' || views FROM kpis
      UNION ALL SELECT 5, '{indent}Likes = ' || likes FROM kpis
      UNION ALL SELECT 6, 'CTR = ' || ctr_pct || '%' FROM kpis
      UNION ALL SELECT 7, 'Messages = ' || messages FROM kpis
      UNION ALL SELECT 8, '{indent}Engaged in both feed and messenger = ' || both_users FROM kpis
      UNION ALL SELECT 9, '{indent}Last week retention = {{' || {week_text} || '}}' FROM kpis)"""


def oracle_sql() -> dict[str, str]:
    text, pipeline = _text_modules()
    return {
        **_log_sql(),
        **(text.oracle_sql() if text else {}),
        **({"pipeline": pipeline.ORACLE_SQL} if pipeline and pipeline.ORACLE_SQL else {}),
    }


def _log_sql() -> dict[str, str]:
    day = f"dt = DATE '{AS_OF}' - 1"
    week = f"dt BETWEEN DATE '{AS_OF}' - 7 AND DATE '{AS_OF}' - 1"
    label = f"(strftime(DATE '{AS_OF}' - 7, '%d-%m-%Y') || ' - ' || strftime(DATE '{AS_OF}' - 1, '%d-%m-%Y'))"

    def series(table: str, column: str) -> str:
        return _with(f"SELECT dt, {column} FROM {table} WHERE {week} GROUP BY dt ORDER BY dt")

    def top(table: str, id_col: str, metric: str) -> str:
        return _with(
            f"SELECT {id_col}, count({id_col}) AS {metric} FROM {table} "
            f"GROUP BY {id_col} ORDER BY {metric} DESC, {id_col} LIMIT 100"
        )

    def panel(title: str, name: str, table: str, value: str) -> str:
        return (
            f"SELECT '{title} for  \"' || {label} || '\"' AS title, '{name}' AS panel, dt, "
            f"CAST({value} AS DOUBLE) AS value FROM {table} WHERE {week} GROUP BY dt"
        )

    def dense(value: str, missing: str) -> str:
        return _with(
            f"SELECT CAST(d AS DATE) AS dt, coalesce(value, {missing}) AS {{0}} "
            f"FROM generate_series(DATE '{DENSE_AS_OF}' - {DENSE_DAYS}, DATE '{DENSE_AS_OF}' - 1, INTERVAL 1 DAY) days(d) "
            f"LEFT JOIN (SELECT dt, {value} AS value FROM feed GROUP BY dt) m ON m.dt = CAST(d AS DATE)"
        )

    posts = f"""
      SELECT post_id, {_VIEWS} AS views, {_LIKES} AS likes, {_LIKES} / nullif({_VIEWS}, 0) AS ctr,
             count(DISTINCT user_id) AS users
      FROM feed GROUP BY post_id ORDER BY views DESC, post_id LIMIT 100"""
    pivot = ",\n".join(
        f"max(CASE WHEN duration = {n} THEN retention END) AS \"Day {n}\"" for n in range(1, 8)
    )

    def kpi_ctes(as_of: date) -> tuple[str, ...]:
        return _OVERLAP, _COHORTS, _week_sql(as_of), _kpis_sql(as_of)

    week_text = " || ', ' || ".join(
        f"'''Day {n}'': ' || coalesce(CAST(day_{n} AS VARCHAR), 'nan')" for n in range(1, 8)
    )
    indent = " " * 12

    lines = _report_lines_sql(week_text, indent)

    return {
        "scan_feed_actions": _with("SELECT user_id, post_id, action, time FROM feed"),
        "scan_message_actions": _with("SELECT user_id, receiver_id, time FROM messages"),
        "sql_frame": _with(
            "SELECT dt, action, count(*) AS actions, count(DISTINCT user_id) AS users FROM feed GROUP BY dt, action"
        ),
        "preview_day": _with(
            f"SELECT user_id, post_id, action, time FROM feed WHERE {day} "
            "ORDER BY time, user_id, post_id, action LIMIT 10"
        ),
        "feed_dau_day": _with(f"SELECT count(DISTINCT user_id) AS users FROM feed WHERE {day}"),
        "messenger_dau_day": _with(f"SELECT count(DISTINCT user_id) AS users FROM messages WHERE {day}"),
        "feed_ctr_day": _with(f"SELECT {_CTR} AS ctr_pct FROM feed WHERE {day}"),
        "feed_views_day": _with(f"SELECT count(*) AS actions FROM feed WHERE {day} AND action = 'view'"),
        "feed_likes_day": _with(f"SELECT count(*) AS actions FROM feed WHERE {day} AND action = 'like'"),
        "messages_day": _with(f"SELECT count(*) AS messages FROM messages WHERE {day}"),
        "both_users_day": _with(
            f"SELECT count(*) FILTER (WHERE use_type = 'Both' AND {day}) AS both_users FROM overlap", _OVERLAP
        ),
        "user_overlap": _with("SELECT * FROM overlap", _OVERLAP),
        "overlap_by_day": _with(
            "SELECT dt, use_type, count(*) AS users FROM overlap GROUP BY dt, use_type", _OVERLAP
        ),
        "user_start_date": _with(
            "SELECT DISTINCT user_id, min(dt) OVER (PARTITION BY user_id) AS start_date FROM feed"
        ),
        "user_active_days": _with("SELECT DISTINCT user_id, dt FROM feed"),
        "user_day_activity": _with(
            f"""
            SELECT coalesce(f.user_id, m.user_id) AS user_id, coalesce(f.dt, m.dt) AS dt,
                   coalesce(views, 0) AS views, coalesce(likes, 0) AS likes,
                   coalesce(feed_actions, 0) AS feed_actions, coalesce(sent, 0) AS messages
            FROM (SELECT user_id, dt, {_VIEWS} AS views, {_LIKES} AS likes, count(*) AS feed_actions
                  FROM feed GROUP BY user_id, dt) f
            FULL JOIN (SELECT user_id, dt, count(*) AS sent FROM messages GROUP BY user_id, dt) m
              ON f.user_id = m.user_id AND f.dt = m.dt"""
        ),
        "cohort_activity": _with("SELECT * FROM cohorts", _COHORTS),
        "retention_long": _with("SELECT * FROM retention ORDER BY start_date, duration", _COHORTS),
        "retention_pivot": _with(f"SELECT start_date, {pivot} FROM retention GROUP BY start_date", _COHORTS),
        "retention_week": _with("SELECT * FROM week", _COHORTS, _week_sql(COHORT_AS_OF)),
        "views_series": series("feed", f"{_VIEWS} AS views"),
        "likes_series": series("feed", f"{_LIKES} AS likes"),
        "ctr_series": series("feed", f"{_CTR} AS ctr_pct"),
        "feed_dau_series": series("feed", "count(DISTINCT user_id) AS users"),
        "messenger_dau_series": series("messages", "count(DISTINCT user_id) AS users"),
        "messages_series": series("messages", "count(*) AS messages"),
        "daily_feed_metrics": series(
            "feed",
            f"{_VIEWS} AS views, {_LIKES} AS likes, {_CTR} AS ctr_pct, count(*) AS actions, "
            "count(DISTINCT user_id) AS users",
        ),
        "daily_message_metrics": series("messages", "count(*) AS messages, count(DISTINCT user_id) AS users"),
        "top_posts": _with(posts),
        "top_mailers": top("messages", "user_id", "sent"),
        "top_receivers": top("messages", "receiver_id", "received"),
        "top_feed_users": top("feed", "user_id", "actions"),
        "export_ranked_csv": _with(
            f"SELECT row_number() OVER (ORDER BY views DESC, post_id) - 1 AS row_index, * FROM ({posts})"
        ),
        "daily_kpis": _with("SELECT * FROM kpis", *kpi_ctes(COHORT_AS_OF)),
        "daily_kpis_without_cohort": _with("SELECT * FROM kpis", *kpi_ctes(AS_OF)),
        # In chart_range_label the titles and panels.
        "report_text": _with(lines, *kpi_ctes(COHORT_AS_OF)),
        "published_report": _with(lines, *kpi_ctes(COHORT_AS_OF)),
        "top_posts_rolled": _with(posts),
        "top_feed_users_running": top("feed", "user_id", "actions"),
        "cohort_activity_running": _with("SELECT * FROM cohorts", _COHORTS),
        "user_overlap_landed": _with("SELECT * FROM overlap", _OVERLAP),
        "cohort_activity_landed": _with("SELECT * FROM cohorts", _COHORTS),
        "views_dense": dense(_VIEWS, "0").format("views"),
        "ctr_dense": dense(_CTR, "NULL").format("ctr_pct"),
        "scan_metrics": _with(
            "SELECT count(*) AS rows, count(*) FILTER (user_id IS NULL) AS null_users, "
            "count(*) FILTER (post_id IS NULL) AS null_targets, count(*) FILTER (time IS NULL) AS null_times, "
            "count(*) FILTER (action NOT IN ('view', 'like')) AS other_actions, "
            f"count(*) FILTER (NOT ({week})) AS outside FROM feed"
        ),
        "chart_range_label": _with(
            "SELECT * FROM ("
            + " UNION ALL ".join(
                (
                    panel("Views/Likes", "Views", "feed", _VIEWS),
                    panel("Views/Likes", "Likes", "feed", _LIKES),
                    panel("CTR", "CTR, %", "feed", _CTR),
                    panel("DAU", "Feed", "feed", "count(DISTINCT user_id)"),
                    panel("DAU", "Messenger", "messages", "count(DISTINCT user_id)"),
                    panel("Messages", "Messages", "messages", "count(*)"),
                )
            )
            + ")"
        ),
    }
