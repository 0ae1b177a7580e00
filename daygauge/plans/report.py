"""The daily report as DataFrames: one KPI row, its text, and the chart tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygauge.functions.clock import WEEK, last_days, range_label, yesterday
from daygauge.functions.columns import ctr_pct, exprs, number_text, on_day
from daygauge.operators.activity import user_day_activity
from daygauge.operators.daily import daily_feed_metrics, daily_message_metrics, dense_days
from daygauge.operators.overlap import with_use_type
from daygauge.operators.retention import day_label, retention_week_row

# The wording and layout of the printed report.
TEXT = """\
Report №-2 for %s:
Feed DAU = %d
            Messenger DAU = %d
Views = %d
            Likes = %d
CTR = %s%%
Messages = %d
            Engaged in both feed and messenger = %d
            Last week retention = {%s}"""
RETENTION = "'%s': %%s"

# Chart title, panel, and the metric drawn in it.
FEED_CHARTS = (
    ("Views/Likes", "Views", "views"),
    ("Views/Likes", "Likes", "likes"),
    ("CTR", "CTR, %", "ctr_pct"),
    ("DAU", "Feed", "users"),
)
MESSAGE_CHARTS = (
    ("DAU", "Messenger", "users"),
    ("Messages", "Messages", "messages"),
)
CHART_TITLE = '%s for  "%s"'


def day_kpis(activity: DataFrame) -> DataFrame:
    """One row of KPIs from the ``user_day_activity`` rows of one day.

    Each input row is one user, so active users are counts of ids, and all seven
    numbers come from one aggregate. An empty day gives zeros and a NULL ctr_pct.
    Actions without a user count as actions, not as a user.
    """
    views, likes, messages = (f"coalesce(sum({c}), 0)" for c in ("views", "likes", "messages"))
    return with_use_type(activity).agg(
        *exprs(
            "count_if(feed_actions > 0 AND user_id IS NOT NULL) AS feed_dau",
            "count_if(messages > 0 AND user_id IS NOT NULL) AS messenger_dau",
            f"{views} AS views",
            f"{likes} AS likes",
            f"{ctr_pct(likes, views)} AS ctr_pct",
            f"{messages} AS messages",
            "count_if(use_type = 'Both') AS both_users",
        )
    )


def kpi_row(
    activity: DataFrame, feed_days: DataFrame, as_of: date, horizon: int = WEEK, cohort: DataFrame | None = None
) -> DataFrame:
    """One row: report_date, the KPIs of yesterday, and day_1 .. of last week's cohort.

    ``activity`` holds ``user_day_activity`` rows; ``feed_days`` is anything with
    the users and days of the feed, and ``cohort``, if given, the cohort's row of
    ``retention.cohort_sizes``, for which ``feed_days`` is not read. Both parts have exactly one row, also when
    empty, and are stacked and folded into one.
    """
    d = yesterday(as_of)
    kpis = day_kpis(on_day(activity, d))
    week = retention_week_row(feed_days, as_of, horizon, cohort)
    names = [*kpis.columns, *week.columns]
    return kpis.unionByName(week, allowMissingColumns=True).agg(
        *exprs(f"max(DATE'{d}') AS report_date", *(f"max({c}) AS {c}" for c in names))
    )


def daily_kpis(feed: DataFrame, messages: DataFrame, as_of: date) -> DataFrame:
    """``kpi_row`` straight from the logs: yesterday of both, and the feed's (user, day) history."""
    d = yesterday(as_of)
    return kpi_row(user_day_activity(on_day(feed, d), on_day(messages, d)), feed, as_of)


def report_text(kpis: DataFrame, horizon: int = WEEK) -> DataFrame:
    """The report text in one row, from the row of ``daily_kpis``."""
    days = range(1, horizon + 1)
    template = TEXT.replace("{%s}", "{" + ", ".join(RETENTION % day_label(n) for n in days) + "}")
    values = exprs(
        "date_format(report_date, 'dd-MM-yyyy')",
        "feed_dau",
        "messenger_dau",
        "views",
        "likes",
        number_text("ctr_pct"),
        "messages",
        "both_users",
        *(number_text(f"day_{n}") for n in days),
    )
    return kpis.select(F.format_string(template, *values).alias("text"))


def report_lines(kpis: DataFrame, horizon: int = WEEK) -> DataFrame:
    """(line_no, line) of the report text."""
    lines = report_text(kpis, horizon).select(F.posexplode(F.split("text", "\n")).alias("k", "line"))
    return lines.selectExpr("bigint(k + 1) AS line_no", "line")


def _panels(metrics: DataFrame, charts: tuple, label: str) -> DataFrame:
    points = ", ".join(
        f"('{CHART_TITLE % (chart, label)}', '{panel}', dt, double({metric}))" for chart, panel, metric in charts
    )
    return metrics.selectExpr(f"inline(array({points})) AS (title, panel, dt, value)")


def chart_tables(
    feed_metrics: DataFrame, message_metrics: DataFrame, as_of: date, dense: bool = False
) -> DataFrame:
    """(title, panel, dt, value): the points of all charts, from per-day metrics; ``dense`` as in ``feed_series``."""
    label, window = range_label(as_of), last_days(as_of)
    if dense:
        feed_metrics, message_metrics = (dense_days(m, *window) for m in (feed_metrics, message_metrics))
    return _panels(feed_metrics, FEED_CHARTS, label).unionByName(_panels(message_metrics, MESSAGE_CHARTS, label))


def chart_series(feed: DataFrame, messages: DataFrame, as_of: date) -> DataFrame:
    """``chart_tables`` straight from the logs, one scan of each, in order."""
    window = last_days(as_of)
    charts = chart_tables(daily_feed_metrics(feed, *window), daily_message_metrics(messages, *window), as_of)
    return charts.orderBy("title", "panel", "dt")
