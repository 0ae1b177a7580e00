"""Cohort retention: how many users of a start date come back on each day after it."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygauge.functions.clock import WEEK
from daygauge.functions.columns import day, exprs, ratio, round2

# Days that fit into the bits of a bigint.
MASK_DAYS = 62


# Fixed value: the label of a day.
def day_label(n: int) -> str:
    return f"Day {n}"


def cohort_sizes(feed: DataFrame, horizon: int = WEEK) -> DataFrame:
    """One row per start date: ``start_date`` and ``days``, the number of its users
    active on day 1 .. ``horizon``.

    Days are split by day number modulo ``horizon``, and each user keeps the
    earliest day of every residue. The earliest of those is the start date s. The
    days s .. s+horizon-1 all differ in residue, and no active day lies before
    s, so the user was active on s+k exactly if s+k is the earliest day of its
    residue. That makes first day and first-week activity one fixed-size
    aggregate: a single scan and a single shuffle by user, with no distinct,
    join, window or sort, and at most one row per user and task to move. Actions
    without a user or a day belong to no cohort.
    """
    firsts = ", ".join(f"min(CASE WHEN residue = {r} THEN dt END)" for r in range(horizon))
    counts = ", ".join(
        f"count_if(array_contains(active_days, date_add(start_date, {k})))" for k in range(horizon)
    )
    return (
        feed.select("user_id", day(feed).alias("dt"))
        .where("user_id IS NOT NULL AND dt IS NOT NULL")
        .withColumn("residue", F.expr(f"pmod(unix_date(dt), {horizon})"))
        .groupBy("user_id")
        .agg(F.expr(f"array({firsts}) AS active_days"))
        .withColumn("start_date", F.array_min("active_days"))
        .groupBy("start_date")
        .agg(F.expr(f"array({counts}) AS days"))
    )


def cohort_activity(feed: DataFrame, horizon: int = WEEK) -> DataFrame:
    """(start_date, dt, duration, users, first_day_users) for every day with returning users."""
    return activity_of_sizes(cohort_sizes(feed, horizon))


def activity_of_sizes(sizes: DataFrame) -> DataFrame:
    """``cohort_activity`` from the rows of ``cohort_sizes``."""
    return (
        sizes.selectExpr("start_date", "days[0] AS first_day_users", "posexplode(days) AS (k, users)")
        .where("users > 0")
        .selectExpr(
            "start_date",
            "date_add(start_date, k) AS dt",
            "bigint(k + 1) AS duration",
            "users",
            "first_day_users",
        )
    )


def retention_long(feed: DataFrame, horizon: int = WEEK) -> DataFrame:
    """(dt, start_date, duration, retention), by start date and duration."""
    return (
        cohort_activity(feed, horizon)
        .selectExpr("dt", "start_date", "duration", f"{ratio('users', 'first_day_users')} AS retention")
        .orderBy("start_date", "duration")
    )


def _ratios(horizon: int) -> list[tuple[int, str]]:
    """Day number and retention of day 1 .. horizon; NULL on a day nobody returned."""
    return [(k + 1, ratio(f"nullif(days[{k}], 0)", "days[0]")) for k in range(horizon)]


def retention_pivot(feed: DataFrame, horizon: int = WEEK) -> DataFrame:
    """One row per start date, one column ``Day n`` per day; NULL where nobody returned."""
    ratios = [f"{r} AS `{day_label(n)}`" for n, r in _ratios(horizon)]
    return cohort_sizes(feed, horizon).selectExpr("start_date", *ratios).orderBy("start_date")


def _week_cohort(feed: DataFrame, as_of: date, horizon: int) -> DataFrame:
    """The cohort whose first ``horizon`` days ended yesterday; no row if nobody started then.

    The start date is known, so a user needs two numbers only: the first active day,
    with all days before the start as one, and the active days of the cohort as bits.
    Both combine before the shuffle. More days than bits take ``cohort_sizes``.
    """
    history = feed.where(day(feed) < F.lit(as_of))
    start = as_of - timedelta(days=horizon)
    if horizon > MASK_DAYS:
        return cohort_sizes(history, horizon).where(F.col("start_date") == F.lit(start))
    counts = ", ".join(f"count_if(getbit(mask, {k}) = 1)" for k in range(horizon))
    return (
        history.select("user_id", F.datediff(day(feed), F.lit(start)).alias("offset"))
        .where("user_id IS NOT NULL AND offset IS NOT NULL")
        .groupBy("user_id")
        .agg(*exprs("min(greatest(offset, -1)) AS first", "bit_or(if(offset < 0, 0L, shiftleft(1L, offset))) AS mask"))
        .where("first = 0")
        .groupBy(F.lit(start).alias("start_date"))
        .agg(F.expr(f"array({counts}) AS days"))
    )


def retention_week(feed: DataFrame, as_of: date, horizon: int = WEEK) -> DataFrame:
    """(duration, label, retention) of the cohort whose first week ended yesterday, two decimals."""
    rows = ", ".join(f"({n}L, '{day_label(n)}', {round2(r)})" for n, r in _ratios(horizon))
    week = _week_cohort(feed, as_of, horizon)
    return week.selectExpr(f"inline(array({rows})) AS (duration, label, retention)")


def retention_week_row(
    feed: DataFrame, as_of: date, horizon: int = WEEK, cohort: DataFrame | None = None
) -> DataFrame:
    """The same values as columns ``day_1`` .. of exactly one row; all NULL without a cohort.

    ``cohort`` may give the cohort's row of ``cohort_sizes`` from a stored state.
    """
    ratios = (f"max({round2(r)}) AS day_{n}" for n, r in _ratios(horizon))
    return (_week_cohort(feed, as_of, horizon) if cohort is None else cohort).agg(*exprs(*ratios))
