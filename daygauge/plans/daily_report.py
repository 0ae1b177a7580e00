"""The daily job: logs in; report text, chart tables and leaderboard files out.

    spark-submit --py-files daygauge.zip daygauge/plans/daily_report.py \\
        --feed <path> --messages <path> --out <path> [--as-of 2024-01-31] [--rollup <path>]
"""

from __future__ import annotations

import argparse
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygauge.functions import clock
from daygauge.functions.columns import day
from daygauge.operators.leaders import leader_order, top_by_count, top_posts
from daygauge.plans import rollup as ru
from daygauge.plans import state
from daygauge.plans.report import chart_tables, kpi_row, report_text
from daygauge.sources.logs import feed_actions, message_actions, scan_metrics
from daygauge.sources.sinks import export_ranked_csv, publish, remove_path, shared_path, write_csv, write_text

# File names and column headings of the exported tables.
POSTS_CSV, MAILERS_CSV, RECEIVERS_CSV, FEED_CSV = (
    "Top_100_posts.csv",
    "Top_100_mailers.csv",
    "Top_100_receivers.csv",
    "Top_100_feed.csv",
)
# Columns of the user tables and what their leaderboards call them.
USER_METRICS = (("messages", "sent"), ("feed_actions", "actions"))
HEADINGS = {
    POSTS_CSV: {"views": "Views", "likes": "Likes", "ctr": "Like/View CTR for TOP", "users": "Unique users"},
    MAILERS_CSV: {"sent": "Sent msgs"},
    RECEIVERS_CSV: {"receiver_id": "reciever_id", "received": "Received msgs"},
    FEED_CSV: {"actions": "Actions"},
}


def write_daily_report(
    feed: DataFrame,
    messages: DataFrame,
    as_of: date,
    out: str,
    rollup_path: str | None = None,
    refold: tuple[date, date] | None = None,
) -> dict[str, dict[str, int]]:
    """Write the whole report for ``as_of`` under ``out``; later rows of the logs count nowhere.

    With ``rollup_path``, the tables and the running state there are brought up to date and
    answer everything; of the logs only days that changed are read. Without it, the user-day
    rollup of all history is written once to the shared folder, serves all outputs that need
    users, and is removed in the end.

    Returns what the scans have seen of each log (``logs.scan_metrics``), in the same pass:
    without a rollup the whole log up to ``as_of``, with one the days that were folded.
    """
    spark = feed.sparkSession
    feed, messages = (log.where(day(log) <= F.lit(as_of)) for log in (feed, messages))
    if rollup_path:
        seen = ru.extend_rollup(feed, messages, rollup_path, as_of, refold, by_content=True, running=True).seen
        totals = lambda name: state.read_totals(spark, rollup_path, name, as_of)
        users = totals("user_totals")
        posts = state.running_top_posts(totals("post_totals"), ru.read_days(spark, rollup_path, ru.POST_USERS, as_of))
        receivers = state.running_top(totals("receiver_totals"), "receiver_id", "messages", "received")
        mailers, readers = (state.running_top(users, "user_id", c, n) for c, n in USER_METRICS)
        cohort = state.week_cohort(state.read_words(spark, rollup_path), as_of)
        user_days = ru.read_days(spark, rollup_path, ru.USERS, as_of)
        _write_outputs(user_days, cohort, posts, mailers, receivers, readers, as_of, out)
        return seen
    own_path = shared_path(spark)
    try:
        (feed_rows, feed_seen), (message_rows, message_seen) = (
            scan_metrics(log, f"{name}-{uuid.uuid4().hex}") for name, log in (("feed", feed), ("messages", messages))
        )
        ru.write_rollup(feed_rows, message_rows, own_path, names=(ru.USERS,), counts=ru.row_counts(feed, messages))
        user_days = ru.read_days(spark, own_path, ru.USERS)
        mailers, readers = (ru.rolled_top(user_days, "user_id", c, n) for c, n in USER_METRICS)
        receivers = top_by_count(messages, "receiver_id", "received")
        _write_outputs(user_days, None, top_posts(feed), mailers, receivers, readers, as_of, out)
        return {"feed": feed_seen.get, "message": message_seen.get}
    finally:
        remove_path(spark, own_path)


def _write_outputs(
    user_days: DataFrame,
    cohort: DataFrame | None,
    posts: DataFrame,
    mailers: DataFrame,
    receivers: DataFrame,
    readers: DataFrame,
    as_of: date,
    out: str,
) -> None:
    kpis = kpi_row(user_days, ru.feed_days(user_days), as_of, cohort=cohort)
    write_text(report_text(kpis), f"{out}/report.txt")

    window = clock.last_days(as_of)
    charts = chart_tables(
        ru.rolled_feed_metrics(user_days, *window), ru.rolled_message_metrics(user_days, *window), as_of
    )
    write_csv(charts, f"{out}/charts.csv", order=("title", "panel", "dt"))

    leaders = {
        POSTS_CSV: (posts, "post_id", "views"),
        MAILERS_CSV: (mailers, "user_id", "sent"),
        RECEIVERS_CSV: (receivers, "receiver_id", "received"),
        FEED_CSV: (readers, "user_id", "actions"),
    }
    for name, (top, id_col, metric) in leaders.items():
        export_ranked_csv(top, f"{out}/{name}", leader_order(metric, id_col), HEADINGS[name])


def publish_daily_report(
    feed: DataFrame,
    messages: DataFrame,
    as_of: date,
    out: str,
    rollup_path: str | None = None,
    refold: tuple[date, date] | None = None,
) -> str:
    """Write the report to a folder of its own under ``out`` and then publish it; returns that folder.

    Readers follow the manifest (``sinks.published``), which gets its row when all six files are
    there: a run that breaks between files leaves the report before it as it was, whole.
    """
    folder = f"{out}/reports/{as_of}-{uuid.uuid4().hex}"
    write_daily_report(feed, messages, as_of, folder, rollup_path, refold)
    publish(feed.sparkSession, out, folder, as_of)
    return folder


def main() -> None:
    parser = argparse.ArgumentParser(description="Write the daily engagement report.")
    parser.add_argument("--feed", required=True, help="parquet path of the feed log")
    parser.add_argument("--messages", required=True, help="parquet path of the message log")
    parser.add_argument("--out", required=True, help="folder for the report")
    parser.add_argument("--as-of", type=date.fromisoformat, help="today's date (default: now in --tz)")
    parser.add_argument("--tz", default="UTC", help="time zone of today's date and of the days of instants")
    parser.add_argument("--rollup", help="folder of the stored day rollups to extend and use")
    days = {"nargs": 2, "type": date.fromisoformat, "metavar": ("FIRST", "LAST")}
    parser.add_argument("--publish", action="store_true", help="write to a new folder, and publish it when complete")
    parser.add_argument("--refold", **days, help="days to fold into the rollup again")
    args = parser.parse_args()

    spark = SparkSession.builder.appName("daygauge-daily-report").getOrCreate()
    # One clock: days of instants begin and end where today does.
    spark.conf.set("spark.sql.session.timeZone", args.tz)
    write = publish_daily_report if args.publish else write_daily_report
    write(
        feed_actions(spark, args.feed),
        message_actions(spark, args.messages),
        args.as_of or clock.today(args.tz),
        args.out,
        args.rollup,
        tuple(args.refold) if args.refold else None,
    )


if __name__ == "__main__":
    main()
