"""Day rollups of the two logs as stored tables.

Four tables hold one row per user, post or receiver and day, and the users of each post and
day as bitmaps, partitioned by day: a fraction of the logs, because repeated actions are
counted. Their numbers add up over days, and their bitmaps merge, so a daily run folds in
the days of the logs that changed and answers the report from the tables.

A further, small table holds the days that are folded: the number of rows that each log had,
what their files and their content were, and which version of the running state
(``daygauge.plans.state``) has the day in it. It is written last, and only its days are read
from the others: what a broken run left behind is not seen, and is folded again by the next
run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygauge.functions.columns import LIKES, VIEWS, between_days, ctr_pct, day, exprs
from daygauge.operators.activity import user_day_activity
from daygauge.operators.leaders import TOP, leader_order
from daygauge.sources.logs import scan_metrics
from daygauge.sources.sinks import remove_path

USERS, POSTS, RECEIVERS, POST_USERS = "user_days", "post_days", "receiver_days", "post_user_days"
FOLDED = "folded_days"
STAGED = "staged_days"
LOGS = ("feed", "message")
# Of each log: rows, a mark of the files they are in, and two sums over all rows. NULL where not known.
MARKS = tuple(f"{log}_{what}" for log in LOGS for what in ("rows", "files", "sum", "xor"))
FOLDED_SCHEMA = ", ".join(["dt date", *(f"{c} bigint" for c in (*MARKS, "totals", "words"))])
SCHEMAS = {
    POST_USERS: "post_id bigint, bucket bigint, users binary, dt date",
    USERS: "user_id bigint, views bigint, likes bigint, feed_actions bigint, messages bigint, dt date",
    POSTS: "post_id bigint, views bigint, likes bigint, dt date",
    RECEIVERS: "receiver_id bigint, messages bigint, dt date",
}


def post_days(feed: DataFrame) -> DataFrame:
    """Views and likes per post and day."""
    return feed.groupBy("post_id", day(feed).alias("dt")).agg(*exprs(f"{VIEWS} AS views", f"{LIKES} AS likes"))


def receiver_days(messages: DataFrame) -> DataFrame:
    """Messages per receiver and day."""
    return messages.groupBy("receiver_id", day(messages).alias("dt")).agg(F.count("*").alias("messages"))


def post_user_days(feed: DataFrame) -> DataFrame:
    """The users of each post and day as bitmaps, a row for each bucket of ids that has some.

    Bitmaps merge exactly over days and posts, which counts of distinct users do not. A NULL
    user is no user; negative ids have buckets like others.
    """
    return (
        feed.where("user_id IS NOT NULL")
        .groupBy("post_id", F.expr("bitmap_bucket_number(user_id)").alias("bucket"), day(feed).alias("dt"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(user_id))").alias("users"))
        .select("post_id", "bucket", "users", "dt")
    )


BUILD: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    POSTS: lambda feed, messages: post_days(feed),
    RECEIVERS: lambda feed, messages: receiver_days(messages),
    USERS: user_day_activity,
    POST_USERS: lambda feed, messages: post_user_days(feed),
}


def write_days(table: DataFrame, path: str) -> None:
    """Write rows that have a ``dt``, replacing exactly the days they cover.

    Rows are rebalanced by day, so a day becomes a few files of even size: small
    days are not scattered over all tasks and a hot day is split.
    """
    (
        table.hint("rebalance", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(path)
    )


Days = dict[date, dict[str, int | None]]


def _file_mark(log: DataFrame) -> Column:
    """A number for the file that a row is in; NULL where the log isn't a plain scan of files."""
    try:
        log.select("_metadata.file_path")
    except AnalysisException:
        return F.lit(None).cast("bigint")
    return F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")


def row_counts(feed: DataFrame, messages: DataFrame) -> Days:
    """Rows of each log by day and a mark of their files, one small row per day; rows without a time have no day.

    A log partitioned by day is only asked for its numbers of rows, and no column of it is read.
    """
    found: Days = {}
    for name, log in zip(LOGS, (feed, messages)):
        files = log.select(day(log).alias("dt"), _file_mark(log).alias("file")).where("dt IS NOT NULL")
        files = files.groupBy("dt", "file").agg(F.count("*").alias("n"))
        for dt, n, mark in files.groupBy("dt").agg(F.sum("n"), F.bit_xor("file")).collect():
            found.setdefault(dt, dict.fromkeys(MARKS) | {f"{x}_rows": 0 for x in LOGS}).update(
                {f"{name}_rows": n, f"{name}_files": mark}
            )
    return found


def _contents(log: DataFrame, name: str, days: set[date]) -> Days:
    """Of the given days: two sums over a log's rows that hold for any order, and change with any row."""
    if not days:
        return {}
    columns = [c for c in ("user_id", "post_id", "receiver_id", "action", "time") if c in log.columns]
    row = F.xxhash64(*columns, *(F.col(c).isNull() for c in columns))
    rows = log.where(day(log).isin(*[F.lit(dt) for dt in sorted(days)])).select(day(log).alias("dt"), row.alias("h"))
    # 28 bits of each row's hash, so that the sum of a day of many rows fits.
    sums = rows.groupBy("dt").agg(F.sum(F.shiftrightunsigned("h", 36)), F.bit_xor("h"))
    return {dt: {f"{name}_sum": total, f"{name}_xor": xor} for dt, total, xor in sums.collect()}


def changed_days(feed: DataFrame, messages: DataFrame, known: Days) -> tuple[set[date], Days]:
    """The days whose rows are not those that ``known`` was made of, and all days as they are now.

    A day has changed if its number of rows has, or else the content of a log. The content of a
    day is read only where the day's files are new since, or where the log is no scan of files. A view
    over files that is defined anew over the same files is not noticed: fold its days with ``refold``.
    """
    now = row_counts(feed, messages)
    rows = [f"{name}_rows" for name in LOGS]
    counted = lambda days, dt: [(days.get(dt) or {}).get(c) or 0 for c in rows]
    changed = {dt for dt in now.keys() | known.keys() if counted(now, dt) != counted(known, dt)}
    for name, log in zip(LOGS, (feed, messages)):
        content = (f"{name}_sum", f"{name}_xor")
        same_files = {
            dt for dt in now.keys() & known.keys()
            if now[dt][f"{name}_files"] is not None and now[dt][f"{name}_files"] == known[dt][f"{name}_files"]
        }
        has_rows = {dt for dt in now if now[dt][f"{name}_rows"]}
        kept = {dt for dt in same_files if known[dt][content[0]] is not None} - changed
        for dt, sums in (_contents(log, name, has_rows - kept) | {d: {c: known[d][c] for c in content} for d in kept}).items():
            now[dt].update(sums)
        changed |= {dt for dt in has_rows & known.keys() if any(now[dt][c] != known[dt][c] for c in content)}
    return changed, now


def folded(spark: SparkSession, path: str) -> Days:
    """The days in the tables, with what is known of each."""
    try:
        rows = spark.read.schema(FOLDED_SCHEMA).parquet(f"{path}/{FOLDED}").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    return {row.dt: {c: row[c] for c in row.__fields__ if c != "dt"} for row in rows}


def folded_days(spark: SparkSession, path: str) -> dict[date, tuple[int, int]]:
    """The days in the tables, with the rows of each log when they were folded."""
    return {dt: (row["feed_rows"], row["message_rows"]) for dt, row in folded(spark, path).items()}


def _record(spark: SparkSession, path: str, days: Days) -> None:
    names = [*MARKS, "totals", "words"]
    rows = [(dt, *(row.get(c) for c in names)) for dt, row in sorted(days.items())]
    spark.createDataFrame(rows, FOLDED_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/{FOLDED}")


def write_rollup(
    feed: DataFrame,
    messages: DataFrame,
    path: str,
    names: tuple[str, ...] = tuple(BUILD),
    counts: Days | None = None,
) -> None:
    """Build the named tables from all rows of the logs; ``counts`` may give their ``row_counts``."""
    counts = row_counts(feed, messages) if counts is None else counts
    for name in names:
        write_days(BUILD[name](feed, messages), f"{path}/{name}")
    _record(feed.sparkSession, path, counts)


@dataclass
class Folding:
    """The days that were folded, and what the scan of them has seen of each log (``logs.scan_metrics``)."""

    days: set[date]
    seen: dict[str, dict[str, int]]


def _fold(
    feed: DataFrame, messages: DataFrame, path: str, days: set[date], now: Days, running: bool = False
) -> dict[str, dict[str, int]]:
    """Fold the given days; one without rows is struck from the folded days. Returns what the scan has seen.

    With ``running`` the state moves along: the days' new rows are staged first, the next version of
    the state is written from them and the old rows, then the days are marked as open, replaced, and
    recorded. A run that breaks in between leaves days that are marked as open, or not folded, so the
    next one folds them and makes the parts of the state that are marked so from the tables.
    """
    spark = feed.sparkSession
    known = folded(spark, path)
    others = {dt: row for dt, row in known.items() if dt not in days}
    there = sorted(dt for dt in days if dt in now)
    new = {dt: dict(now[dt]) for dt in there}
    if not running and any(row["totals"] or row["words"] for row in known.values()):
        # There is a state, and it won't have these days as they are.
        others = {dt: {**row, "totals": None, "words": None} for dt, row in others.items()}
        _record(spark, path, others)
    if there:
        chosen = [F.lit(dt) for dt in there]
        feed, messages = (log.where(day(log).isin(*chosen)) for log in (feed, messages))
    place = f"{path}/{STAGED}" if running else path
    counted = [scan_metrics(log, f"{name}-{uuid.uuid4().hex}") for name, log in zip(LOGS, (feed, messages))]
    for name, build in BUILD.items() if there else ():
        logs = [log for log, _ in counted] if name == USERS else (feed, messages)
        write_days(build(*logs), f"{place}/{name}")
    if running:
        from daygauge.plans import state

        moved = state.advance(spark, path, place, known, days, there)
        _record(spark, path, {dt: {**row, **moved.open(dt)} for dt, row in others.items()})
        for name in BUILD if there else ():
            staged = spark.read.schema(SCHEMAS[name]).parquet(f"{place}/{name}")
            write_days(staged, f"{path}/{name}")
        others, new = ({dt: {**row, **moved.done(dt)} for dt, row in x.items()} for x in (others, new))
    _record(spark, path, others | new)
    if running:
        moved.clean()
        remove_path(spark, place)
    return {name: seen.get for name, (_, seen) in zip(LOGS, counted)} if there else {}


def fold_days(
    feed: DataFrame, messages: DataFrame, path: str, first: date, last: date, running: bool = False
) -> None:
    """Fold a run of days into all tables; a day folded before is replaced, also by nothing."""
    counts = row_counts(between_days(feed, first, last), between_days(messages, first, last))
    days = {first + timedelta(days=k) for k in range((last - first).days + 1)}
    _fold(feed, messages, path, days, counts, running)


def extend_rollup(
    feed: DataFrame,
    messages: DataFrame,
    path: str,
    as_of: date,
    refold: tuple[date, date] | None = None,
    by_content: bool = False,
    running: bool = False,
) -> Folding:
    """Bring the tables up to ``as_of``: fold every day that changed in a log.

    A day has changed if its number of rows has, with ``by_content`` also if its rows have. So late
    and changed rows, days that lost all rows, and days that a broken run left out are all folded.
    The logs are only counted by day for this, and contents compared where files are new
    (``changed_days``). ``refold``, a first and a last day, folds these anyway. With ``running`` the
    running state is kept as well, which needs every folded day in it.
    """
    spark = feed.sparkSession
    feed, messages = (log.where(day(log) <= F.lit(as_of)) for log in (feed, messages))
    all_known = folded(spark, path)
    known = {dt: row for dt, row in all_known.items() if dt <= as_of}
    if by_content:
        changed, now = changed_days(feed, messages, known)
    else:
        now, before = row_counts(feed, messages), folded_days(spark, path)
        counts = {dt: (row["feed_rows"], row["message_rows"]) for dt, row in now.items()}
        changed = {dt for dt in now.keys() | known.keys() if counts.get(dt) != before.get(dt)}
    if refold:
        changed |= {dt for dt in now if refold[0] <= dt <= refold[1]}
    behind = running and any(row["totals"] is None or row["words"] is None for row in all_known.values())
    seen = {}
    if changed or behind:
        seen = _fold(feed, messages, path, changed, now, running)
    elif by_content and any(now[dt][c] != known[dt][c] for dt in known for c in MARKS):
        # Same rows in other files: remember the files, so that the next run need not read them.
        _record(spark, path, {dt: {**row, **now.get(dt, {})} for dt, row in all_known.items()})
    return Folding(changed, seen)


def read_days(spark: SparkSession, path: str, name: str, as_of: date | None = None) -> DataFrame:
    """A table's folded days, up to ``as_of``."""
    feed, messages = name != RECEIVERS, name not in (POSTS, POST_USERS)
    days = [
        F.lit(dt)
        for dt, (feed_rows, message_rows) in sorted(folded_days(spark, path).items())
        if (as_of is None or dt <= as_of) and (feed and feed_rows or messages and message_rows)
    ]
    if not days:
        return spark.createDataFrame([], SCHEMAS[name])
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{name}").where(F.col("dt").isin(*days))


def feed_days(user_days: DataFrame) -> DataFrame:
    """The feed's (user_id, dt); every operator that needs only those accepts it."""
    return user_days.where(F.col("feed_actions") > 0).select("user_id", "dt")


def rolled_feed_metrics(user_days: DataFrame, first: date, last: date) -> DataFrame:
    """``daily_feed_metrics`` from the rollup: a user is one row, so nothing is counted distinct."""
    return (
        between_days(user_days, first, last)
        .where(F.col("feed_actions") > 0)
        .groupBy("dt")
        .agg(
            *exprs(
                "sum(views) AS views",
                "sum(likes) AS likes",
                f"{ctr_pct('sum(likes)', 'sum(views)')} AS ctr_pct",
                "sum(feed_actions) AS actions",
                "count(user_id) AS users",
            )
        )
    )


def rolled_message_metrics(user_days: DataFrame, first: date, last: date) -> DataFrame:
    """``daily_message_metrics`` from the rollup."""
    return (
        between_days(user_days, first, last)
        .where(F.col("messages") > 0)
        .groupBy("dt")
        .agg(*exprs("sum(messages) AS messages", "count(user_id) AS users"))
    )


def rolled_post_counts(post_days: DataFrame) -> DataFrame:
    """``leaders.post_counts`` from the rollup."""
    return post_days.groupBy("post_id").agg(*exprs("sum(views) AS views", "sum(likes) AS likes"))


def rolled_top(days: DataFrame, id_col: str, count_col: str, metric: str, k: int = TOP) -> DataFrame:
    """``leaders.top_by_count`` from the rollup: the ids with the largest sums of ``count_col``."""
    counted = F.when(F.col(id_col).isNotNull(), F.col(count_col)).otherwise(0)
    counts = days.where(F.col(count_col) > 0).groupBy(id_col).agg(F.sum(counted).alias(metric))
    return counts.orderBy(*leader_order(metric, id_col)).limit(k)
