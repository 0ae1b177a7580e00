"""The report frames, the stored rollup and the daily job."""

import csv
import glob
from datetime import date, time, timedelta

import cases
import pytest
from pyspark.sql import functions as F

from daygauge.functions.clock import last_days
from daygauge.operators import daily, leaders, overlap, retention
from daygauge.plans import daily_report, report
from daygauge.plans import rollup as ru
from daygauge.sources import events, sinks

D = cases.D

MICRO_TEXT = """\
Report №-2 for 10-03-2024:
Feed DAU = 4
            Messenger DAU = 3
Views = 2
            Likes = 2
CTR = 100.0%%
Messages = 3
            Engaged in both feed and messenger = 1
            Last week retention = {%s}""" % ", ".join(f"'Day {n}': nan" for n in range(1, 8))

EMPTY_LINES = ["Feed DAU = 0", "CTR = nan%", "            Engaged in both feed and messenger = 0"]


@pytest.fixture(scope="module")
def micro(spark):
    return (
        spark.createDataFrame(cases.MICRO_FEED, cases.FEED_SCHEMA),
        spark.createDataFrame(cases.MICRO_MESSAGES, cases.MESSAGE_SCHEMA),
    )


@pytest.fixture(scope="module")
def logs(spark):
    table = events.read_events(spark, "/root/testdata/sf0.01")
    return events.feed_from_events(table), events.messages_from_events(table)


def tuples(df):
    return sorted(map(tuple, df.collect()))


def text_of(path, pattern):
    (file,) = glob.glob(f"{path}/part-*{pattern}")
    return open(file, encoding="utf-8").read()


def test_text(micro):
    feed, messages = micro
    kpis = report.daily_kpis(feed, messages, D + timedelta(days=1))
    assert report.report_text(kpis).first()[0] == MICRO_TEXT
    lines = report.report_lines(kpis).orderBy("line_no").collect()
    assert [r.line for r in lines] == MICRO_TEXT.split("\n")


def test_text_of_an_empty_day(micro):
    kpis = report.daily_kpis(*micro, D + timedelta(days=2))
    lines = report.report_text(kpis).first()[0].split("\n")
    assert set(EMPTY_LINES) <= set(lines)


def test_kpis_equal_the_single_operators(logs):
    feed, messages = logs
    for as_of in (date(2024, 1, 8), date(2024, 1, 31)):
        d = as_of - timedelta(days=1)
        row = report.daily_kpis(feed, messages, as_of).first()
        assert row.report_date == d
        assert row.feed_dau == daily.dau_day(feed, d).first()[0]
        assert row.messenger_dau == daily.dau_day(messages, d).first()[0]
        assert row.views == daily.action_count_day(feed, d, "view").first()[0]
        assert row.likes == daily.action_count_day(feed, d, "like").first()[0]
        assert row.ctr_pct == daily.ctr_day(feed, d).first()[0]
        assert row.messages == daily.message_count_day(messages, d).first()[0]
        assert row.both_users == overlap.both_users_day(feed, messages, d).first()[0]
        week = {r.duration: r.retention for r in retention.retention_week(feed, as_of).collect()}
        assert [row[f"day_{n}"] for n in range(1, 8)] == [week.get(n) for n in range(1, 8)]


@pytest.mark.parametrize("seed", range(11, 17))
def test_kpis_match_brute_force(spark, seed):
    rows, message_rows = cases.random_logs(seed, users=6 * seed, rows=40 * seed, days=12, hot=0.35 * (seed % 2))
    feed = spark.createDataFrame(rows, cases.FEED_SCHEMA).repartition(3)
    messages = spark.createDataFrame(message_rows, cases.MESSAGE_SCHEMA)
    for days in (1, 7, 8, 30):
        as_of = D + timedelta(days=days)
        assert tuple(report.daily_kpis(feed, messages, as_of).first()) == cases.kpis(rows, message_rows, as_of)


def test_charts_equal_the_series(logs):
    feed, messages = logs
    as_of = date(2024, 1, 31)
    points = report.chart_series(feed, messages, as_of).collect()
    assert len(points) == 42 and len({r.title for r in points}) == 4
    assert points[0].title == 'CTR for  "24-01-2024 - 30-01-2024"'
    panels = {
        ("Views/Likes", "Views"): daily.feed_series(feed, as_of, "views"),
        ("Views/Likes", "Likes"): daily.feed_series(feed, as_of, "likes"),
        ("CTR", "CTR, %"): daily.feed_series(feed, as_of, "ctr_pct"),
        ("DAU", "Feed"): daily.feed_series(feed, as_of, "users"),
        ("DAU", "Messenger"): daily.message_series(messages, as_of, "users"),
        ("Messages", "Messages"): daily.message_series(messages, as_of, "messages"),
    }
    for (chart, panel), series in panels.items():
        drawn = [(r.dt, r.value) for r in points if r.panel == panel and r.title.startswith(chart + " ")]
        assert drawn == [tuple(r) for r in series.collect()]


# --- rollup -------------------------------------------------------------------


def test_rollup_answers_equal_the_log_answers(spark, logs, tmp_path):
    feed, messages = logs
    path = str(tmp_path / "rollup")
    ru.write_rollup(feed, messages, path)
    users, posts, receivers = (ru.read_days(spark, path, name) for name in (ru.USERS, ru.POSTS, ru.RECEIVERS))
    assert users.schema["dt"].dataType.simpleString() == "date"
    window = last_days(date(2024, 1, 31))
    assert tuples(ru.rolled_feed_metrics(users, *window)) == tuples(daily.daily_feed_metrics(feed, *window))
    assert tuples(ru.rolled_message_metrics(users, *window)) == tuples(daily.daily_message_metrics(messages, *window))
    for column, log in (("feed_actions", feed), ("messages", messages)):
        rolled = ru.rolled_top(users, "user_id", column, "n")
        assert rolled.collect() == leaders.top_by_count(log, "user_id", "n").collect()
    rolled = ru.rolled_top(receivers, "receiver_id", "messages", "n")
    assert rolled.collect() == leaders.top_by_count(messages, "receiver_id", "n").collect()
    assert tuples(ru.rolled_post_counts(posts)) == tuples(leaders.post_counts(feed))
    assert leaders.top_posts(feed, counts=ru.rolled_post_counts(posts)).collect() == leaders.top_posts(feed).collect()
    classes = ("feed_user", "messenger_user", "dt", "use_type")
    assert tuples(overlap.with_use_type(users).select(*classes)) == tuples(overlap.user_overlap(feed, messages))
    assert tuples(retention.cohort_activity(ru.feed_days(users))) == tuples(retention.cohort_activity(feed))
    # Small days are not scattered over all tasks.
    assert len(glob.glob(f"{path}/user_days/dt=2024-01-30/part-*")) == 1


def test_folding_day_by_day_equals_the_whole(spark, tmp_path):
    rows, message_rows = cases.random_logs(seed=5, users=20, rows=300, days=4)
    feed = spark.createDataFrame(rows, cases.FEED_SCHEMA)
    messages = spark.createDataFrame(message_rows, cases.MESSAGE_SCHEMA)
    path = str(tmp_path / "rollup")
    for k in (0, 1, 2, 3, 2):  # folding a day again changes nothing
        ru.fold_days(feed, messages, path, D + timedelta(days=k), D + timedelta(days=k))
    for name, build in ru.BUILD.items():
        whole, folded = build(feed, messages), ru.read_days(spark, path, name)
        assert tuples(folded.select(*whole.columns)) == tuples(whole)


def test_extending_catches_up(spark, tmp_path):
    rows, message_rows = cases.random_logs(seed=6, users=20, rows=400, days=6)
    path = str(tmp_path / "rollup")

    def known_at(log, day, hour):
        stop = cases.at(day, time(hour))
        return [r for r in log if r[-1] < stop]

    # First run on day 1, a run in the middle of day 2, no run on day 3, and one after the end.
    for k, hour in ((1, 9), (2, 12), (4, 9), (7, 0)):
        as_of = D + timedelta(days=k)
        feed = spark.createDataFrame(known_at(rows, as_of, hour), cases.FEED_SCHEMA)
        messages = spark.createDataFrame(known_at(message_rows, as_of, hour), cases.MESSAGE_SCHEMA)
        ru.extend_rollup(feed, messages, path, as_of)
        for name, build in ru.BUILD.items():
            whole, stored = build(feed, messages), ru.read_days(spark, path, name)
            assert tuples(stored.select(*whole.columns)) == tuples(whole)


def test_tables_left_by_a_broken_run_are_folded_again(spark, tmp_path):
    rows, message_rows = cases.random_logs(seed=7, users=20, rows=200, days=3)
    feed = spark.createDataFrame(rows, cases.FEED_SCHEMA)
    messages = spark.createDataFrame(message_rows, cases.MESSAGE_SCHEMA)
    path = str(tmp_path / "rollup")
    ru.write_rollup(feed.limit(5), messages.limit(5), path, names=(ru.POSTS,))
    (tmp_path / "rollup" / ru.FOLDED).rename(tmp_path / "gone")  # the run broke before it wrote this
    assert ru.folded_days(spark, path) == {}
    ru.extend_rollup(feed, messages, path, D + timedelta(days=3))
    assert tuples(ru.read_days(spark, path, ru.POSTS).select("post_id", "dt", "views", "likes")) == tuples(
        ru.post_days(feed)
    )


def test_a_hot_day_is_split_over_files(spark, tmp_path):
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    hot = spark.range(0, 400_000, 1, 16).select(
        F.col("id").alias("user_id"),
        *(F.lit(1).cast("bigint").alias(c) for c in ("views", "likes", "feed_actions", "messages")),
        F.expr(f"CASE WHEN id % 3 > 0 THEN DATE'{D}' ELSE date_add(DATE'{D}', int(id % 30)) END AS dt"),
    )
    path = str(tmp_path / "rollup")
    try:
        spark.conf.set(advisory, "256KB")
        ru.write_days(hot, f"{path}/{ru.USERS}")
    finally:
        spark.conf.set(advisory, before)
    assert len(glob.glob(f"{path}/{ru.USERS}/dt={D}/part-*")) > 1
    assert spark.read.parquet(f"{path}/{ru.USERS}").count() == 400_000


def test_shared_path_is_in_the_cluster_folder(spark):
    assert sinks.shared_path(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def stored_tables_equal(spark, feed, messages, path):
    return all(
        tuples(ru.read_days(spark, path, name).select(*build(feed, messages).columns)) == tuples(build(feed, messages))
        for name, build in ru.BUILD.items()
    )


def test_late_rows_emptied_days_and_lone_days(spark, tmp_path):
    rows, message_rows = cases.random_logs(seed=8, users=20, rows=400, days=8)
    messages = spark.createDataFrame(message_rows, cases.MESSAGE_SCHEMA)
    path, end = str(tmp_path / "rollup"), D + timedelta(days=8)

    def extended(rows, messages, **more):
        feed = spark.createDataFrame(rows, cases.FEED_SCHEMA)
        ru.extend_rollup(feed, messages, path, end, **more)
        return stored_tables_equal(spark, feed, messages, path)

    # A lone day first: the others are not taken for folded.
    whole = spark.createDataFrame(rows, cases.FEED_SCHEMA)
    ru.fold_days(whole, messages, path, D + timedelta(days=6), D + timedelta(days=6))
    assert extended(rows, messages)
    late = [*rows, (3, 4, "view", cases.at(D + timedelta(days=1)))]
    assert extended(late, messages)
    emptied = [r for r in late if r[3].date() != D + timedelta(days=2)]
    assert extended(emptied, messages)
    empty_day = messages.where(F.to_date("time") != F.lit(D + timedelta(days=2)))
    assert extended(emptied, empty_day)
    # As many rows as before, but others.
    changed = [(u + 1, p, a, t) if t.date() == D else (u, p, a, t) for u, p, a, t in emptied]
    assert not extended(changed, empty_day)
    assert extended(changed, empty_day, refold=(D, D))


@pytest.mark.parametrize("as_of", [date(2024, 1, 15), date(2024, 1, 31)])
def test_the_job_is_the_same_for_any_date_and_rollup(spark, logs, tmp_path, as_of):
    feed, messages = logs
    further = str(tmp_path / "further")
    ru.write_rollup(feed, messages, further)
    ways = {"logs": None, "fresh": str(tmp_path / "fresh"), "further": further}
    work = glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/daygauge-*")
    for way, path in ways.items():
        daily_report.write_daily_report(feed, messages, as_of, str(tmp_path / "out" / way), path)
    assert glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/daygauge-*") == work
    for name in ("report.txt", "charts.csv", *daily_report.HEADINGS):
        texts = [text_of(tmp_path / "out" / way / name, name[-4:]) for way in ways]
        assert texts[0] == texts[1] == texts[2]
    rows = [tuple(r) for r in feed.where(F.to_date("time") <= F.lit(as_of)).select("user_id", "post_id", "action", "time").collect()]
    printed = list(csv.reader(text_of(tmp_path / "out" / "logs" / "Top_100_posts.csv", ".csv").splitlines()))[1:]
    assert [tuple(map(int, (r[1], r[2], r[3], r[5]))) for r in printed] == [
        (p, v, l, u) for p, v, l, _, u in cases.posts(rows, 100)
    ]


# --- job ----------------------------------------------------------------------


@pytest.mark.parametrize("stored", [False, True], ids=["from-logs", "from-rollup"])
def test_daily_job(spark, logs, tmp_path, stored):
    feed, messages = logs
    as_of = date(2024, 1, 31)
    out, path = str(tmp_path / "out"), None
    if stored:
        path = str(tmp_path / "rollup")
        earlier = F.col("time") < F.lit("2024-01-30").cast("timestamp_ntz")
        ru.write_rollup(feed.where(earlier), messages.where(earlier), path)
    daily_report.write_daily_report(feed, messages, as_of, out, path)

    text = text_of(f"{out}/report.txt", ".txt").rstrip("\n")
    assert text == report.report_text(report.daily_kpis(feed, messages, as_of)).first()[0]
    charts = list(csv.reader(text_of(f"{out}/charts.csv", ".csv").splitlines()))
    assert charts[0] == ["title", "panel", "dt", "value"] and len(charts) == 43
    assert charts[1][:2] == ['CTR for  "24-01-2024 - 30-01-2024"', "CTR, %"] and charts[1:] == sorted(charts[1:])

    posts = list(csv.reader(text_of(f"{out}/Top_100_posts.csv", ".csv").splitlines()))
    assert posts[0] == ["", "post_id", "Views", "Likes", "Like/View CTR for TOP", "Unique users"]
    assert [r[0] for r in posts[1:]] == [str(n) for n in range(100)] and posts[1][1:3] == ["73", "11"]
    tops = {
        "Top_100_mailers.csv": (["", "user_id", "Sent msgs"], ["0", "41", "43"]),
        "Top_100_receivers.csv": (["", "reciever_id", "Received msgs"], ["0", "69", "17"]),
        "Top_100_feed.csv": (["", "user_id", "Actions"], ["0", "17", "58"]),
    }
    for name, (head, first) in tops.items():
        rows = list(csv.reader(text_of(f"{out}/{name}", ".csv").splitlines()))
        assert rows[0] == head and rows[1] == first and len(rows) == 101


def test_both_ways_count_the_rows_of_today(spark, logs, tmp_path):
    feed, messages = logs
    as_of = date(2024, 1, 30)  # the logs hold rows of this day
    path = str(tmp_path / "rollup")
    ru.fold_days(feed, messages, path, date(2024, 1, 1), date(2024, 1, 28))
    daily_report.write_daily_report(feed, messages, as_of, str(tmp_path / "logs"))
    daily_report.write_daily_report(feed, messages, as_of, str(tmp_path / "rolled"), path)
    for name in ("report.txt", "charts.csv", *daily_report.HEADINGS):
        texts = [text_of(tmp_path / way / name, name[-4:]) for way in ("logs", "rolled")]
        assert texts[0] == texts[1]


def test_days_follow_the_time_zone(spark, tmp_path, monkeypatch):
    instants = ["2024-03-09 20:59:59", "2024-03-09 21:00:01", "2024-03-10 20:59:59", "2024-03-10 21:00:01"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    log = spark.createDataFrame([(n + 1, 1, "view", t) for n, t in enumerate(instants)], "user_id long, post_id long, action string, t string")
    log = log.withColumn("time", F.col("t").cast("timestamp")).drop("t")
    log.write.parquet(str(tmp_path / "feed"))
    log.selectExpr("user_id", "post_id AS receiver_id", "time").write.parquet(str(tmp_path / "messages"))
    args = ["--feed", tmp_path / "feed", "--messages", tmp_path / "messages", "--out", tmp_path / "out"]
    monkeypatch.setattr("sys.argv", ["daily_report", *map(str, args), "--as-of", "2024-03-11", "--tz", "Europe/Moscow"])
    try:
        daily_report.main()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    # The day of Moscow holds the second and third instant.
    assert text_of(tmp_path / "out" / "report.txt", ".txt").splitlines()[1:4:2] == ["Feed DAU = 2", "Views = 2"]


def test_command_line(spark, logs, tmp_path, monkeypatch):
    feed, messages = logs
    feed.withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(str(tmp_path / "feed"))
    messages.withColumn("dt", F.to_date("time")).write.partitionBy("dt").parquet(str(tmp_path / "messages"))
    out = tmp_path / "out"
    args = ["--feed", tmp_path / "feed", "--messages", tmp_path / "messages", "--out", out, "--as-of", "2024-01-08"]
    monkeypatch.setattr("sys.argv", ["daily_report", *map(str, args)])
    daily_report.main()
    lines = text_of(out / "report.txt", ".txt").splitlines()
    assert lines[0] == "Report №-2 for 07-01-2024:"
    assert lines[-1].endswith(
        "{'Day 1': 1.0, 'Day 2': 0.74, 'Day 3': 0.7, 'Day 4': 0.75, 'Day 5': 0.76, 'Day 6': 0.69, 'Day 7': 0.64}"
    )
