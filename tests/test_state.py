"""The running state against the logs, whatever happens to the days; publication; scan metrics; dense series."""

import glob
import random
import re
from datetime import date, timedelta

import cases
import pytest
from cases import D
from pyspark.sql import functions as F

from daygauge.operators import daily, leaders, retention
from daygauge.plans import daily_report, report, state
from daygauge.plans import rollup as ru
from daygauge.sources import logs as sources
from daygauge.sources import sinks

NAMES = ("report.txt", "charts.csv", *daily_report.HEADINGS)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frames(spark, rows, message_rows):
    return spark.createDataFrame(rows, cases.FEED_SCHEMA), spark.createDataFrame(message_rows, cases.MESSAGE_SCHEMA)


def hot_logs(seed, rows=300):
    """Days of three words, 40 % of the rows of one user and post, NULL and negative ids."""
    feed, messages = cases.random_logs(seed=seed, users=40, rows=rows, days=16, hot=0.4)
    apart = lambda t: t + 8 * (t.date() - D)
    feed, messages = [(*r[:3], apart(r[3])) for r in feed], [(*r[:2], apart(r[2])) for r in messages]
    rng = random.Random(seed)
    other = lambda x: rng.choice([x, x, x, x, -x, x * 40_000, -x * 40_000, None])
    feed = [(other(u), other(p), a, t) for u, p, a, t in feed]
    return feed, [(other(u), other(r), t) for u, r, t in messages]


def state_equals_logs(spark, path, feed, messages, as_of):
    feed, messages = (log.where(F.to_date("time") <= F.lit(as_of)) for log in (feed, messages))
    totals = lambda name: state.read_totals(spark, path, name, as_of)
    users = totals("user_totals")
    same = [
        state.running_top(users, "user_id", "feed_actions", "n").collect() == leaders.top_by_count(feed, "user_id", "n").collect(),
        state.running_top(users, "user_id", "messages", "n").collect() == leaders.top_by_count(messages, "user_id", "n").collect(),
        state.running_top(totals("receiver_totals"), "receiver_id", "messages", "n").collect()
        == leaders.top_by_count(messages, "receiver_id", "n").collect(),
    ]
    posts = state.running_top_posts(totals("post_totals"), ru.read_days(spark, path, ru.POST_USERS, as_of), 20)
    same.append(posts.collect() == leaders.top_posts(feed, 20).collect())
    words = state._until(state.read_words(spark, path), as_of)
    same.append(tuples(retention.activity_of_sizes(state.cohort_sizes(words))) == tuples(retention.cohort_activity(feed)))
    same.append(tuples(state.active_days(words)) == tuples(feed.where("user_id IS NOT NULL AND time IS NOT NULL").selectExpr("user_id", "to_date(time) AS dt").distinct()))
    firsts = feed.where("user_id IS NOT NULL AND time IS NOT NULL")
    same.append(tuples(state.first_days(words)) == tuples(firsts.groupBy("user_id").agg(F.min(F.to_date("time")))))
    return same


def test_state_follows_late_changed_emptied_and_refolded_days(spark, tmp_path):
    rows, message_rows = hot_logs(1)
    path, end = str(tmp_path / "rollup"), D + timedelta(days=200)

    def extended(rows, message_rows, as_of=end, **more):
        feed, messages = frames(spark, rows, message_rows)
        found = ru.extend_rollup(feed, messages, path, as_of, by_content=True, running=True, **more)
        same = state_equals_logs(spark, path, feed, messages, as_of)
        assert all(same), same
        return found.days

    day = lambda k: D + timedelta(days=k)
    half = sorted({t.date() for *_, t in rows})[9]
    extended([r for r in rows if r[3].date() <= half], [r for r in message_rows if r[2].date() <= half], half)
    extended(rows, message_rows)
    assert extended(rows, message_rows) == set()
    # An older day than any, late rows, and as many rows as before but another one.
    late = [*rows, (7, 9, "like", cases.at(day(-100))), (None, None, "view", cases.at(day(70)))]
    assert extended(late, message_rows) == {day(-100), day(70)}
    at = next(k for k, r in enumerate(late) if r[3].date() == half)
    changed = [*late[:at], (12345, *late[at][1:]), *late[at + 1 :]]
    assert extended(changed, message_rows) == {half}
    # The first day of all users vanishes, and a whole word of days does.
    first = min(t.date() for *_, t in changed)
    gone = [r for r in changed if r[3].date() != first and state.word_of(r[3].date()) != state.word_of(day(70))]
    fewer = [r for r in message_rows if state.word_of(r[2].date()) != state.word_of(day(70))]
    extended(gone, fewer)
    extended(gone, fewer, refold=(day(0), day(10)))
    # Back again, and seen from a date before the last day.
    extended(changed, message_rows)
    feed, messages = frames(spark, changed, message_rows)
    assert all(state_equals_logs(spark, path, feed, messages, half + timedelta(days=3)))
    extended([], [])


def test_one_changed_action_in_an_old_day_of_files(spark, tmp_path, monkeypatch):
    """Of a log partitioned by day, contents are read only of days whose files are new."""
    rows, message_rows = cases.random_logs(seed=3, users=20, rows=300, days=6)
    path, place = str(tmp_path / "rollup"), str(tmp_path / "feed")
    messages = spark.createDataFrame(message_rows, cases.MESSAGE_SCHEMA)

    def write(rows, mode):
        feed = spark.createDataFrame(rows, cases.FEED_SCHEMA).withColumn("dt", F.to_date("time"))
        feed.coalesce(1).write.option("partitionOverwriteMode", "dynamic").mode(mode).partitionBy("dt").parquet(place)

    asked = []
    contents = ru._contents
    monkeypatch.setattr(ru, "_contents", lambda log, name, days: asked.append((name, days)) or contents(log, name, days))

    def extend():
        asked.clear()
        days = ru.extend_rollup(sources.feed_actions(spark, place), messages, path, D + timedelta(days=9), by_content=True, running=True).days
        return days, dict(asked)["feed"]

    write(rows, "overwrite")
    everything = {t.date() for *_, t in rows}
    assert extend() == (everything | {t.date() for *_, t in message_rows}, everything)
    assert extend() == (set(), set())
    old = D + timedelta(days=1)
    write([r for r in rows if r[3].date() == old], "overwrite")  # the same rows in a new file
    assert extend() == (set(), {old})
    assert extend() == (set(), set())
    own = [r for r in rows if r[3].date() == old]
    write([(own[0][0], own[0][1], "like" if own[0][2] == "view" else "view", own[0][3]), *own[1:]], "overwrite")
    assert extend() == ({old}, {old})
    feed = sources.feed_actions(spark, place)
    assert all(state_equals_logs(spark, path, feed, messages, D + timedelta(days=9)))


@pytest.mark.parametrize("breaks_at", range(6))
def test_a_broken_run_is_made_good(spark, tmp_path, monkeypatch, breaks_at):
    rows, message_rows = hot_logs(2, rows=100)
    path, end = str(tmp_path / "rollup"), D + timedelta(days=200)
    cut = sorted({t.date() for *_, t in rows})[5]
    extend = lambda feed, messages: ru.extend_rollup(feed, messages, path, end, by_content=True, running=True)
    extend(*frames(spark, [r for r in rows if r[3].date() != cut], message_rows))
    calls, real = [], {name: getattr(ru, name) for name in ("write_days", "_record")}

    def broken(name):
        def run(*args):
            calls.append(name)
            if len(calls) == steps[breaks_at]:
                raise RuntimeError("broken")
            return real[name](*args)

        return run

    steps = (1, 4, 5, 6, 8, 10)  # 4 staged tables, a record, 4 tables, a record
    for name in real:
        monkeypatch.setattr(ru, name, broken(name))
    late = [*rows, (99, 99, "view", cases.at(D + timedelta(days=95)))]
    feed, messages = frames(spark, late, message_rows)
    with pytest.raises(RuntimeError, match="broken"):
        extend(feed, messages)
    for name, run in real.items():
        monkeypatch.setattr(ru, name, run)
    extend(feed, messages)
    assert all(state_equals_logs(spark, path, feed, messages, end))


def test_folding_without_the_state_leaves_it_behind_and_is_noticed(spark, tmp_path):
    rows, message_rows = hot_logs(4, rows=100)
    feed, messages = frames(spark, rows, message_rows)
    path, end = str(tmp_path / "rollup"), D + timedelta(days=200)
    ru.extend_rollup(feed, messages, path, end)
    with pytest.raises(ValueError, match="behind"):
        state.read_totals(spark, path, "user_totals")
    ru.extend_rollup(feed, messages, path, end, running=True)
    assert all(state_equals_logs(spark, path, feed, messages, end))
    ru.fold_days(feed, messages, path, D, D)
    with pytest.raises(ValueError, match="behind"):
        state.read_words(spark, path)
    ru.extend_rollup(feed, messages, path, end, running=True)
    assert all(state_equals_logs(spark, path, feed, messages, end))


def test_leaderboards_read_totals_and_changed_days_only(spark, tmp_path):
    rows, message_rows = hot_logs(5, rows=100)
    feed, messages = frames(spark, rows, message_rows)
    path = str(tmp_path / "rollup")
    ru.extend_rollup(feed, messages, path, D + timedelta(days=200), running=True)
    top = state.running_top(state.read_totals(spark, path, "user_totals"), "user_id", "messages", "sent")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Aggregate" not in plan
    assert "user_totals" in top.inputFiles()[0]
    as_of = D + timedelta(days=120)
    top = state.running_top(state.read_totals(spark, path, "user_totals", as_of), "user_id", "messages", "sent")
    days = ru.folded(spark, path)
    days_read = re.findall(r"PartitionFilters: \[(.*?)\]", top._jdf.queryExecution().executedPlan().toString())
    assert any(dt > as_of for dt in days) and len(days_read) == 2 and days_read[0] == ""
    assert all((str(dt) in days_read[1]) == (dt > as_of) for dt in days)
    posts = state.running_top_posts(state.read_totals(spark, path, "post_totals"), ru.read_days(spark, path, ru.POST_USERS))
    assert {f.split("rollup/")[1].split("/")[0] for f in posts.inputFiles()} == {"post_totals", "post_user_days"}


# --- publication --------------------------------------------------------------


def test_a_report_broken_between_files_leaves_the_old_one(spark, tmp_path, monkeypatch):
    rows, message_rows = cases.random_logs(seed=6, users=20, rows=300, days=6)
    feed, messages = frames(spark, rows, message_rows)
    out = str(tmp_path / "out")
    assert sinks.published(spark, out) is None
    old = daily_report.publish_daily_report(feed, messages, D + timedelta(days=4), out)
    assert sinks.published(spark, out) == old
    calls, export = [], daily_report.export_ranked_csv

    def breaking(*args):
        calls.append(args)
        if len(calls) == 3:
            raise RuntimeError("broken")
        export(*args)

    monkeypatch.setattr(daily_report, "export_ranked_csv", breaking)
    with pytest.raises(RuntimeError, match="broken"):
        daily_report.publish_daily_report(feed, messages, D + timedelta(days=5), out)
    assert sinks.published(spark, out) == old
    assert all(glob.glob(f"{old}/{name}/part-*") for name in NAMES)
    monkeypatch.setattr(daily_report, "export_ranked_csv", export)
    new = daily_report.publish_daily_report(feed, messages, D + timedelta(days=5), out, str(tmp_path / "rollup"))
    assert sinks.published(spark, out) == new != old and sinks.published(spark, out, D + timedelta(days=4)) == old
    again = daily_report.publish_daily_report(feed, messages, D + timedelta(days=4), out, str(tmp_path / "rollup"))
    assert sinks.published(spark, out, D + timedelta(days=4)) == again
    for name in NAMES:
        texts = [spark.read.text(f"{folder}/{name}").collect() for folder in (old, again)]
        assert texts[0] == texts[1]


# --- scan metrics -------------------------------------------------------------


def test_scan_metrics_are_counted_in_the_one_scan(spark):
    feed, messages = frames(spark, cases.NULL_FEED + [(1, 1, None, cases.at(D)), (1, 1, "share", cases.at(D + timedelta(days=3)))], cases.NULL_MESSAGES)
    counted, seen = sources.scan_metrics(feed, "feed-metrics", D - timedelta(days=1), D + timedelta(days=2))
    metrics = daily.daily_feed_metrics(counted, D, D)
    assert tuples(metrics) == tuples(daily.daily_feed_metrics(feed, D, D))
    assert seen.get == {"rows": 7, "null_users": 1, "null_targets": 1, "null_times": 1, "other_actions": 2, "outside": 1}
    text = metrics._jdf.queryExecution().executedPlan().toString()
    assert text.count("CollectMetrics") >= 1
    counted, seen = sources.scan_metrics(messages, "message-metrics")
    counted.count()
    assert seen.get == {"rows": 3, "null_users": 2, "null_targets": 1, "null_times": 0, "other_actions": 0, "outside": 0}


def test_the_job_returns_what_it_has_seen(spark, tmp_path):
    feed, messages = frames(spark, cases.NULL_FEED, cases.NULL_MESSAGES)
    as_of = D + timedelta(days=1)
    seen = daily_report.write_daily_report(feed, messages, as_of, str(tmp_path / "a"))
    assert seen["feed"]["rows"] == 4 and seen["feed"]["null_users"] == 1 and seen["message"]["null_users"] == 2
    rolled = daily_report.write_daily_report(feed, messages, as_of, str(tmp_path / "b"), str(tmp_path / "rollup"))
    assert rolled == seen
    assert daily_report.write_daily_report(feed, messages, as_of, str(tmp_path / "b"), str(tmp_path / "rollup")) == {}


# --- dense series -------------------------------------------------------------


def test_dense_series_have_every_day(spark):
    feed, messages = frames(spark, cases.MICRO_FEED, cases.MICRO_MESSAGES)
    as_of = D + timedelta(days=4)
    days = [as_of - timedelta(days=k) for k in range(7, 0, -1)]
    views = {D: 2, D + timedelta(days=2): 1}
    found = daily.feed_series(feed, as_of, "views", dense=True).collect()
    assert [tuple(r) for r in found] == [(d, views.get(d, 0)) for d in days]
    assert len(daily.feed_series(feed, as_of, "views").collect()) == 2
    ratios = {r.dt: r.ctr_pct for r in daily.feed_series(feed, as_of, "ctr_pct", dense=True).collect()}
    assert list(ratios) == days and [d for d in days if ratios[d] is not None] == [D, D + timedelta(days=2)]
    assert [r.users for r in daily.message_series(messages, as_of, "users", dense=True).collect()] == [0, 0, 0, 3, 0, 0, 0]
    window = (days[0], days[-1])
    charts = report.chart_tables(daily.daily_feed_metrics(feed, *window), daily.daily_message_metrics(messages, *window), as_of, dense=True)
    assert charts.count() == 6 * 7 and charts.where("value IS NULL").count() == 5
    empty = daily.feed_series(feed.limit(0), as_of, "users", dense=True)
    assert [r.users for r in empty.collect()] == [0] * 7
