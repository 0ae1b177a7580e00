"""Hand-built cases and brute-force checks of every operator."""

from datetime import date, timedelta

import cases
import pytest
from pyspark.sql import functions as F

from benchmarks import literal_forms as literal
from daygauge.operators import activity, daily, leaders, overlap, retention
from daygauge.operators.activity import user_day_activity
from daygauge.plans import report
from daygauge.plans import rollup as ru

D = cases.D


def frames(spark, feed, messages):
    return (
        spark.createDataFrame(feed, cases.FEED_SCHEMA),
        spark.createDataFrame(messages, cases.MESSAGE_SCHEMA),
    )


def tuples(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="module")
def micro(spark):
    return frames(spark, cases.MICRO_FEED, cases.MICRO_MESSAGES)


LOGS = {
    "dense": dict(seed=1, users=12, rows=600, days=20),
    "sparse": dict(seed=2, users=300, rows=700, days=40),
    "hot": dict(seed=3, users=80, rows=3000, days=15, hot=0.4),
}


@pytest.fixture(scope="module", params=LOGS)
def logs(spark, request):
    feed, messages = cases.random_logs(**LOGS[request.param])
    f, m = frames(spark, feed, messages)
    return feed, messages, f.repartition(4), m.repartition(3)


# --- one day ------------------------------------------------------------------


def test_day_metrics(micro):
    feed, messages = micro
    assert daily.dau_day(feed, D).first()[0] == 4
    assert daily.dau_day(messages, D).first()[0] == 3
    assert daily.action_count_day(feed, D, "view").first()[0] == 2
    assert daily.action_count_day(feed, D, "like").first()[0] == 2
    assert daily.ctr_day(feed, D).first()[0] == 100.0
    assert daily.message_count_day(messages, D).first()[0] == 3
    assert overlap.both_users_day(feed, messages, D).first()[0] == 1


def test_empty_day(micro):
    feed, messages = micro
    empty = D + timedelta(days=1)
    assert daily.dau_day(feed, empty).first()[0] == 0
    assert daily.action_count_day(feed, empty, "view").first()[0] == 0
    assert daily.ctr_day(feed, empty).first()[0] is None
    assert daily.message_count_day(messages, empty).first()[0] == 0
    assert overlap.both_users_day(feed, messages, empty).first()[0] == 0


def test_ctr_rounds_ties_to_even(spark):
    rows = [(1, 1, "view", cases.at(D))] * 32 + [(1, 1, "like", cases.at(D))]
    feed = spark.createDataFrame(rows, cases.FEED_SCHEMA)
    assert daily.ctr_day(feed, D).first()[0] == 3.12  # 3.125


def test_day_column_gives_the_same_days(micro):
    feed, _ = micro
    stored = feed.withColumn("dt", F.to_date("time"))
    for operator in (activity.user_active_days, activity.user_start_date, retention.cohort_activity):
        assert sorted(tuples(operator(stored))) == sorted(tuples(operator(feed)))


# --- series -------------------------------------------------------------------


def test_series_window_and_missing_days(micro):
    feed, messages = micro
    as_of = D + timedelta(days=3)
    assert tuples(daily.feed_series(feed, as_of, "views")) == [(D, 2), (D + timedelta(days=2), 1)]
    assert tuples(daily.message_series(messages, as_of, "users")) == [(D, 3)]
    # Both ends of the window are inclusive, today is not part of it.
    assert tuples(daily.feed_series(feed, D + timedelta(days=7), "likes"))[0] == (D, 2)
    assert tuples(daily.feed_series(feed, D + timedelta(days=8), "likes")) == [(D + timedelta(days=2), 0)]
    assert tuples(daily.feed_series(feed, D, "views")) == []


def test_daily_metrics_equal_day_operators(logs):
    _, _, feed, messages = logs
    last = D + timedelta(days=6)
    for row in daily.daily_feed_metrics(feed, D, last).collect():
        assert row.users == daily.dau_day(feed, row.dt).first()[0]
        assert row.views == daily.action_count_day(feed, row.dt, "view").first()[0]
        assert row.ctr_pct == daily.ctr_day(feed, row.dt).first()[0]
    for row in daily.daily_message_metrics(messages, D, last).collect():
        assert row.users == daily.dau_day(messages, row.dt).first()[0]
        assert row.messages == daily.message_count_day(messages, row.dt).first()[0]


# --- overlap ------------------------------------------------------------------


def test_overlap_classes(micro):
    rows = {r for r in tuples(overlap.user_overlap(*micro)) if r[2] == D}
    assert rows == {
        (0, 0, D, "OutOfType"),
        (1, 1, D, "Both"),
        (2, 0, D, "Feed only"),
        (3, 0, D, "Feed only"),
        (0, 4, D, "Messenger only"),
    }


def test_overlap_matches_brute_force_and_join(logs):
    rows, message_rows, feed, messages = logs
    expected = cases.overlap(rows, message_rows)
    ours = tuples(overlap.user_overlap(feed, messages))
    assert len(ours) == len(expected) and set(ours) == expected
    assert set(tuples(literal.overlap_by_join(feed, messages))) == expected
    per_day = overlap.overlap_by_day(feed, messages).where("use_type = 'Both'").collect()
    for row in per_day[:5]:
        assert overlap.both_users_day(feed, messages, row.dt).first()[0] == row.users
        assert literal.both_users_by_intersect(feed, messages, row.dt).first()[0] == row.users
        users = min(daily.dau_day(feed, row.dt).first()[0], daily.dau_day(messages, row.dt).first()[0])
        assert row.users <= users


# --- retention ----------------------------------------------------------------


def test_cohorts_match_brute_force_and_literal_forms(logs):
    rows, _, feed, _ = logs
    columns = ["start_date", "dt", "duration", "users", "first_day_users"]
    expected = cases.cohorts(rows)
    ours = tuples(retention.cohort_activity(feed))
    assert len(ours) == len(expected) and set(ours) == expected
    assert set(tuples(literal.cohorts_by_window(feed).select(columns))) == expected
    assert set(tuples(literal.cohorts_by_join(feed).select(columns))) == expected


@pytest.mark.parametrize("horizon", [1, 2, 3, 10])
def test_cohorts_for_other_horizons(logs, horizon):
    rows, _, feed, _ = logs
    assert set(tuples(retention.cohort_activity(feed, horizon))) == cases.cohorts(rows, horizon)


def test_days_before_1970_have_a_residue_too(spark):
    days = [date(1969, 12, 27) + timedelta(days=k) for k in (0, 2, 6, 7, 9)]
    rows = [(1, 1, "view", cases.at(d)) for d in days]
    feed = spark.createDataFrame(rows, cases.FEED_SCHEMA)
    assert set(tuples(retention.cohort_activity(feed))) == cases.cohorts(rows)


def test_retention_forms_agree(logs):
    _, _, feed, _ = logs
    long = retention.retention_long(feed).collect()
    assert long == sorted(long, key=lambda r: (r.start_date, r.duration))
    assert all(0 < r.retention <= 1 for r in long)
    assert all(r.retention == 1 for r in long if r.duration == 1)
    pivot = {r.start_date: r for r in retention.retention_pivot(feed).collect()}
    cells = {(s, n): r[f"Day {n}"] for s, r in pivot.items() for n in range(1, 8)}
    assert {k: v for k, v in cells.items() if v is not None} == {
        (r.start_date, r.duration): r.retention for r in long
    }
    for start in sorted(pivot)[:2]:
        week = retention.retention_week(feed, start + timedelta(days=7)).collect()
        assert [r.label for r in week] == [f"Day {n}" for n in range(1, 8)]
        for r in week:
            full = cells[start, r.duration]
            assert r.retention == (None if full is None else round(full * 100) / 100)


def test_retention_week_with_a_gap(micro):
    feed, _ = micro
    week = retention.retention_week(feed, D + timedelta(days=7)).collect()
    assert [r.retention for r in week] == [1.0, None, 0.25, None, None, None, None]


def test_retention_week_without_a_cohort(micro):
    feed, _ = micro
    as_of = D + timedelta(days=20)
    assert retention.retention_week(feed, as_of).collect() == []
    assert tuples(retention.retention_week_row(feed, as_of)) == [(None,) * 7]


# --- leaderboards -------------------------------------------------------------


def test_top_posts(micro):
    feed, _ = micro
    assert tuples(leaders.top_posts(feed)) == [(1, 3, 1, 1 / 3, 3), (2, 0, 1, None, 1)]


@pytest.mark.parametrize("k", [1, 7, 100, 10_000])
def test_top_posts_matches_brute_force_and_one_pass(logs, k):
    rows, _, feed, _ = logs
    expected = cases.posts(rows, k)
    assert tuples(leaders.top_posts(feed, k)) == expected
    assert tuples(literal.top_posts_one_pass(feed, k)) == expected


def test_top_posts_takes_rows_without_a_post_as_a_post(spark):
    rows = [(u, p, "view", cases.at(D)) for u, p in ((1, None), (2, None), (2, 7), (3, 7), (3, 8))]
    feed = spark.createDataFrame(rows, cases.FEED_SCHEMA)
    for join in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", join)
        try:
            assert leaders.top_posts(feed, 2).collect() == [(7, 2, 0, 0.0, 2), (None, 2, 0, 0.0, 2)]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_top_posts_uses_the_counts_it_is_given(logs):
    _, _, feed, _ = logs
    post = leaders.top_posts(feed, 1).first()
    counts = leaders.post_counts(feed).withColumn("views", F.expr(f"if(post_id = {post.post_id}, 100000, views)"))
    for k in (1, 50):
        assert leaders.top_posts(feed, k, counts).first()[:2] == (post.post_id, 100_000)


def test_null_ids_and_times_count_the_same_everywhere(spark):
    feed = spark.createDataFrame(cases.NULL_FEED, cases.FEED_SCHEMA)
    messages = spark.createDataFrame(cases.NULL_MESSAGES, cases.MESSAGE_SCHEMA)
    as_of = D + timedelta(days=1)
    assert daily.dau_day(feed, D).first()[0] == 2
    metrics = daily.daily_feed_metrics(feed, D, D).first()
    assert (metrics.actions, metrics.users, metrics.views) == (4, 2, 3)
    kpis = report.daily_kpis(feed, messages, as_of).first()
    assert (kpis.feed_dau, kpis.messenger_dau, kpis.views, kpis.messages) == (2, 1, 3, 3)
    assert leaders.top_by_count(feed, "user_id", "n").collect() == [(1, 3), (2, 1), (None, 0)]
    assert leaders.top_by_count(messages, "receiver_id", "n").collect() == [(5, 2), (None, 0)]
    users = user_day_activity(feed, messages).where("dt IS NOT NULL")
    assert ru.rolled_feed_metrics(users, D, D).first().users == 2
    assert ru.rolled_message_metrics(users, D, D).first().users == 1
    assert ru.rolled_top(users, "user_id", "messages", "n").collect() == [(1, 1), (None, 0)]
    rows = sorted(tuples(overlap.user_overlap(feed, messages).where("dt IS NOT NULL")))
    assert rows == [(0, 0, D, "OutOfType"), (1, 1, D, "Both"), (2, 0, D, "Feed only")]
    assert tuples(retention.cohort_activity(feed)) == [(D, D, 1, 2, 2)]
    assert [tuple(r)[0] for r in retention.retention_pivot(feed).collect()] == [D]


@pytest.mark.parametrize("horizon", [1, 3, 7, 40, 62, 63])
def test_the_known_cohort_equals_all_cohorts(logs, horizon):
    rows, _, feed, _ = logs
    for start in (D, D + timedelta(days=1), D + timedelta(days=3)):
        as_of = start + timedelta(days=horizon)
        full = retention.cohort_sizes(feed, horizon).where(F.col("start_date") == F.lit(start))
        assert tuples(retention._week_cohort(feed, as_of, horizon)) == tuples(full)


@pytest.mark.parametrize("k", [3, 100])
def test_top_by_count(logs, k):
    rows, message_rows, feed, messages = logs
    assert tuples(leaders.top_by_count(feed, "user_id", "actions", k)) == cases.top([r[0] for r in rows], k)
    assert tuples(leaders.top_by_count(messages, "user_id", "sent", k)) == cases.top([r[0] for r in message_rows], k)
    assert tuples(leaders.top_by_count(messages, "receiver_id", "received", k)) == cases.top(
        [r[1] for r in message_rows], k
    )


def test_ties_at_the_last_place_go_to_the_lower_id(spark):
    rows = [(u, 1, cases.at(D)) for u in (5, 3, 9, 4)] + [(7, 1, cases.at(D))] * 2
    messages = spark.createDataFrame(rows, cases.MESSAGE_SCHEMA)
    assert tuples(leaders.top_by_count(messages, "user_id", "sent", 3)) == [(7, 2), (3, 1), (4, 1)]
