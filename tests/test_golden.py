"""Known values of the driver's tables."""

from datetime import date

import pytest

import __spark_entry__ as entry
from daygauge.operators import daily, leaders, overlap, retention
from daygauge.sources import events

DAY = date(2024, 1, 30)
AS_OF = date(2024, 1, 31)
SCALES = ("sf0.001", "sf0.01", "sf0.1")


@pytest.fixture(scope="module", params=range(3), ids=SCALES)
def scale(spark, request):
    table = events.read_events(spark, f"/root/testdata/{SCALES[request.param]}")
    return request.param, events.feed_from_events(table), events.messages_from_events(table)


def test_day_kpis(scale):
    i, feed, messages = scale
    assert daily.dau_day(feed, DAY).first()[0] == (12, 110, 1125)[i]
    assert daily.dau_day(messages, DAY).first()[0] == (10, 86, 902)[i]
    assert daily.action_count_day(feed, DAY, "view").first()[0] == (9, 73, 698)[i]
    assert daily.action_count_day(feed, DAY, "like").first()[0] == (7, 63, 653)[i]
    assert daily.ctr_day(feed, DAY).first()[0] == (77.78, 86.3, 93.55)[i]
    assert daily.message_count_day(messages, DAY).first()[0] == (17, 129, 1365)[i]
    assert overlap.both_users_day(feed, messages, DAY).first()[0] == (7, 62, 682)[i]


def test_overlap_totals(scale):
    i, feed, messages = scale
    rows = overlap.user_overlap(feed, messages).groupBy("use_type").count().collect()
    assert {r.use_type: r["count"] for r in rows} == dict(
        zip(
            ("Both", "Feed only", "Messenger only", "OutOfType"),
            ((182, 122, 67, 26), (1925, 1344, 715, 22), (19624, 13380, 7050, 29))[i],
        )
    )
    assert overlap.overlap_by_day(feed, messages).count() == (112, 112, 119)[i]


def test_retention(scale):
    i, feed, _ = scale
    assert retention.retention_long(feed).count() == (13, 33, 46)[i]
    first = retention.cohort_activity(feed).where("start_date = date'2024-01-01' AND duration = 1").first()
    assert first.users == first.first_day_users == (13, 117, 1072)[i]
    week = [r.retention for r in retention.retention_week(feed, date(2024, 1, 8)).orderBy("duration").collect()]
    assert week == (
        [1.0, 0.62, 0.77, 0.62, 0.62, 0.85, 0.69],
        [1.0, 0.74, 0.70, 0.75, 0.76, 0.69, 0.64],
        [1.0, 0.72, 0.72, 0.71, 0.75, 0.74, 0.75],
    )[i]


def test_leaderboards(scale):
    i, feed, messages = scale

    def ends(df):
        rows = df.collect()
        return rows[0][0], rows[0][1], rows[-1][1], len(rows)

    assert ends(leaders.top_posts(feed)) == ((8, 2, 1, 100), (73, 11, 6, 100), (341, 72, 54, 100))[i]
    assert ends(leaders.top_by_count(messages, "user_id", "n")) == (
        (10, 36, 21, 15), (41, 43, 24, 100), (342, 46, 34, 100)
    )[i]
    assert ends(leaders.top_by_count(messages, "receiver_id", "n")) == (
        (34, 3, 2, 100), (69, 17, 12, 100), (381, 125, 107, 100)
    )[i]
    assert ends(leaders.top_by_count(feed, "user_id", "n")) == (
        (14, 58, 29, 15), (17, 58, 37, 100), (507, 65, 49, 100)
    )[i]


def test_series(spark):
    sf_dir = "/root/testdata/sf0.01"
    series = {
        "views_series": [66, 73, 79, 60, 66, 73, 73],
        "likes_series": [77, 58, 62, 76, 67, 68, 63],
        "ctr_series": [116.67, 79.45, 78.48, 126.67, 101.52, 93.15, 86.3],
        "feed_dau_series": [114, 115, 110, 114, 110, 111, 110],
        "messages_series": [123, 142, 126, 123, 122, 141, 129],
        "messenger_dau_series": [83, 97, 84, 84, 87, 93, 86],
    }
    for name, values in series.items():
        rows = entry.queries()[name](spark, sf_dir).collect()
        assert [r.dt for r in rows] == [date(2024, 1, 24 + k) for k in range(7)]
        assert [r[1] for r in rows] == values
