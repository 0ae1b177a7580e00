"""Sources, sinks, the clock and SQL text."""

import glob
from datetime import date, datetime, timezone

import cases
import pytest
from pyspark.sql import functions as F

from daygauge.functions import clock
from daygauge.functions.columns import number_text, round2
from daygauge.operators import daily, leaders
from daygauge.sources import logs, sinks

D = cases.D


@pytest.fixture(scope="module")
def micro(spark):
    return (
        spark.createDataFrame(cases.MICRO_FEED, cases.FEED_SCHEMA),
        spark.createDataFrame(cases.MICRO_MESSAGES, cases.MESSAGE_SCHEMA),
    )


def test_parquet_logs(spark, tmp_path, micro):
    feed, messages = micro
    narrow = feed.withColumn("user_id", F.col("user_id").cast("int")).withColumn("os", F.lit("x"))
    narrow.write.parquet(str(tmp_path / "feed"))
    messages.withColumnRenamed("receiver_id", "reciever_id").write.parquet(str(tmp_path / "messages"))
    read = logs.feed_actions(spark, str(tmp_path / "feed"))
    assert dict(read.dtypes)["user_id"] == "bigint" and "os" in read.columns
    assert daily.dau_day(read, D).first()[0] == 4
    sent = logs.message_actions(spark, str(tmp_path / "messages"))
    assert leaders.top_by_count(sent, "receiver_id", "received").first()[0] == 5


def test_catalog_tables_and_sql_text(spark, micro):
    feed, _ = micro
    spark.sql("CREATE DATABASE IF NOT EXISTS app")
    feed.write.mode("overwrite").saveAsTable("app.feed_actions")
    read = logs.feed_actions(spark, table="app.feed_actions")
    assert daily.action_count_day(read, D, "view").first()[0] == 2
    by_name = "SELECT count(DISTINCT user_id) AS users FROM app.feed_actions"
    by_frame = "SELECT count(DISTINCT user_id) AS users FROM {feed}"
    assert logs.sql_frame(spark, by_name).first()[0] == 4
    assert logs.sql_frame(spark, by_frame, feed=feed).first()[0] == 4
    spark.sql("DROP DATABASE app CASCADE")


def test_a_log_that_breaks_its_contract_is_refused(spark, micro):
    feed, _ = micro
    with pytest.raises(ValueError, match="post_id: missing"):
        logs.conform(feed.drop("post_id"), logs.FEED_CONTRACT)
    with pytest.raises(ValueError, match="time: string"):
        logs.conform(feed.withColumn("time", F.col("time").cast("string")), logs.FEED_CONTRACT)
    with pytest.raises(ValueError, match="dt: string"):
        logs.conform(feed.withColumn("dt", F.lit("2024-03-10")), logs.FEED_CONTRACT)
    with pytest.raises(ValueError, match="either"):
        logs.feed_actions(spark)


def test_preview(micro, capsys):
    feed, _ = micro
    rows = logs.preview_day(feed, D, 3).collect()
    assert [r.time.hour for r in rows] == [0, 10, 12] and rows[0].asDict().keys() == set(feed.columns)
    assert logs.preview_day(feed, D, 3, ordered=False).count() == 3
    sinks.show_head(logs.preview_day(feed, D))
    assert "user_id" in capsys.readouterr().out


def test_ranked_csv(spark, tmp_path, micro):
    feed, _ = micro
    path = str(tmp_path / "posts.csv")
    order = leaders.leader_order("views", "post_id")
    sinks.export_ranked_csv(leaders.top_posts(feed), path, order, {"views": "Views"})
    (file,) = glob.glob(f"{path}/part-*.csv")
    lines = open(file, encoding="utf-8").read().splitlines()
    assert lines[0] == ",post_id,Views,likes,ctr,users"
    assert lines[1].startswith("0,1,3,1,0.333") and lines[2] == "1,2,0,1,,1"


def test_instants_fall_on_the_day_of_the_session_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    text = "SELECT 1L AS user_id, 1L AS post_id, 'view' AS action, timestamp'2024-03-09 22:30:00 UTC' AS time"
    try:
        for zone, views in (("UTC", 0), ("Europe/Moscow", 1)):
            spark.conf.set("spark.sql.session.timeZone", zone)
            feed = logs.conform(spark.sql(text), logs.FEED_CONTRACT)
            assert daily.action_count_day(feed, D, "view").first()[0] == views
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_clock():
    late = datetime(2024, 1, 30, 22, 30, tzinfo=timezone.utc)
    assert clock.today("UTC", late) == date(2024, 1, 30)
    assert clock.today("Europe/Moscow", late) == date(2024, 1, 31)
    assert clock.last_days(date(2024, 3, 3)) == (date(2024, 2, 25), date(2024, 3, 2))
    assert clock.range_label(date(2024, 1, 31)) == "24-01-2024 - 30-01-2024"


def test_numbers(spark):
    values = [(1.0, "1.0"), (0.62, "0.62"), (86.3, "86.3"), (12345678.5, "12345678.5"), (None, "nan")]
    df = spark.createDataFrame(values, "x double, text string")
    assert [r[0] for r in df.selectExpr(number_text("x")).collect()] == [t for _, t in values]
    halves = spark.createDataFrame([(3.125, 3.12), (0.575, 0.57), (0.375, 0.38)], "x double, y double")
    assert [r[0] for r in halves.selectExpr(round2("x")).collect()] == [3.12, 0.57, 0.38]
