"""Time each operator against its literal form on a multiple of the events table.

    python benchmarks/compare_forms.py [copies] [sf_dir]

The copies get their own users and events. With ``skew``, a third of all rows
belongs to one user and a third, chosen independently, to one post. Prints one
JSON line per form: seconds (best of two) and shuffled megabytes, the latter from
Spark's event log.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from datetime import date, timedelta

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchmarks import literal_forms as literal
from daygauge.operators import leaders, overlap, retention
from daygauge.sources import events

POSTS = 200_000
WEEK_AS_OF = date(2024, 1, 29)


def scaled_events(spark: SparkSession, sf_dir: str, copies: int, skew: bool) -> DataFrame:
    table = events.read_events(spark, sf_dir)
    size = table.agg(F.max("user_id") + 1, F.max("event_id") + 1).first()
    scaled = table.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        (F.col("user_id") + F.col("copy") * size[0]).alias("user_id"),
        (F.xxhash64("event_id", "copy") % (copies * size[1])).alias("event_id"),
        "event_type",
        "ts",
    )
    if skew:
        # Independent thirds, so that the hot post still has many users.
        scaled = scaled.withColumns(
            {
                "user_id": F.expr("CASE WHEN pmod(event_id, 3) = 0 THEN 1 ELSE user_id END"),
                "event_id": F.expr("CASE WHEN pmod(event_id, 9) < 3 THEN 0 ELSE event_id END"),
            }
        )
    return scaled.repartitionByRange(64, "ts")


def shuffle_bytes(log_dir: str) -> dict[str, int]:
    """Shuffle bytes written per job description."""
    written: dict[str, int] = {}
    stage_of: dict[int, str] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if not os.path.isfile(path):
            continue
        for line in open(path, encoding="utf-8"):
            if '"SparkListenerJobStart"' in line:
                job = json.loads(line)
                name = (job.get("Properties") or {}).get("spark.job.description")
                stage_of.update({s: name for s in job["Stage IDs"] if name})
            elif '"SparkListenerTaskEnd"' in line:
                task = json.loads(line)
                metrics = task.get("Task Metrics") or {}
                size = (metrics.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                name = stage_of.get(task["Stage ID"])
                if name:
                    written[name] = written.get(name, 0) + size
    return written


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 100
    sf_dir = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    os.makedirs(f"{work}/log")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{work}/log")
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for skew in (False, True):
        name = "skew" if skew else "even"
        path = f"{work}/{name}"
        scaled_events(spark, sf_dir, copies, skew).write.parquet(path)
        table = spark.read.parquet(path)
        f, m = events.feed_from_events(table, POSTS), events.messages_from_events(table, POSTS)
        forms = {
            "cohorts: one aggregate": lambda: retention.cohort_activity(f),
            "cohorts: window": lambda: literal.cohorts_by_window(f),
            "cohorts: join": lambda: literal.cohorts_by_join(f),
            "cohort of a week: bits": lambda: retention.retention_week(f, WEEK_AS_OF),
            "cohort of a week: all cohorts": lambda: retention.cohort_sizes(
                f.where(F.to_date("time") < F.lit(WEEK_AS_OF))
            ).where(F.col("start_date") == F.lit(WEEK_AS_OF - timedelta(days=7))),
            "overlap: stack and group": lambda: overlap.overlap_by_day(f, m),
            "overlap: full join": lambda: literal.overlap_by_join(f, m)
            .groupBy("dt", "use_type")
            .agg(F.count("*").alias("users")),
            "top posts: winners first": lambda: leaders.top_posts(f),
            "top posts: one pass": lambda: literal.top_posts_one_pass(f),
        }
        for form, build in forms.items():
            label = f"{name}: {form}"
            runs = []
            for attempt in range(2):
                spark.sparkContext.setJobDescription(label if attempt else f"warm-up {label}")
                start = time.perf_counter()
                build().write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - start)
            seconds[label] = min(runs)
    spark.stop()
    shuffled = shuffle_bytes(f"{work}/log")
    for label, sec in seconds.items():
        print(json.dumps({"form": label, "sec": round(sec, 2), "shuffle_mb": round(shuffled.get(label, 0) / 1e6, 1)}))


if __name__ == "__main__":
    main()
