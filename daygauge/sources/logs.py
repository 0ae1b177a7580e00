"""Scans of the two action logs, and SQL text over them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygauge.functions.columns import day, on_day

# Column -> kinds of type accepted for it. Ids are read as bigint. Ids and times may be NULL: such
# rows count as actions; distinct counts skip a NULL user, leaderboards give it 0, overlap reads it
# as user 0, a cohort needs a user and a day, and a row without a time belongs to no day.
_ID = T.IntegralType
_TIME = (T.TimestampNTZType, T.TimestampType)
FEED_CONTRACT = {"user_id": _ID, "post_id": _ID, "action": T.StringType, "time": _TIME}
MESSAGE_CONTRACT = {"user_id": _ID, "receiver_id": _ID, "time": _TIME}


def conform(df: DataFrame, contract: dict) -> DataFrame:
    """Check ``df`` against ``contract`` and widen its ids.

    Columns outside the contract pass through; operators that do not use them
    never read them.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{name}: {types[name].simpleString() if name in types else 'missing'}"
        for name, kind in contract.items()
        if not isinstance(types.get(name), kind)
    ]
    if "dt" in types and not isinstance(types["dt"], T.DateType):
        wrong.append(f"dt: {types['dt'].simpleString()}")
    if wrong:
        raise ValueError("log does not match its contract: " + ", ".join(wrong))
    narrow = [
        name for name, kind in contract.items() if kind is _ID and not isinstance(types[name], T.LongType)
    ]
    return df.withColumns({name: F.col(name).cast("bigint") for name in narrow}) if narrow else df


def _scan(spark: SparkSession, path: str | None, table: str | None) -> DataFrame:
    if (path is None) == (table is None):
        raise ValueError("give either a parquet path or a catalog table")
    return spark.read.parquet(path) if path else spark.table(table)


def feed_actions(spark: SparkSession, path: str | None = None, *, table: str | None = None) -> DataFrame:
    """The feed log: who (``user_id``) did what (``action``) to which post, and when.

    ``table`` is any catalog name (``db.table``); a remote database is reached
    the same way, through a catalog configured for it.
    """
    return conform(_scan(spark, path, table), FEED_CONTRACT)


def message_actions(spark: SparkSession, path: str | None = None, *, table: str | None = None) -> DataFrame:
    """The message log: sender (``user_id``), ``receiver_id``, ``time``."""
    # Fixed value: a spelling of the column that logs may have.
    df = _scan(spark, path, table).withColumnRenamed("reciever_id", "receiver_id")
    return conform(df, MESSAGE_CONTRACT)


# The kinds of feed action that any metric counts by name.
COUNTED_ACTIONS = ("view", "like")


def scan_metrics(
    log: DataFrame, name: str, first: date | None = None, last: date | None = None
) -> tuple[DataFrame, Observation]:
    """The log, and counts of what the next action on it sees, taken in the same scan.

    ``rows``, ``null_users``, ``null_targets`` (posts or receivers), ``null_times``, ``other_actions``
    (neither view nor like, NULL included; 0 in the message log), and ``outside`` (rows of days before
    ``first`` or after ``last``). The counts are in the observation once an action on the log is done.
    Filters that come after are not pushed below the counts: put those that belong to the scan before.
    """
    target = "post_id" if "post_id" in log.columns else "receiver_id"
    dt, none = day(log), F.lit(False)
    outside = (dt < F.lit(first) if first else none) | (dt > F.lit(last) if last else none)
    other = ~F.coalesce(F.col("action").isin(*COUNTED_ACTIONS), none) if "action" in log.columns else none
    seen = Observation(name)
    flags = {
        "null_users": F.col("user_id").isNull(),
        "null_targets": F.col(target).isNull(),
        "null_times": F.col("time").isNull(),
        "other_actions": other,
        "outside": F.coalesce(outside, none),
    }
    counts = [F.count(F.lit(1)).alias("rows"), *(F.count_if(flag).alias(c) for c, flag in flags.items())]
    return log.observe(seen, *counts), seen


def preview_day(actions: DataFrame, d: date, n: int = 10, ordered: bool = True) -> DataFrame:
    """``n`` rows of one day, all columns: the first by the columns of the contract,
    or with ``ordered=False`` any ``n``, which stops reading as soon as it has them.
    """
    rows = on_day(actions, d)
    if ordered:
        contract = ("time", "user_id", "post_id", "receiver_id", "action")
        rows = rows.orderBy(*(c for c in contract if c in actions.columns))
    return rows.limit(n)


def sql_frame(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """SQL text to DataFrame. ``{name}`` in the text stands for the table given as ``name``."""
    return spark.sql(text, **tables)
