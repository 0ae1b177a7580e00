"""Running state of the whole history, moved on by the days that changed.

*Totals* hold one row per user, post or receiver: the sums over all folded days, and the number of
days that it has rows on. A day that is folded again is subtracted as it was and added as it is,
so a total goes down as well as up, and a row without days goes.

*Words* hold one row per user and 63 days: the days with feed actions as the bits of a number. The
first day of a user is the least bit of the least word; if that day vanishes the bit does, and the
next one is the first. 63 is a multiple of 7, so a bit's place tells its residue modulo 7, and the
first week's activity is read off the words without knowing the first day beforehand.

Every change writes a new version beside the old one: all totals, and the words of the 63 days that
have changed days. The table of folded days names the versions that belong together.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygauge.functions.clock import WEEK
from daygauge.functions.columns import exprs, ratio
from daygauge.operators.leaders import TOP, leader_order
from daygauge.plans import rollup as ru
from daygauge.sources.sinks import remove_path

# Days in a word: a multiple of 7 that leaves the sign of a bigint alone.
WORD_DAYS = 63
WORDS = "user_words"
WORDS_SCHEMA = "user_id bigint, bits bigint, word int, version bigint"
EPOCH = date(1970, 1, 1).toordinal()
# Name of the totals -> table of days, id, and the numbers that are summed.
TOTALS = {
    "user_totals": (ru.USERS, "user_id", ("feed_actions", "messages")),
    "post_totals": (ru.POSTS, "post_id", ("views", "likes")),
    "receiver_totals": (ru.RECEIVERS, "receiver_id", ("messages",)),
}


def word_of(dt: date) -> int:
    return (dt.toordinal() - EPOCH) // WORD_DAYS


def _schema(name: str) -> str:
    _, id_col, numbers = TOTALS[name]
    return ", ".join(f"{c} bigint" for c in (id_col, *numbers, "days"))


def _rows(spark: SparkSession, path: str, table: str, days: set[date] | list[date]) -> DataFrame:
    """Rows of a table of days, of the given days only."""
    if not days:
        return spark.createDataFrame([], ru.SCHEMAS[table])
    chosen = [F.lit(dt) for dt in sorted(days)]
    return spark.read.schema(ru.SCHEMAS[table]).parquet(f"{path}/{table}").where(F.col("dt").isin(*chosen))


def _days_of(days: ru.Days, table: str) -> set[date]:
    """The days on which a table has rows."""
    feed, messages = table != ru.RECEIVERS, table != ru.POSTS
    return {dt for dt, row in days.items() if feed and row["feed_rows"] or messages and row["message_rows"]}


def _signed(rows: DataFrame, name: str, sign: int) -> DataFrame:
    _, id_col, numbers = TOTALS[name]
    return rows.select(id_col, *((F.col(c) * sign).alias(c) for c in numbers), F.lit(sign).cast("bigint").alias("days"))


def _summed(rows: DataFrame, name: str) -> DataFrame:
    _, id_col, numbers = TOTALS[name]
    sums = rows.groupBy(id_col).agg(*exprs(*(f"sum({c}) AS {c}" for c in (*numbers, "days"))))
    return sums.where("days <> 0")


def word_bits(feed_days: DataFrame) -> DataFrame:
    """(user_id, word, bits) of rows that have a user and a day."""
    number = F.unix_date("dt")
    return (
        feed_days.where("user_id IS NOT NULL AND dt IS NOT NULL")
        .groupBy("user_id", F.floor(number / WORD_DAYS).cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, pmod(unix_date(dt), {WORD_DAYS}))")).alias("bits"))
    )


@dataclass
class Advance:
    """What a change has written, and what the folded days say before and after it."""

    version: int
    words: set[int]
    clean: Callable[[], None]

    def open(self, dt: date) -> dict:
        return {"totals": None, **({"words": None} if word_of(dt) in self.words else {})}

    def done(self, dt: date) -> dict:
        return {"totals": self.version, **({"words": self.version} if word_of(dt) in self.words else {})}


def advance(
    spark: SparkSession, path: str, staged: str, known: ru.Days, changed: set[date], there: list[date]
) -> Advance:
    """Write the next version: without the ``changed`` days as they were, with those ``there`` as staged."""
    versions = {v for row in known.values() for v in (row["totals"], row["words"]) if v is not None}
    version = max(versions, default=0) + 1
    standing = {dt: row for dt, row in known.items() if dt not in changed}
    gone = {dt: row for dt, row in known.items() if dt in changed}
    totals = {row["totals"] for row in known.values()}
    for name, (table, *_) in TOTALS.items():
        added = _signed(_rows(spark, staged, table, there), name, 1)
        if None in totals or not totals:  # made from the tables
            before = _signed(_rows(spark, path, table, _days_of(standing, table)), name, 1)
        else:
            (last,) = totals
            before = spark.read.schema(_schema(name)).parquet(f"{path}/{name}/version={last}")
            before = before.unionByName(_signed(_rows(spark, path, table, _days_of(gone, table)), name, -1))
        _summed(before.unionByName(added), name).write.mode("overwrite").parquet(f"{path}/{name}/version={version}")

    lost = {word_of(dt) for dt, row in known.items() if row["words"] is None}
    words = {word_of(dt) for dt in changed} | lost
    added = word_bits(ru.feed_days(_rows(spark, staged, ru.USERS, there)))
    again = {dt for dt in standing if word_of(dt) in lost}
    added = added.unionByName(word_bits(ru.feed_days(_rows(spark, path, ru.USERS, again))))
    kept = read_words(spark, path, {dt: row for dt, row in known.items() if word_of(dt) in words - lost})
    kept = kept.withColumn("bits", F.expr(f"bits & {_kept_bits(changed)}")).where("bits <> 0")
    merged = kept.unionByName(added).groupBy("user_id", "word").agg(F.bit_or("bits").alias("bits"))
    place = f"{path}/{WORDS}"
    for word in words:  # a broken run may have left this version
        remove_path(spark, f"{place}/word={word}/version={version}")
    if words:
        rows = merged.withColumn("version", F.lit(version).cast("bigint"))
        rows.hint("rebalance", "word").write.mode("append").partitionBy("word", "version").parquet(place)
    old = {(word_of(dt), row["words"]) for dt, row in known.items() if word_of(dt) in words and row["words"] is not None}

    def clean() -> None:
        for name in TOTALS:
            for last in totals - {None}:
                remove_path(spark, f"{path}/{name}/version={last}")
        for word, last in old:
            remove_path(spark, f"{place}/word={word}/version={last}")

    return Advance(version, words, clean)


def _kept_bits(changed: set[date]) -> str:
    """SQL: the bits of a word that no changed day has."""
    masks: dict[int, int] = {}
    for dt in changed:
        masks[word_of(dt)] = masks.get(word_of(dt), 0) | 1 << (dt.toordinal() - EPOCH) % WORD_DAYS
    full = (1 << WORD_DAYS) - 1
    cases = " ".join(f"WHEN {word} THEN {full & ~mask}L" for word, mask in sorted(masks.items()))
    return f"CASE word {cases} ELSE {full}L END" if cases else f"{full}L"


# --- reading --------------------------------------------------------------------


def read_totals(spark: SparkSession, path: str, name: str, as_of: date | None = None) -> DataFrame:
    """Totals of all folded days up to ``as_of``: the stored ones, without the days after it."""
    known = ru.folded(spark, path)
    versions = {row["totals"] for row in known.values()}
    if not known:
        return spark.createDataFrame([], _schema(name))
    if len(versions) != 1 or None in versions:
        raise ValueError("the running state is behind the folded days: extend the rollup with running=True")
    totals = spark.read.schema(_schema(name)).parquet(f"{path}/{name}/version={versions.pop()}")
    later = {dt: row for dt, row in known.items() if as_of and dt > as_of}
    if not later:
        return totals
    table = TOTALS[name][0]
    return _summed(totals.unionByName(_signed(_rows(spark, path, table, _days_of(later, table)), name, -1)), name)


def running_top(totals: DataFrame, id_col: str, count_col: str, metric: str, k: int = TOP) -> DataFrame:
    """``leaders.top_by_count`` from totals. Rows without an id count for nobody: NULL has 0."""
    counted = F.when(F.col(id_col).isNotNull(), F.col(count_col)).otherwise(F.lit(0).cast("bigint"))
    rows = totals.where(F.col(count_col) > 0).select(id_col, counted.alias(metric))
    return rows.orderBy(*leader_order(metric, id_col)).limit(k)


def running_top_posts(totals: DataFrame, post_users: DataFrame, k: int = TOP) -> DataFrame:
    """``leaders.top_posts`` from the totals of posts and the bitmaps of their users; the feed is not read.

    Only the winners' bitmaps are merged, first of one post and bucket over days, by many tasks.
    """
    order = leader_order("views", "post_id")
    leaders = totals.orderBy(*order).limit(k).select(F.col("post_id").alias("leader"), "views", "likes")
    sets = post_users.join(leaders, F.col("post_id").eqNullSafe(F.col("leader")))
    sets = sets.select("leader", "views", "likes", "bucket", "users")
    # A post that only actions without a user have is a winner too.
    sets = sets.unionByName(leaders, allowMissingColumns=True)
    sizes = sets.groupBy("leader", "views", "likes", "bucket").agg(F.expr("bitmap_count(bitmap_or_agg(users)) AS n"))
    return (
        sizes.groupBy("leader", "views", "likes")
        .agg(F.sum("n").alias("users"))
        .selectExpr("leader AS post_id", "views", "likes", f"{ratio('likes', 'views')} AS ctr", "users")
        .orderBy(*order)
        .limit(k)
    )


def read_words(spark: SparkSession, path: str, known: ru.Days | None = None) -> DataFrame:
    """(user_id, word, bits) of the folded days."""
    known = ru.folded(spark, path) if known is None else known
    current = sorted({(word_of(dt), row["words"]) for dt, row in known.items() if row["words"] is not None})
    if len(current) != len({word_of(dt) for dt in known}):
        raise ValueError("the running state is behind the folded days: extend the rollup with running=True")
    if not current:
        return spark.createDataFrame([], WORDS_SCHEMA).select("user_id", "word", "bits")
    chosen = F.lit(False)
    for word, version in current:
        chosen = chosen | ((F.col("word") == word) & (F.col("version") == version))
    rows = spark.read.schema(WORDS_SCHEMA).parquet(f"{path}/{WORDS}").where(chosen)
    return rows.select("user_id", "word", "bits")


def _until(words: DataFrame, as_of: date) -> DataFrame:
    """Without the days after ``as_of``."""
    last = as_of.toordinal() - EPOCH
    kept = (1 << last % WORD_DAYS + 1) - 1
    rows = words.where(F.col("word") <= last // WORD_DAYS)
    return rows.withColumn("bits", F.expr(f"if(word = {last // WORD_DAYS}, bits & {kept}L, bits)")).where("bits <> 0")


def active_days(words: DataFrame, as_of: date | None = None) -> DataFrame:
    """(user_id, dt), one row for each bit: what every retention operator accepts."""
    rows = _until(words, as_of) if as_of else words
    places = F.expr(f"filter(sequence(0, {WORD_DAYS - 1}), k -> getbit(bits, k) = 1)")
    return rows.select("user_id", F.explode(places).alias("k"), "word").selectExpr(
        "user_id", f"date_from_unix_date(word * {WORD_DAYS} + k) AS dt"
    )


def first_days(words: DataFrame) -> DataFrame:
    """(user_id, start_date): the least bit of each user's least word."""
    return words.groupBy("user_id").agg(F.expr(f"min({_least_day('bits')}) AS start_date"))


def _least_day(bits: str) -> str:
    """SQL: the day of the least bit, which is as many places up as there are bits below it."""
    return f"date_from_unix_date(word * {WORD_DAYS} + bit_count(({bits} & -{bits}) - 1))"


def cohort_sizes(words: DataFrame) -> DataFrame:
    """``retention.cohort_sizes`` of a week from the words: each word gives the least day of every residue."""
    least = []
    for residue in range(WEEK):
        pattern = sum(1 << k for k in range(residue, WORD_DAYS, WEEK))
        own = f"(bits & {pattern}L)"
        least.append(f"min(CASE WHEN {own} <> 0 THEN {_least_day(own)} END)")
    counts = ", ".join(f"count_if(array_contains(active_days, date_add(start_date, {k})))" for k in range(WEEK))
    return (
        words.groupBy("user_id")
        .agg(F.expr(f"array({', '.join(least)}) AS active_days"))
        .withColumn("start_date", F.array_min("active_days"))
        .groupBy("start_date")
        .agg(F.expr(f"array({counts}) AS days"))
    )


def week_cohort(words: DataFrame, as_of: date) -> DataFrame:
    """The row of ``cohort_sizes`` of the cohort whose first week ended on the day before ``as_of``."""
    start = as_of - timedelta(days=WEEK)
    return cohort_sizes(_until(words, as_of - timedelta(days=1))).where(F.col("start_date") == F.lit(start))
