"""Mix sources to target weights by weighted fair queueing.

Every source is a queue in shuffled order that starts again once its end is reached. An
entry's virtual finish time is the words of its source up to and with it, divided by the
source's target. Entries are served in the order of these times until the budget is spent.

Times only grow along a queue, so what is served of a source is the beginning of its queue:
the global cut leaves one last served entry per source, and a document is taken as often as
its entries don't stand behind it. Only ids, sources and sizes are shuffled, no text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from daygauge.llm.workspace import WORD, parts_for, same, stored

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
REPEATS = 2
ROWS_A_BUCKET = 20_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def shuffle_key(key: Column) -> Column:
    """A number below 2**32 that orders a queue, the same on each run."""
    name = F.concat(F.lit("mix "), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int], budget: float, repeats: int) -> DataFrame:
    """Per source: source_size, target. Shares go by weight; none is above ``repeats`` times its size.

    Sources reach their bound in ascending order of bound / weight. With the first k at their
    bound the others share the rest by weight, for the smallest k with which the next one
    stays within its bound. ``sizes`` has a row per source, few enough for one task.
    """
    everything = W.partitionBy(F.lit(0))
    by_name = F.col("source").asc_nulls_last()
    place = (F.row_number().over(everything.orderBy(by_name)) - 1) % len(weights)
    fills = everything.orderBy(F.col("bound") / F.col("weight"), by_name)
    earlier = fills.rowsBetween(W.unboundedPreceding, -1)
    shares = (
        sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")))
        .withColumn("bound", F.col("source_size") * repeats)
        .withColumn("k", F.row_number().over(fills))
        .withColumn("rest", F.sum("source_size").over(everything) * F.lit(float(budget)))
        .withColumn("rest", F.col("rest") - F.coalesce(F.sum("bound").over(earlier), F.lit(0)))
        .withColumn("open", F.sum("weight").over(fills.rowsBetween(0, W.unboundedFollowing)))
    )
    share = F.col("rest") * F.col("weight") / F.col("open")
    level = F.min(F.when(share <= F.col("bound"), F.struct("k", "rest", "open"))).over(everything)
    full = F.col("level").isNull() | (F.col("k") < F.col("level.k"))
    shared = F.col("level.rest") * F.col("weight") / F.col("level.open")
    return shares.withColumn("level", level).select(
        "source", "source_size", F.when(full, F.col("bound").cast("double")).otherwise(shared).alias("target")
    )


def _entry(round_: Column) -> Column:
    """The place of an entry in its source's queue; rows that are equal in all of it share one."""
    return F.struct(
        round_.cast("int").alias("round"),
        F.col("place").alias("place"),
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("name"),
        F.col("size").alias("size"),
    )


def _narrow(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).alias("id"),
        F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"),
        shuffle_key(F.col(key)).alias("place"),
    )


def _cuts(rows: DataFrame, weights, budget, repeats, rows_a_bucket) -> DataFrame:
    """Per source: source, source_size, target, and ``last``, the last entry that is served.

    Rows that share an entry are added up before any window sees them, so a key that very
    many rows have is a row for each of their sizes.
    """
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = parts_for(count, rows_a_bucket)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(sizes, weights, budget, repeats), "mix-targets")

    # Words of the source up to and with each document: whole buckets first, then inside one.
    same_entry = ["source", "place", F.col("id").cast("string").alias("id"), "size"]
    rows = rows.groupBy(*same_entry).agg(F.sum("size").alias("amount"))
    rows = rows.withColumn("part", F.floor(F.col("place") * parts / F.lit(2.0**32)))
    parted = rows.groupBy("source", "part").agg(F.sum("amount").alias("words"))
    ahead = F.sum("words").over(W.partitionBy("source").orderBy("part")) - F.col("words")
    offsets = parted.select(F.col("source").alias("o_source"), F.col("part").alias("o_part"), ahead.alias("ahead"))
    inside = F.sum("amount").over(W.partitionBy("source", "part").orderBy(_entry(F.lit(0))))
    goal = goals.withColumnRenamed("source", "g_source")
    entries = (
        rows.withColumn("inside", inside)
        .join(offsets, same(F.col("source"), F.col("o_source")) & (F.col("part") == F.col("o_part")))
        .join(goal, same(F.col("source"), F.col("g_source")))
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn("words", F.col("round") * F.col("source_size") + F.col("ahead") + F.col("inside"))
        .withColumn("finish", F.col("words") / F.nullif(F.col("target"), F.lit(0.0)))
        .where("finish IS NOT NULL")
        .withColumn("slice", F.floor(F.least(F.col("finish"), F.lit(1e6)) * parts))
        .select("source", "finish", "slice", F.col("amount").alias("size"), _entry(F.col("round")).alias("entry"))
    )
    entries = stored(entries, "mix-entries")

    # The global cut: slices of the finish times that are served whole, then inside the next one.
    spent = F.sum("size").over(W.partitionBy(F.lit(0)).orderBy("slice"))
    slices = entries.groupBy("slice").agg(F.sum("size").alias("size")).withColumn("spent", spent)
    limit = float(budget) * total
    edge = slices.where(F.col("spent") > limit).agg(F.min(F.struct("slice", F.col("spent") - F.col("size")))).first()[0]
    served = entries
    if edge is not None:
        order = W.partitionBy("slice").orderBy("finish", F.col("source").asc_nulls_last())
        last = entries.where(F.col("slice") == edge[0]).withColumn("spent", F.sum("size").over(order) + edge[1])
        served = entries.where(F.col("slice") < edge[0]).unionByName(
            last.where(F.col("spent") <= limit).drop("spent")
        )
    lasts = served.groupBy("source").agg(F.max("entry").alias("last")).withColumnRenamed("source", "l_source")
    cut = goals.join(lasts, same(F.col("source"), F.col("l_source")), "left").drop("l_source")
    return stored(cut.withColumnsRenamed({"source": "c_source"}), "mix-cuts")


def _times(repeats: int) -> Column:
    """How often a document is served; 0 where nothing of its source is."""
    served = [F.when(_entry(F.lit(r)) <= F.col("last"), 1).otherwise(0) for r in range(repeats)]
    return sum(served, F.lit(0)).cast("bigint")


def mix_counts(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    repeats: int = REPEATS,
    rows_a_bucket: int = ROWS_A_BUCKET,
) -> DataFrame:
    """One row per document: the key, size, source_size, target, taken, times.

    size: words, 0 for a null text; taken: times * size. The sources, ordered by code point
    with null last, weigh ``weights`` in turn and share ``budget`` times all words. Rows of one
    source that are equal in key and size stand at one place of the queue and are served
    together. Documents without words cost nothing and are served with the one before them.
    An empty table, or one without words, gives its rows with nothing taken.
    """
    rows = stored(_narrow(docs, key, source, text), "mix-rows")
    cuts = _cuts(rows, weights, budget, repeats, rows_a_bucket)
    times = _times(repeats)
    return rows.join(cuts, same(F.col("source"), F.col("c_source"))).select(
        F.col("id").alias(key),
        "size",
        "source_size",
        "target",
        (times * F.col("size")).alias("taken"),
        times.alias("times"),
    )


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    repeats: int = REPEATS,
    rows_a_bucket: int = ROWS_A_BUCKET,
) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; the same columns.

    A null source is a source of its own, the last one; null and empty texts have size 0, cost the
    mix nothing and are queued like others; a null key has a place in the queue like others. Rows equal in source, place and size are
    taken alike, also repeated ones. A text of any length is one entry. An empty table gives no rows,
    and columns of any name are kept as they are.

    The rows meet the cuts of the sources only, one narrow row per source, which Spark
    broadcasts while that table's size is below its threshold, and joins by a shuffle above.
    """
    cuts = _cuts(stored(_narrow(docs, key, source, text), "mix-rows"), weights, budget, repeats, rows_a_bucket)
    # Under one struct the columns of the documents keep clear of the names used here.
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    lead = rows.select(
        "doc",
        F.col(f"doc.`{key}`").alias("id"),
        F.col(f"doc.`{source}`").alias("source"),
        n_words(F.col(f"doc.`{text}`")).alias("size"),
        shuffle_key(F.col(f"doc.`{key}`")).alias("place"),
    )
    taken = lead.join(cuts, same(F.col("source"), F.col("c_source"))).withColumn("times", _times(repeats))
    each = F.explode(F.array_repeat("doc", F.col("times").cast("int"))).alias("doc")
    return taken.where("times > 0").select(each).select("doc.*")
