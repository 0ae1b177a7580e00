"""Consistent-hash ring with virtual nodes and bounded loads.

Keys go to the next virtual node clockwise; a shard takes as many as its capacity, and
what it can't take goes on clockwise. Without slack, capacities add up to the number of
rows, so the shards' counts are at most one apart; slack lets more keys stay where they
first fall, so that another number of shards moves fewer.

Every key of an arc between two virtual nodes meets the same nodes, so only the arcs'
counts are needed to know how many of an arc's keys each shard takes. The arcs are as
many as the virtual nodes, whatever the input; the keys themselves never leave Spark.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from daygauge.llm.workspace import parts_for, same, stored

VIRTUAL_NODES = 64
ROWS_A_BUCKET = 20_000


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, list[int]]:
    """Positions of the virtual nodes in ascending order, and the shard of each."""
    points = sorted(
        (int(hashlib.md5(f"shard {s} node {v}".encode()).hexdigest()[:8], 16), s)
        for s in range(shards)
        for v in range(virtual_nodes)
    )
    return np.array([p for p, _ in points], dtype=np.int64), [s for _, s in points]


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows that each shard takes at most; without slack, the first ones take the remainder."""
    if slack:
        return [math.ceil(rows * (1 + slack) / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def placements(
    counts: list[int], owners: list[int], shards: int, slack: float = 0.0
) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, rank after the last, shard, first slot), from the keys' count per arc.

    All arcs fill their own node's shard first, in the order of the ring; then what is left
    of each arc goes one node further, until nothing is left.
    """
    free = capacities(sum(counts), shards, slack)
    used = [0] * shards
    at = [0] * len(counts)
    plan = []
    for step in range(len(owners)):
        open_arcs = [a for a, n in enumerate(counts) if at[a] < n]
        if not open_arcs:
            break
        for a in open_arcs:
            shard = owners[(a + step) % len(owners)]
            take = min(counts[a] - at[a], free[shard])
            if take:
                plan.append((a, at[a], at[a] + take, shard, used[shard]))
                at[a] += take
                free[shard] -= take
                used[shard] += take
    return plan


def sharded(
    docs: DataFrame,
    shards: int = 16,
    key: str = "doc_id",
    text: str = "text",
    virtual_nodes: int = VIRTUAL_NODES,
    slack: float = 0.0,
    rows_a_bucket: int = ROWS_A_BUCKET,
) -> DataFrame:
    """One row per document: the key, size, text_crc32, shard, slot.

    size: UTF-8 bytes plus 1; text_crc32 of the text, a null text counting as empty in both.
    Without ``slack`` the law is ``rows``: the shards' counts are at most one apart. With it no
    shard has more than 1 + slack times the mean. Slots run without gaps from 0 in each. Keys
    that are equal or null have one place on the ring and are told apart by their rank there
    (ordered by checksum and size; equal rows are interchangeable), so a key that holds a third
    of all rows overflows like any other arc. An empty table gives no rows. Only the three
    narrow columns are moved.
    """
    spark = docs.sparkSession
    positions, owners = ring(shards, virtual_nodes)

    @F.pandas_udf("int")
    def arc_of(places: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for p in places:
            arcs = np.searchsorted(positions, p.to_numpy(np.int64), side="left") % len(positions)
            yield pd.Series(arcs, dtype="int32")

    content = F.coalesce(F.col(text), F.lit("")).cast("binary")
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    narrow = docs.select(
        F.col(key).alias("id"),
        (F.octet_length(content).cast("bigint") + 1).alias("size"),
        F.crc32(content).alias("crc"),
        F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint").alias("place"),
    )
    rows = stored(narrow.withColumn("arc", arc_of("place")), "shard-rows")
    total = rows.count()
    # A fine bucket holds few rows even where one key has very many: it goes by the content too.
    fine = parts_for(total, rows_a_bucket * len(positions))
    spread = F.pmod(F.xxhash64("id", "crc", "size"), F.lit(fine)).cast("int")
    rows = rows.withColumn("fine", spread)
    counted = rows.groupBy("arc", "fine").agg(F.count("*").alias("n"))
    by_arc = {r["arc"]: r["n"] for r in counted.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    plan = placements([by_arc.get(a, 0) for a in range(len(owners))], owners, shards, slack)
    # As many entries as arcs and cut points: bounded by the ring, not by the rows.
    schema = "arc int, first bigint, after bigint, shard int, slot bigint"
    entries = F.broadcast(spark.createDataFrame(plan, schema))
    before = F.sum("n").over(W.partitionBy("arc").orderBy("fine")) - F.col("n")
    offsets = counted.select(F.col("arc").alias("o_arc"), F.col("fine").alias("o_fine"), before.alias("before"))
    within = F.row_number().over(W.partitionBy("arc", "fine").orderBy("id", "crc", "size"))
    ranked = (
        rows.withColumn("within", within)
        .join(offsets, same(F.col("arc"), F.col("o_arc")) & same(F.col("fine"), F.col("o_fine")))
        .withColumn("rank", F.col("before") + F.col("within") - 1)
    )
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("after"))
    return (
        ranked.alias("r")
        .join(entries.alias("e"), (F.col("r.arc") == F.col("e.arc")) & inside)
        .select(
            F.col("id").alias(key),
            "size",
            F.col("crc").alias("text_crc32"),
            "shard",
            (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"),
        )
    )
