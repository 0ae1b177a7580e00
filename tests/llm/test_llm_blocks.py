"""Blocks of documents."""

import llm_brute as brute
import pytest
from pyspark.sql import functions as F

from daygauge.llm.blocks import hashed_to, in_blocks


def test_numbers_are_hashed_to_themselves(spark):
    numbers = [0, 1, 2, 41, 1 << 16, (1 << 31) - 1]
    found = spark.createDataFrame([(n,) for n in numbers], "n long").select("n", F.hash(hashed_to(F.col("n"))).alias("h"))
    assert all(r.n == r.h for r in found.collect())
    assert spark.range(5000).where(F.hash(hashed_to(F.col("id"))) != F.col("id")).count() == 0


@pytest.mark.parametrize("size", [500, 1 << 20])
def test_blocks_are_buckets_and_leave_no_name(spark, size):
    names = {t.name for t in spark.catalog.listTables()}
    docs = brute.frame(spark, [(n, "ab c " * 20, None, None, None) for n in range(200)])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("text").alias("body"))
    table, blocks = in_blocks(rows, "body", size)
    assert blocks == -(-200 * 100 // size)
    assert {t.name for t in spark.catalog.listTables()} == names
    buckets = table.select(F.expr(f"pmod(hash(block), {blocks})").alias("bucket"), "block").distinct().collect()
    assert len({r.bucket for r in buckets}) == len(buckets) == len({r.block for r in buckets})
    grouped = table.groupBy("block").applyInPandas(lambda rows: rows[["block"]].head(1), "block int")
    assert grouped.count() == len(buckets)
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
