"""The registered queries against SQL, and the pipeline against brute force."""

import math
import re

import duckdb
import llm_brute as brute
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from daygauge.llm import mixing, near_dup, quality, queries, recipes

SF = "/root/testdata/sf0.01"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_operator_is_registered():
    names = {f"op{n}_" for n in range(1, 14)}
    assert {re.match(r"op\d+_", n)[0] for n in queries.queries()} == names
    assert queries.queries().keys() | {"pipeline"} <= entry.queries().keys()
    assert queries.oracle_sql().keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    df = queries.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_near_duplicate_query_equals_brute_force(spark):
    table = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    rows = list(zip(table["doc_id"], table["text"]))
    first, sizes = brute.near_components(rows)
    found = near_dup.near_duplicates(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(
        (i, n, c) for (i, _), n, c in zip(rows, sizes, first)
    )


def test_pipeline_stages_take_effect_and_keep_whole_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    sf_dir = str(tmp_path)
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = {r.doc_id: tuple(r) for r in given.collect()}
    before = set(whole)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "near_dedup", "mix_sources", "encode_texts",
    ]
    expected = [
        lambda d: [r.doc_id for r in quality.quality(d).where("kept").collect()],
        lambda d: [r.doc_id for r in recipes.exact_groups(d).where("kept").collect()],
        lambda d: [r.doc_id for r in near_dup.near_duplicates(d).where("kept").collect()],
        lambda d: [r.doc_id for r in mixing.mix_counts(d).collect() for _ in range(r.times)],
    ]
    stage_docs = given
    for (name, stage), kept in zip(corpus_pipeline.STAGES[:-1], expected):
        out = stage(spark, stage_docs, sf_dir)
        out.write.parquet(f"{sf_dir}/{name}")
        after = spark.read.parquet(f"{sf_dir}/{name}")
        assert after.columns == given.columns
        rows = after.collect()
        assert all(tuple(r) == whole[r.doc_id] for r in rows)
        assert sorted(r.doc_id for r in rows) == sorted(kept(stage_docs))
        assert {r.doc_id for r in rows} <= before
        before, stage_docs = {r.doc_id for r in rows}, after
    last = corpus_pipeline.STAGES[-1][1](spark, stage_docs, sf_dir).collect()
    assert rows_of(last[0].__fields__, last) == rows_of(
        last[0].__fields__, corpus_pipeline.run(spark, sf_dir).collect()
    )
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in stage_docs.collect())
