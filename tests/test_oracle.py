"""Every registered query against its SQL oracle on the driver's tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

TESTDATA = "/root/testdata"
QUERIES, ORACLES = entry._log_queries(), entry._log_sql()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def key(value):
        return None if isinstance(value, float) and math.isnan(value) else value

    return sorted((tuple(key(row[i]) for i in order) for row in rows), key=repr)


def oracle(sf, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{TESTDATA}/{sf}/events.parquet'")
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    return columns, result.fetchall(), [str(c[1]) for c in result.description]


SAME_TYPE = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, sf, name):
    df = QUERIES[name](spark, f"{TESTDATA}/{sf}")
    columns, expected, types = oracle(sf, name)
    assert sorted(df.columns) == sorted(columns)
    assert {f.name: SAME_TYPE[f.dataType.simpleString()] for f in df.schema.fields} == dict(zip(columns, types))
    assert rows_of(df.columns, df.collect()) == rows_of(columns, expected)


def test_entry_has_one_row(spark):
    assert entry.entry(spark).count() == 1
