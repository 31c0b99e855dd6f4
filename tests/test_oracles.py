"""Every query with a SQL form gives the rows DuckDB gives."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

ORACLES = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return con


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, tables, key):
    frame = QUERIES[key](spark, sf_dir)
    columns = sorted(frame.columns)
    got = sorted(tuple(map(comparable, r)) for r in frame.select(*columns).collect())
    cursor = tables.execute(ORACLES[key])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    wanted = sorted(tuple(comparable(r[i]) for i in order) for r in cursor.fetchall())
    assert got == wanted


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 30


def test_random_split_keeps_every_row_once(spark, sf_dir):
    parts = QUERIES["random_split"](spark, sf_dir)
    whole = QUERIES["clean_transactions"](spark, sf_dir)
    assert parts.drop("part").exceptAll(whole).isEmpty()
    assert parts.count() == whole.count()
    assert {r[0] for r in parts.select("part").distinct().collect()} == {"train", "test"}
