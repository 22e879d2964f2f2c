"""The registered corpus queries: those with SQL give its rows, all run on given tables."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from termloom.llm import queries

TABLES = pathlib.Path("/root/testdata/sf0.001")


def plain(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(str([row[i] for i in order]) for row in rows)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    found = entry.queries()[name](spark, str(TABLES))
    result = duck.execute(queries.SQL[name])
    assert plain(found.columns, found.collect()) == plain(
        [c[0] for c in result.description], result.fetchall()
    )


def test_one_query_for_each_operator_and_the_pipeline():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
