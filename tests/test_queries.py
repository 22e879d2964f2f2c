"""Every registered query with SQL gives the same rows in DuckDB."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from catalog import oracle
from catalog.queries import QUERIES

TABLES = pathlib.Path("/root/testdata/sf0.001")
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        return f"{value:.6f}" if isinstance(value, float) else str(value)

    return [columns[i] for i in order], sorted([cell(row[i]) for i in order] for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    found = entry.queries()[name](spark, str(TABLES))
    ours = sorted_rows(found.columns, found.collect())
    result = duck.execute(SQL[name])
    theirs = sorted_rows([c[0] for c in result.description], result.fetchall())
    assert ours == theirs
    kinds = {"bigint": "NUMBER", "int": "NUMBER", "double": "NUMBER", "string": "STRING"}
    types = {c[0]: str(c[1]) for c in result.description}
    assert all(kinds.get(kind, types[c]) == types[c] for c, kind in found.dtypes if kind in ("bigint", "double", "string") and types[c] in ("NUMBER", "STRING"))
    assert ours[1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "EvalPython" not in plan
    assert ("MapInPandas" in plan) == (name == "external_model")


def test_only_fitted_models_have_no_sql():
    without = set(QUERIES) - set(SQL)
    assert without == {
        "logreg_predictions", "svm_predictions", "relational_logreg", "model_selection",
        "complete_run", "relational_training",
    }


def test_relational_scores_equal_the_model(spark):
    from catalog import queries
    from termloom.models import selection

    rows, model = queries._fitted(spark, str(TABLES), "baseline")
    expected = {r["row_id"]: r["predicted_sentiment"]
                for r in selection.predicted(model, rows, ["row_id"]).collect()}
    found = entry.queries()["relational_logreg"](spark, str(TABLES)).collect()
    assert {r["row_id"]: r["predicted_sentiment"] for r in found} == expected


def test_complete_run_scores_every_document(spark):
    found = entry.queries()["complete_run"](spark, str(TABLES))
    documents = spark.read.parquet(f"{TABLES}/documents.parquet").count()
    overall = found.where("group is null").agg({"count": "sum"}).first()[0]
    assert overall == documents


def test_entry(spark):
    assert entry.entry(spark).count() == 60
