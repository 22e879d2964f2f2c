import hashlib

import pytest
from pyspark.sql import functions as F

from helpers import rows
from termloom.functions import labels as lb
from termloom.operators import documents as docs


def test_normalise(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, "", "g"), (3, "NA", "null")], "row_id long, body string, cat string"
    )
    found = docs.normalise(df, "body", "cat", keep=["row_id"])
    assert rows(found) == [(1, "", "unknown"), (2, "", "g"), (3, "NA", "null")]
    assert rows(docs.normalise(df, "body"))[0][1] == "unknown"
    with pytest.raises(Exception, match="nothing"):
        docs.normalise(df, "nothing").collect()


def test_cleaning(spark):
    texts = ["ok", None, "", "  ", " \t\n  ", "x", "y"]
    labels = ["a", "a", "a", "a", "a", None, "b"]
    df = spark.createDataFrame(list(zip(texts, labels)), "text string, label string")
    assert rows(docs.drop_unusable(df)) == [("ok", "a"), ("y", "b")]
    assert rows(docs.cleaning_counts(df)) == [(7, 2, 5)]


def test_label_mapping(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 4, 9, None)], "v int")
    five = [r[0] for r in df.select(lb.five_class(F.col("v"))).collect()]
    three = [r[0] for r in df.select(lb.three_class(F.col("v"))).collect()]
    n, u, p = lb.SENTIMENTS
    assert five == [n, n, u, p, p, p, p]
    assert three == [n, u, p, p, p, p, p]
    strict = [r[0] for r in df.select(lb.five_class(F.col("v"), "null")).collect()]
    assert strict == [n, n, u, p, p, None, None]
    with pytest.raises(ValueError, match="unknown"):
        lb.five_class(F.col("v"), "other")


def test_model_input(spark):
    df = spark.createDataFrame([("m", "good"), ("t", None)], "category string, text string")
    found = docs.model_input(df).select("model_input", "group")
    assert [tuple(r) for r in found.collect()] == [("m good", "m"), (None, "t")]


def test_corpus_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", None)], "c string, l string")
    assert rows(docs.corpus_counts(df, ["c", "l"])) == sorted(
        [("c", "a", 2), ("c", "b", 1), ("l", "x", 1), ("l", "y", 1), ("l", None, 1)], key=str
    )


@pytest.mark.parametrize("n", [0, 1, 13, 500])
def test_first_rows(spark, n):
    df = spark.range(300).select((F.col("id") * 7919 % 100_003).alias("row_id")).repartition(5)
    ids = sorted(r[0] for r in df.collect())
    assert sorted(r[0] for r in docs.first_rows(df, n).collect()) == ids[:n]


def shuffle_key(row_id, seed):
    return hashlib.md5(f"{row_id}|{seed}".encode()).hexdigest()


@pytest.mark.parametrize("n", [0, 1, 100, 999, 5000])
def test_exact_sample(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "row_id")
    expected = sorted(range(1000), key=lambda i: shuffle_key(i, 42))[:n]
    for parts in (1, 6):
        found = docs.exact_sample(df.repartition(parts), n)
        assert sorted(r[0] for r in found.collect()) == sorted(expected)


def test_exact_sample_by_group_keeps_null_groups(spark):
    data = [(i, None if i % 3 == 0 else "g" if i % 3 == 1 else "") for i in range(300)]
    df = spark.createDataFrame(data, "row_id long, key string")
    found = docs.exact_sample(df, 30, by=["key"]).groupBy("key").count()
    assert rows(found) == sorted([(None, 30), ("g", 30), ("", 30)], key=str)


def test_stratified_split(spark):
    data = [(i, "big" if i % 3 else "small" if i % 2 else None) for i in range(600)]
    df = spark.createDataFrame(data, "row_id long, label string").repartition(4)
    split = docs.stratified_split(df, 0.2)
    groups = {}
    for row_id, label in data:
        groups.setdefault(label, []).append(row_id)
    held = set()
    for ids in groups.values():
        ids.sort(key=lambda i: shuffle_key(i, 42))
        held |= set(ids[: int(0.2 * len(ids) + 0.5)])
    assert {r["row_id"] for r in split.where("split = 'test'").collect()} == held
    assert split.count() == 600


def test_preview(spark):
    df = spark.createDataFrame([(i, "x" * 300) for i in range(20)], "row_id long, text string")
    found = docs.preview(df).collect()
    assert sorted(r["row_id"] for r in found) == list(range(10))
    assert {len(r["text"]) for r in found} == {120}
