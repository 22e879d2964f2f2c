import pytest
from pyspark.sql import functions as F

from helpers import rows
from termloom.functions.labels import SENTIMENTS
from termloom.operators import metrics
from termloom.plans import jobs

# The published confusion matrix, rows actual, columns predicted.
PUBLISHED = [[5094, 1115, 673], [1136, 3877, 1860], [483, 1571, 7023]]


@pytest.fixture
def published(spark):
    cells = [
        (a, p, PUBLISHED[i][j]) for i, a in enumerate(SENTIMENTS) for j, p in enumerate(SENTIMENTS)
    ]
    return spark.createDataFrame(cells, "actual string, predicted string, count long")


def counts_of(spark, pairs):
    return metrics.pair_counts(spark.createDataFrame(pairs, "actual string, predicted string"))


def test_published_numbers(published):
    assert tuple(metrics.accuracy(published).first()) == (22832, pytest.approx(0.7005080588647512))
    averages = metrics.metric_averages(metrics.class_report(published)).first()
    assert averages["f1_macro"] == pytest.approx(0.6934411005910427, abs=1e-12)
    assert averages["f1_weighted"] == pytest.approx(0.6992919753383782, abs=1e-12)
    assert averages["precision_macro"] == pytest.approx(0.69483, abs=5e-6)
    assert averages["recall_weighted"] == pytest.approx(0.70051, abs=5e-6)
    report = {r["class"]: r for r in metrics.class_report(published, SENTIMENTS).collect()}
    assert report["neutral"]["precision"] == pytest.approx(0.59074, abs=5e-6)
    assert report["positive"]["support"] == 9077


def test_accuracy_is_trace_over_total(published):
    trace = sum(PUBLISHED[i][i] for i in range(3))
    total = sum(map(sum, PUBLISHED))
    assert metrics.accuracy(published).first()["accuracy"] == pytest.approx(trace / total)


def test_classes_never_predicted_or_never_true(spark):
    counts = counts_of(spark, [("a", "b"), ("a", "a"), ("c", "a")])
    report = {r["class"]: tuple(r)[1:] for r in metrics.class_report(counts).collect()}
    assert report == {"a": (0.5, 0.5, 0.5, 2), "b": (0.0, 0.0, 0.0, 0), "c": (0.0, 0.0, 0.0, 1)}
    wider = {r["class"]: tuple(r)[1:] for r in metrics.class_report(counts, ["a", "z"]).collect()}
    assert wider == {"a": (0.5, 0.5, 0.5, 2), "z": (0.0, 0.0, 0.0, 0)}


def test_matrix_has_zero_cells(spark):
    counts = counts_of(spark, [("a", "b"), ("a", "b")])
    assert rows(metrics.confusion_matrix(counts)) == [
        ("a", "a", 0), ("a", "b", 2), ("b", "a", 0), ("b", "b", 0)
    ]
    table = {r["actual"]: (r["a"], r["b"]) for r in metrics.confusion_table(counts, ["a", "b"]).collect()}
    assert table == {"a": (0, 2), "b": (0, 0)}


def test_empty_alignment(spark):
    counts = counts_of(spark, [])
    assert tuple(metrics.accuracy(counts).first()) == (0, None)
    assert metrics.class_report(counts).count() == 0
    assert metrics.confusion_matrix(counts).count() == 0


LABELS = "row_id long, group string, text string, sentiment string"
PREDICTED = "row_id long, group string, text string, predicted_sentiment string"


def test_copies_are_paired_in_row_order(spark):
    predictions = spark.createDataFrame(
        [(i, "g", "same", f"p{i}") for i in range(3)] + [(3, None, None, "p3"), (4, "g", "x", "p4")],
        PREDICTED,
    )
    labels = spark.createDataFrame(
        [(10 + i, "g", "same", f"l{i}") for i in range(3)] + [(20, "unknown", "", "l3")], LABELS
    )
    expected = [(0, "l0", "p0"), (1, "l1", "p1"), (2, "l2", "p2"), (3, "l3", "p3")]
    for parts in (1, 4):
        left, right = predictions.repartition(parts), labels.repartition(parts)
        assert rows(metrics.align_by_content(left, right)) == expected
        assert rows(metrics.align(left, right)) == expected


def test_auto_keeps_row_ids_when_none_is_lost(spark):
    predictions = spark.createDataFrame([(0, "g", "a", "p0"), (1, "g", "b", "p1")], PREDICTED)
    labels = spark.createDataFrame([(0, "g", "b", "l0"), (1, "g", "a", "l1")], LABELS)
    assert rows(metrics.align(predictions, labels)) == [(0, "l0", "p0"), (1, "l1", "p1")]
    by_content = metrics.align(predictions, labels, "content")
    assert rows(by_content) == [(0, "l1", "p0"), (1, "l0", "p1")]
    with pytest.raises(ValueError, match="how"):
        metrics.align(predictions, labels, "other")


def test_auto_without_content_keeps_the_row_id_join(spark):
    predictions = spark.createDataFrame([(0, "p0"), (9, "p9")], "row_id long, predicted_sentiment string")
    labels = spark.createDataFrame([(0, "l0")], "row_id long, sentiment string")
    assert rows(metrics.align(predictions, labels)) == [(0, "l0", "p0")]


def test_validate(spark):
    predictions = spark.createDataFrame([(0, "g", "a", "x"), (1, "g", "b", "y")], PREDICTED)
    labels = spark.createDataFrame([(5, "g", "a", "x"), (6, "g", "b", "x")], LABELS)
    found = jobs.validate(predictions, labels)
    assert tuple(found["accuracy"].first()) == (2, 0.5)
    assert found["matrix"].agg(F.sum("count")).first()[0] == 2


def test_label_distribution(spark):
    df = spark.createDataFrame(
        [("m", "p"), ("m", "p"), ("m", "n"), ("t", "n")], "category string, predicted_sentiment string"
    )
    found = [tuple(r) for r in metrics.label_distribution(df).collect()]
    assert found == [("m", "p", 2), ("m", "n", 1), ("t", "n", 1), (None, "n", 2), (None, "p", 2)]
