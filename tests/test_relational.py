"""The relational trainer against Spark's own logistic regression on the same features."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from termloom.models import relational
from termloom.operators import scoring

CLASSES = ["negative", "neutral", "positive"]
WIDTH = 15


@pytest.fixture(scope="module")
def corpus(spark):
    made = np.random.default_rng(11)
    true = made.normal(size=(WIDTH, 3)) * 2
    long, labels, vectors = [], [], []
    for i in range(150):
        at = np.sort(made.choice(WIDTH, made.integers(0, 6), replace=False))
        values = made.random(len(at))
        y = int((values @ true[at] + made.gumbel(size=3) * 0.5).argmax())
        long += [(i, f"t{a}", float(v)) for a, v in zip(at, values, strict=True)]
        labels.append((i, CLASSES[y]))
        vectors.append((i, Vectors.sparse(WIDTH, at.tolist(), values.tolist()), float(y)))
    features = spark.createDataFrame(long, "row_id long, term string, weight double").repartition(3)
    labels = spark.createDataFrame([*labels, (900, "other")], "row_id long, label string")
    return features, labels, spark.createDataFrame(vectors, ["row_id", "x", "y"])


@pytest.fixture(scope="module")
def trained(corpus):
    features, labels, _ = corpus
    return relational.train(features, labels, strength=2.0, tolerance=1e-4)


def test_log_loss_equals_that_of_spark(corpus, trained):
    machine = LogisticRegression(
        family="multinomial", featuresCol="x", labelCol="y", regParam=1 / (2.0 * 150),
        standardization=False, maxIter=500, tol=1e-10,
    )
    rows = machine.fit(corpus[2]).transform(corpus[2]).select("y", "probability").collect()
    theirs = -np.mean([np.log(r["probability"][int(r["y"])]) for r in rows])
    assert trained.log_loss == pytest.approx(theirs, abs=1e-4)
    assert 3 < trained.iterations < 100


def test_weights_score_like_spark(corpus, trained):
    features, labels, vectors = corpus
    machine = LogisticRegression(
        family="multinomial", featuresCol="x", labelCol="y", regParam=1 / (2.0 * 150),
        standardization=False, maxIter=500, tol=1e-10,
    )
    theirs = machine.fit(vectors).transform(vectors).select("row_id", "prediction")
    rows = labels.where("label != 'other'").join(features, "row_id", "left").select("row_id", "term", "weight")
    scores = scoring.linear_scores(rows, trained.weights, WIDTH, trained.intercepts)
    ours = scores.select("row_id", scoring.best_class().alias("label"))
    both = ours.join(theirs, "row_id").select(
        "label", F.element_at(F.array(*map(F.lit, CLASSES)), F.col("prediction").cast("int") + 1).alias("other")
    )
    assert both.where("label != other").count() <= 1 and both.count() == 150


def test_no_vocabulary_reaches_the_driver(corpus, trained):
    assert sorted(trained.weights.columns) == ["negative", "neutral", "positive", "term"]
    assert trained.weights.count() == WIDTH
    assert all(isinstance(x, (float, int, dict)) for x in vars(trained).values() if x is not trained.weights)


def test_class_weights_change_the_balance(corpus):
    features, labels, _ = corpus
    heavy = relational.train(features, labels, class_weights={"negative": 50.0}, max_iter=4)
    scores = scoring.linear_scores(features, heavy.weights, WIDTH, heavy.intercepts)
    counted = scores.groupBy(scoring.best_class().alias("c")).count().collect()
    found = {r["c"]: r["count"] for r in counted}
    assert found["negative"] > sum(found.values()) / 2


def test_joins_by_document_and_term_train_alike(corpus):
    features, labels, _ = corpus
    near = relational.train(features, labels, strength=2.0, max_iter=3)
    far = relational.train(features, labels, strength=2.0, max_iter=3, limit=0)
    assert far.objective == pytest.approx(near.objective, rel=1e-9)
    both = near.weights.join(far.weights.withColumnRenamed("neutral", "other"), "term")
    assert both.where("abs(neutral - other) < 1e-9").count() == WIDTH


def test_an_iteration_stores_nothing_by_term(corpus, monkeypatch):
    features, labels, _ = corpus
    stored, write = [], relational.rewritten

    def noted(df, name):
        stored.append((name, "term" in df.columns))
        return write(df, name)

    monkeypatch.setattr(relational, "rewritten", noted)
    relational.train(features, labels, max_iter=2)
    assert [name for name, by_term in stored if by_term] == ["coefficients"]


def test_repeated_and_missing_row_ids(spark):
    """Rows of one id share its terms; a row without an id or without terms has only the intercepts."""
    labels = [(1, "negative"), (1, "positive"), (2, "neutral"), (None, "neutral"), (3, "positive")]
    features = [(1, "a", 0.6), (1, "a", 0.8), (2, "b", 1.0), (None, "b", 1.0), (9, "c", 1.0)]
    labels = spark.createDataFrame(labels, "row_id long, label string")
    features = spark.createDataFrame(features, "row_id long, term string, weight double")
    for limit in (None, 0):
        found = relational.train(features, labels, max_iter=4, limit=limit)
        machine = {r["term"]: r for r in found.weights.collect()}
        assert sorted(machine) == ["a", "b"]
        a, b = machine["a"], machine["b"]
        assert abs(sum(a[c] for c in CLASSES)) < 1e-9 and b["neutral"] > 0 > a["neutral"]
