"""Compare candidates on a validation split, refit the best, evaluate it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.labels import SENTIMENTS
from termloom.models import linear
from termloom.models.candidates import (
    CANDIDATES,
    Candidate,
    feature_blocks,
    fit_candidate,
    fit_together,
)
from termloom.operators.documents import stratified_split
from termloom.operators.metrics import accuracy, class_report, metric_averages, pair_counts
from termloom.operators.runs import best_candidate
from termloom.operators.scale import materialise

SCORES = "candidate_index int, model_name string, accuracy double, f1_macro double"
PAIRS = "candidate_index int, model_name string, actual string, predicted string, count long"


#: A fitted pipeline, or a function that adds ``predicted_sentiment`` to rows with ``model_input``.
Model = PipelineModel | Callable[[DataFrame], DataFrame]


def predicted(model: Model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``predicted_sentiment``; a pipeline needs one pass and no shuffle."""
    scored = model.transform(df) if isinstance(model, PipelineModel) else model(df)
    return scored.select(*keep, "predicted_sentiment")


def evaluate(model: Model, df: DataFrame, label: str = "label") -> DataFrame:
    """Pair counts of a model on labelled rows, ready for all metrics."""
    pairs = predicted(model, df, [F.col(label).alias("actual")])
    return materialise(pair_counts(pairs.withColumnRenamed("predicted_sentiment", "predicted")))


def select_model(
    train: DataFrame,
    candidates: Sequence[Candidate] = tuple(CANDIDATES),
    fraction: float = 0.15,
    seed: int = 42,
    max_iter: int | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Fit every candidate on part of ``train``, score it on the rest, refit the best.

    ``train`` has ``row_id, model_input, label``. All candidates are fitted and scored in
    common passes over one table of features. Returns the refitted model and the
    scores, one row per candidate with ``selected``.
    """
    spark = train.sparkSession
    split = materialise(stratified_split(train, fraction, seed=seed, names=("fit", "check")))
    fit, check = split.where(F.col("split") == "fit"), split.where(F.col("split") == "check")
    vectors, problems, fitted, widths = fit_together(fit, candidates, max_iter=max_iter)
    checked = feature_blocks(check, vectors, widths, "label", check.count())
    try:
        counts = linear.pair_counts(checked, fitted, problems)
    finally:
        checked.unpersist()
    pairs = [
        (index, candidates[index].name, SENTIMENTS[a], SENTIMENTS[p], int(counts[index, a, p]))
        for index, a, p in zip(*counts.nonzero(), strict=True)
    ]
    pairs = [(int(index), *rest) for index, *rest in pairs]
    scores = materialise(candidate_scores(spark.createDataFrame(pairs, PAIRS)))
    best = best_candidate(scores).first()
    model = fit_candidate(train, candidates[best["candidate_index"]], max_iter=max_iter)
    chosen = F.col("candidate_index") == best["candidate_index"]
    return model, scores.withColumn("selected", chosen)


def candidate_scores(pairs: DataFrame) -> DataFrame:
    """Accuracy and macro F1 over the classes that occur, by candidate, from pair counts."""
    names = ["candidate_index", "model_name"]
    sides = F.explode(F.array(
        F.struct(F.col("actual").alias("class"), F.col("count").alias("actual_rows"), F.lit(0).cast("long").alias("found")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("actual_rows"), F.col("count").alias("found")),
    )).alias("s")
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0)
    right = F.when(F.col("s.actual_rows") > 0, hit).otherwise(0)
    split = pairs.select("*", sides).withColumn("right", right)
    by_class = split.groupBy(*names, "s.class").agg(
        F.sum("s.actual_rows").alias("rows"), F.sum("s.found").alias("found"), F.sum("right").alias("right")
    )
    f1 = 2.0 * F.col("right") / (F.col("rows") + F.col("found"))
    return by_class.groupBy(*names).agg(
        (F.sum("right") / F.sum("rows")).alias("accuracy"), F.avg(f1).alias("f1_macro")
    )


def test_metrics(
    counts: DataFrame, labels: Sequence[str] | None = tuple(SENTIMENTS)
) -> DataFrame:
    """Accuracy with macro and weighted averages as one row.

    ``labels=None`` averages over the classes that occur.
    """
    averages = metric_averages(class_report(counts, labels))
    whole = averages.select(F.struct(*averages.columns)).scalar()
    return (
        accuracy(counts)
        .select("*", whole.alias("_averages"))
        .select("samples_compared", "accuracy", "_averages.*")
    )
