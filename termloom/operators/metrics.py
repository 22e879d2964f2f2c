"""Alignment of predictions with labels, and classification metrics.

All metrics are made from ``pair_counts``: one pass over the rows gives a frame with
one row per (actual, predicted) pair, and everything else works on that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.scale import digest, materialise, ordinals


def align_by_row_id(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Inner join on row id: ``row_id, actual, predicted``."""
    left = predictions.select("row_id", F.col("predicted_sentiment").alias("predicted"))
    right = labels.select("row_id", F.col("sentiment").alias("actual"))
    return left.join(right, "row_id").select("row_id", "actual", "predicted")


def align_by_content(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Pair the k-th prediction of a (group, text) with the k-th label of it.

    Rows are matched on a SHA-256 digest and the ordinal, so texts are not shuffled
    and copies of one text spread over many tasks.
    """

    def keyed(df: DataFrame, value: Column) -> DataFrame:
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        group = F.coalesce(F.col("group").cast("string"), F.lit("unknown"))
        # Written once: a digest is far smaller than the text it stands for.
        slim = materialise(df.select("row_id", digest(group, text).alias("_key"), value))
        return ordinals(slim, ["_key"], name="_ordinal")

    left = keyed(predictions, F.col("predicted_sentiment").alias("predicted"))
    right = keyed(labels, F.col("sentiment").alias("actual")).drop("row_id")
    return left.join(right, ["_key", "_ordinal"]).select("row_id", "actual", "predicted")


def align(predictions: DataFrame, labels: DataFrame, how: str = "auto") -> DataFrame:
    """Join predictions to labels by "row_id", by "content", or "auto".

    "auto" joins by row id and falls back to content if the join loses or gains rows
    and both sides have group and text.
    """
    if how == "row_id":
        return align_by_row_id(predictions, labels)
    if how == "content":
        return align_by_content(predictions, labels)
    if how != "auto":
        raise ValueError(f"how must be 'auto', 'row_id' or 'content', not {how!r}")
    needed = {"group", "text"}
    if not (needed <= set(predictions.columns) and needed <= set(labels.columns)):
        return align_by_row_id(predictions, labels)
    # Three narrow columns, written once: counted here and read by the caller.
    joined = materialise(align_by_row_id(predictions, labels))
    if joined.count() != predictions.count():
        return align_by_content(predictions, labels)
    return joined


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Rows per (actual, predicted) pair."""
    return pairs.groupBy("actual", "predicted").agg(F.count("*").alias("count"))


def _class_array(counts: DataFrame, labels: Sequence[str] | None) -> DataFrame:
    if labels is not None:
        listed = F.array(*[F.lit(label) for label in labels])
        return counts.sparkSession.range(1).select(listed.alias("_classes"))
    both = counts.select(F.explode(F.array("actual", "predicted")).alias("class"))
    return both.agg(F.collect_set("class").alias("_classes"))


def confusion_matrix(counts: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Every (actual, predicted) cell with its count, zero cells included.

    Without ``labels`` the classes are those that occur on either side. The grid is
    one row per cell of the result.
    """
    grid = (
        _class_array(counts, labels)
        .select("_classes", F.explode("_classes").alias("actual"))
        .select("actual", F.explode("_classes").alias("predicted"))
    )
    count = F.coalesce(F.col("count"), F.lit(0).cast("long")).alias("count")
    return grid.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", count
    )


def confusion_table(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Confusion matrix with one row per actual and one column per predicted class."""
    cells = confusion_matrix(counts, labels)
    return cells.groupBy("actual").pivot("predicted", list(labels)).agg(F.sum("count"))


def _ratio(above: Column, below: Column) -> Column:
    """Division as double, 0 for a zero denominator."""
    share = above.cast("double") / F.nullif(below.cast("double"), F.lit(0.0))
    return F.coalesce(share, F.lit(0.0))


def class_report(counts: DataFrame, labels: Sequence[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 for zero denominators."""
    right = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(F.lit(0))
    nothing = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("actual").alias("class"),
            right.cast("long").alias("hits"),
            F.col("count").alias("support"),
            nothing.alias("predicted_rows"),
        ),
        F.struct(
            F.col("predicted").alias("class"),
            nothing.alias("hits"),
            nothing.alias("support"),
            F.col("count").alias("predicted_rows"),
        ),
    )
    summed = counts.select(F.inline(sides)).groupBy("class").agg(
        F.sum("hits").alias("hits"),
        F.sum("support").alias("support"),
        F.sum("predicted_rows").alias("predicted_rows"),
    )
    if labels is not None:
        wanted = _class_array(counts, labels).select(F.explode("_classes").alias("class"))
        summed = wanted.join(summed, "class", "left").na.fill(0)
    precision = _ratio(F.col("hits"), F.col("predicted_rows"))
    recall = _ratio(F.col("hits"), F.col("support"))
    rated = summed.select(
        "class", precision.alias("precision"), recall.alias("recall"), "support"
    )
    p, r = F.col("precision"), F.col("recall")
    f1 = _ratio(2 * p * r, p + r).alias("f1")
    return rated.select("class", "precision", "recall", f1, "support")


def accuracy(counts: DataFrame) -> DataFrame:
    """One row: samples compared and share of equal pairs (null without rows)."""
    hit = F.col("actual") == F.col("predicted")
    total = F.sum("count")
    hits = F.coalesce(F.sum(F.when(hit, F.col("count"))), F.lit(0))
    return counts.agg(
        F.coalesce(total, F.lit(0).cast("long")).alias("samples_compared"),
        (hits.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))).alias("accuracy"),
    )


def metric_averages(report: DataFrame) -> DataFrame:
    """Macro and support-weighted precision, recall and F1 of a class report."""
    support = F.sum("support").cast("double")

    def weighted(column: str) -> Column:
        total = F.sum(F.col(column) * F.col("support").cast("double"))
        return F.coalesce(total / F.nullif(support, F.lit(0.0)), F.lit(0.0))

    columns = []
    for name in ("precision", "recall", "f1"):
        columns.append(F.avg(name).alias(f"{name}_macro"))
        columns.append(weighted(name).alias(f"{name}_weighted"))
    return report.agg(*columns)


def label_distribution(
    df: DataFrame, group: str = "category", label: str = "predicted_sentiment"
) -> DataFrame:
    """Rows per (group, label) and per label over all groups (null group), sorted."""
    counted = df.groupBy(group, label).agg(F.count("*").alias("count"))
    combined = counted.groupBy(label).agg(F.sum("count").alias("count"))
    combined = combined.select(F.lit(None).cast("string").alias(group), label, "count")
    both = counted.select(F.col(group).cast("string").alias(group), label, "count")
    return both.unionByName(combined).orderBy(
        F.col(group).asc_nulls_last(), F.desc("count"), F.asc(label)
    )
