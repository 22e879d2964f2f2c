"""Linear scoring: weights joined to term rows, or a caller's own model."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions.labels import SENTIMENTS
from termloom.operators import documents, features as ft, scale
from termloom.operators.scale import lookup_join, rewritten


def wide_weights(weights: DataFrame, classes: Sequence[str] = SENTIMENTS) -> DataFrame:
    """Long weights ``(sentiment, term, weight)`` as one row per term, 0 if absent."""
    wide = weights.groupBy("term").pivot("sentiment", list(classes)).agg(F.sum("weight"))
    return wide.na.fill(0.0, list(classes))


def linear_scores(
    features: DataFrame,
    weights: DataFrame,
    weight_rows: int | None,
    intercepts: Mapping[str, float] | None = None,
    classes: Sequence[str] = SENTIMENTS,
    rank: str | None = None,
) -> DataFrame:
    """Score of every class per document: ``row_id`` and one column per class.

    ``features`` has ``row_id, term, weight``; a null term keeps a document without
    terms. ``weights`` has a row per term and a column per class, so each feature row
    is joined once, and products are summed before the shuffle. ``rank`` names a column of
    ``weights`` that falls with the frequency of a term: of more weights than a broadcast
    holds, those of the frequent terms are broadcast then, and only feature rows of rare
    terms are shuffled; ``weights`` should be a table and is read several times.
    """
    held = [F.col(c).alias(f"_w_{c}") for c in classes]
    renamed = weights.select("term", *held)
    if rank is None or weight_rows is None or weight_rows <= scale.BROADCAST_ROWS:
        joined = lookup_join(features, renamed, ["term"], weight_rows, "row_id", "left")
    else:
        ranked = weights.select("term", *held, F.col(rank).alias("_rank"))
        parts = ft.split_vocabulary(ranked, scale.BROADCAST_ROWS, "_rank")
        often, rare = [part.drop("_rank") for part in parts]
        members = rewritten(ft.membership_filter(rare), "filter")
        # Every row passes the first join, so that no document is lost; there a rare term adds nothing.
        near = features.join(F.broadcast(often), "term", "left")
        joined = near.unionByName(ft.possible_terms(features, members).join(rare, "term"))
    start = intercepts or {}
    products = [
        (
            F.coalesce(F.sum(F.col("weight") * F.col(f"_w_{c}")), F.lit(0.0))
            + F.lit(float(start.get(c, 0.0)))
        ).alias(c)
        for c in classes
    ]
    return joined.groupBy("row_id").agg(*products)


def best_class(classes: Sequence[str] = SENTIMENTS, digits: int | None = None) -> Column:
    """Class with the highest score column; ties go to the alphabetically first."""
    ordered = sorted(classes)
    if len(ordered) == 1:
        return F.lit(ordered[0])
    scores = {c: F.col(c) if digits is None else F.round(F.col(c), digits) for c in ordered}
    highest = F.greatest(*scores.values())
    chain = [F.when(scores[c] == highest, F.lit(c)) for c in ordered]
    return reduce(lambda chosen, other: F.coalesce(chosen, other), chain)


def predict_with(
    df: DataFrame, load: Callable[[], Callable[[pd.Series], Sequence[str]]]
) -> DataFrame:
    """Score documents with a model that only Python can run.

    ``load`` runs once per task and returns a function from the texts of one Arrow
    batch to labels. The size of a batch is Spark's
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` and does not change the result. A
    ``load`` defined inside a function travels with the job; one that lives in a module
    of the caller needs that module on the workers (``SparkContext.addPyFile``).
    """

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = load()
        for batch in batches:
            yield batch.assign(predicted_sentiment=[str(c) for c in predict(batch["text"])])

    row_id = F.col("row_id").cast("long").alias("row_id")
    rows = documents.normalise(df.withColumn("row_id", row_id), keep=["row_id"])
    schema = "row_id long, text string, group string, predicted_sentiment string"
    return rows.mapInPandas(score, schema).select(
        "row_id", "group", "text", "predicted_sentiment"
    )
