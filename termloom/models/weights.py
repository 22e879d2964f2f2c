"""A fitted logistic model as a weights table for relational scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from termloom.functions.labels import SENTIMENTS


def weights_of(spark: SparkSession, model: PipelineModel) -> tuple[DataFrame, dict[str, float]]:
    """Term weights (a column per class) and intercepts of a one-part logistic model.

    The table has one row per vocabulary term, so ``max_features`` bounds it.
    """
    vectors, fitted = model.stages[0], model.stages[1]
    vectoriser = vectors.stages[0]
    vocabulary = vectoriser.stages[1].vocabulary
    matrix = fitted.coefficientMatrix.toArray()
    rows = [
        (term, *(float(matrix[c][i]) for c in range(len(SENTIMENTS))))
        for i, term in enumerate(vocabulary)
    ]
    schema = "term string, " + ", ".join(f"{c} double" for c in SENTIMENTS)
    intercepts = dict(zip(SENTIMENTS, map(float, fitted.interceptVector), strict=True))
    return spark.createDataFrame(rows, schema), intercepts
