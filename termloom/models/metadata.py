"""Record of a training run: data, candidate scores, parameters and metrics."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.labels import SENTIMENTS
from termloom.models.candidates import Candidate
from termloom.models.selection import test_metrics
from termloom.operators.documents import corpus_counts
from termloom.operators.metrics import class_report, confusion_matrix

# Columns of the training data whose values are counted.
COUNTED = {"category": "rows_by_category", "label": "rows_by_label",
           "source_dataset": "rows_by_source_dataset"}


def parameters(candidate: Candidate) -> dict[str, dict[str, str]]:
    """Settings of a candidate as text, by part of the model."""
    found = {
        name: {k: str(v) for k, v in dataclasses.asdict(part).items()}
        for name, part in candidate.parts()
    }
    rest = ("classifier", "strength", "max_iter", "balanced")
    found["classifier"] = {name: str(getattr(candidate, name)) for name in rest}
    return found


def training_record(
    data: DataFrame,
    scores: DataFrame,
    counts: DataFrame,
    candidate: Candidate,
    seed: int = 42,
    sample_rows: int = 60_000,
) -> DataFrame:
    """One row with everything worth keeping about a trained model.

    ``data`` is aggregated in one pass; the other inputs have a row per candidate or
    per pair of classes.
    """
    rows = corpus_counts(data, list(COUNTED)).where(F.col("value").isNotNull())
    maps = [
        F.map_from_entries(
            F.sort_array(
                F.collect_list(F.when(F.col("dimension") == c, F.struct("value", "count")))
            )
        ).alias(name)
        for c, name in COUNTED.items()
    ]
    total = F.sum(F.when(F.col("dimension") == "label", F.col("count"))).alias("total_rows")
    training = rows.agg(F.struct(total, *maps))
    entry = F.struct("candidate_index", "model_name", "accuracy", "f1_macro")
    listed = scores.agg(F.sort_array(F.collect_list(entry)))
    selected = scores.where("selected").select("model_name")
    overall = test_metrics(counts)
    per_class = F.struct("class", "precision", "recall", "f1", "support")
    classes = class_report(counts, SENTIMENTS).agg(F.sort_array(F.collect_list(per_class)))
    cell = F.struct("actual", "predicted", "count")
    matrix = confusion_matrix(counts, SENTIMENTS).agg(F.sort_array(F.collect_list(cell)))
    parts = {
        "selected_candidate": selected,
        "candidate_validation_scores": listed,
        "training_data": training,
        "metrics": overall.select(F.struct(*overall.columns)),
        "classification_report": classes,
        "confusion_matrix": matrix,
    }
    settings = F.create_map(
        *[
            item
            for name, values in parameters(candidate).items()
            for item in (
                F.lit(name),
                F.create_map(*[F.lit(x) for pair in values.items() for x in pair]),
            )
        ]
    )
    return data.sparkSession.range(1).select(
        *[part.scalar().alias(name) for name, part in parts.items()],
        settings.alias("model_parameters"),
        F.array(*[F.lit(c) for c in SENTIMENTS]).alias("label_format"),
        F.lit(seed).alias("random_state"),
        F.lit(sample_rows).alias("sample_size_per_dataset"),
        F.current_timestamp().alias("created_at"),
    )
