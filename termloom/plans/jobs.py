"""Composite jobs: scoring, reports, statistics, validation, training data, charts."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from termloom.functions import text as tx
from termloom.functions.labels import REPORT_ORDER
from termloom.models.selection import Model, evaluate, predicted
from termloom.operators import documents, metrics, runs, terms
from termloom.operators.scale import materialise, number_files, number_rows, spread
from termloom.sources import readers, writers


def score(
    docs: DataFrame,
    model: Model,
    max_docs: int | None = None,
    category_col: str | None = None,
) -> DataFrame:
    """Predictions ``row_id, group, text, predicted_sentiment``.

    Documents without a ``row_id`` are numbered in input order first. With a
    ``category_col`` its value is put in front of the text, as in training.
    """
    if "row_id" not in docs.columns:
        docs = number_rows(docs)
    if max_docs is not None:
        docs = documents.first_rows(docs, max_docs)
    keep = ["row_id", "group", "text"]
    text = F.col("text") if category_col is None else F.concat_ws(" ", category_col, "text")
    return predicted(model, docs.withColumn("model_input", text), keep)


def score_sources(
    sources: Sequence[DataFrame], model: Model
) -> DataFrame:
    """Score a union of sources with the category put in front of the text."""
    rows = documents.model_input(documents.union_sources(sources))
    # A null text leaves no input; it is scored as an empty one.
    rows = rows.withColumn("model_input", F.coalesce("model_input", F.lit("")))
    return predicted(model, rows, ["category", "text"])


def _sentiments(predictions: DataFrame) -> DataFrame:
    return predictions.withColumnRenamed("predicted_sentiment", "sentiment")


def term_report(
    predictions: DataFrame,
    top_n: int = 20,
    by_group: bool = False,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Top terms per sentiment with up to five example messages, in rank order.

    ``by_group`` ranks positive and negative terms inside every group instead, with
    the plain tokeniser and without examples. ``profile`` is a corpus profile of the
    same predictions, if there is one already.
    """
    docs = _sentiments(predictions)
    if by_group:
        keys = ["group", "sentiment"]
        both = terms.in_sentiments(docs, ["positive", "negative"])
        counts = terms.term_counts(both, keys, tx.plain_tokens)
        return terms.top_terms(counts, top_n, keys)
    profile = terms.corpus_profile(docs) if profile is None else profile
    winners = materialise(terms.top_terms(terms.counts_of(profile), top_n))
    found = terms.term_examples(
        terms.in_sentiments(docs), winners, winner_rows=top_n * len(REPORT_ORDER)
    )
    report = winners.join(terms.collect_examples(found), ["sentiment", "term"], "left")
    return report.select("sentiment", "rank", "term", "count", "examples")


def work_statistics(
    predictions: DataFrame, profile: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Statistics per sentiment and the 50 most frequent (sentiment, term) pairs."""
    if profile is None:
        profile = materialise(terms.corpus_profile(_sentiments(predictions)))
    return terms.statistics_of(profile), terms.top_terms_overall(terms.counts_of(profile))


def validate(
    predictions: DataFrame, labels: DataFrame, how: str = "auto"
) -> dict[str, DataFrame]:
    """Accuracy, class report, averages and confusion matrix after alignment."""
    pairs = metrics.align(predictions, labels, how)
    counts = materialise(metrics.pair_counts(pairs))
    report = metrics.class_report(counts)
    return {
        "accuracy": metrics.accuracy(counts),
        "report": report,
        "averages": metrics.metric_averages(report),
        "matrix": metrics.confusion_matrix(counts),
    }


def prepare_training(
    sources: Sequence[DataFrame],
    sample_rows: int = 60_000,
    fraction: float = 0.2,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Sampled, united, cleaned rows with model input and split, and the counts of
    the cleaning. Sources have ``row_id`` and the labelled columns."""
    sampled = [documents.exact_sample(source, sample_rows, seed) for source in sources]
    # At most ``sample_rows`` rows per source.
    data = materialise(documents.union_sources(sampled))
    cleaned = documents.model_input(documents.drop_unusable(data))
    # Ids repeat between sources; the source name makes them unique.
    unique = F.concat_ws("|", "source_dataset", F.col("row_id").cast("string"))
    keyed = cleaned.withColumn("row_id", unique)
    return documents.stratified_split(keyed, fraction, seed=seed), documents.cleaning_counts(data)


def held_out(spark: SparkSession, path: str, model: Model, split: str = "test") -> DataFrame:
    """Class report of a model on one split of rows saved by ``writers.write_split``.

    Only the folder of the split is read.
    """
    rows = readers.read_split(spark, path, split).withColumnRenamed("text", "model_input")
    return metrics.class_report(evaluate(model, rows, "sentiment"))


def label_distribution(predictions: DataFrame, group: str = "category") -> DataFrame:
    """Predicted labels per group and over all groups."""
    return metrics.label_distribution(predictions, group)


def chart_data(
    run_metrics: DataFrame,
    counts: DataFrame,
    report: DataFrame,
    predictions: DataFrame,
    top_n: int = 10,
) -> dict[str, DataFrame]:
    """The six chart tables: two run series, matrix, two top lists, label counts."""
    top = terms.merged_top_terms(report, top_n)
    labels = predictions.groupBy("predicted_sentiment").agg(F.count("*").alias("count"))
    return {
        "runtime": runs.run_series(run_metrics, "elapsed_seconds"),
        "speedup": runs.run_series(run_metrics, "speedup_vs_first_chunk"),
        "confusion_matrix": metrics.confusion_matrix(counts),
        "top_positive": top.where(F.col("sentiment") == "positive"),
        "top_negative": top.where(F.col("sentiment") == "negative"),
        "label_counts": labels.orderBy(F.desc("count"), "predicted_sentiment"),
    }


def run(
    spark: SparkSession,
    input_path: str,
    output_dir: str,
    model: Model,
    fmt: str = "csv",
    text_col: str = "text",
    group_col: str = "group",
    max_docs: int | None = None,
    top_n: int = 20,
    ordered: bool = False,
    category_col: str | None = None,
    predictions_fmt: str = "parquet",
) -> DataFrame:
    """Read documents, score them, write predictions, report, statistics and summary.

    Predictions are written first and read back, so a lost executor never repeats
    the scoring and nothing has to stay in memory. Rows keep the order of the input, which
    is that of the row ids where they are given here; ``ordered=True`` sorts the documents
    by row id first, the only shuffle of their texts. ``category_col`` names the column that
    the model was trained with in front of the text.
    """
    started = time.perf_counter()
    source = readers.read_table(spark, input_path, fmt)
    if "row_id" not in source.columns and fmt == "parquet":
        source = number_files(spark, input_path)
    numbered = "row_id" in source.columns
    keep = [c for c in ("row_id", category_col) if c in source.columns]
    docs = documents.normalise(source, text_col, group_col, keep)
    if numbered:
        docs = docs.withColumn("row_id", F.col("row_id").cast("long"))
    else:
        docs = number_rows(docs)
    # Sorted before scoring: the sampling of a sort would score everything twice.
    placed = docs.orderBy("row_id") if ordered else spread(docs, "row_id")
    scored = score(placed, model, max_docs, category_col)
    paths = {
        name: f"{output_dir.rstrip('/')}/{name}"
        for name in ("predictions", "report", "statistics")
    }
    # Counted while it is written.
    seen = Observation("predictions")
    scored = scored.observe(seen, F.count(F.lit(1)).alias("processed_docs"))
    writers.write_predictions(scored, paths["predictions"], predictions_fmt, ordered=False)
    saved = readers.read_predictions(spark, paths["predictions"], predictions_fmt)
    profile = materialise(terms.corpus_profile(spread(_sentiments(saved), "row_id")))
    report = term_report(saved, top_n, profile=profile)
    writers.write_json(writers.report_document(report), paths["report"])
    statistics, overall = work_statistics(saved, profile)
    writers.write_json(writers.statistics_document(statistics, overall), paths["statistics"])
    elapsed = time.perf_counter() - started
    summary = writers.run_summary(spark, seen.get["processed_docs"], top_n, elapsed, paths)
    writers.write_json(summary, f"{output_dir.rstrip('/')}/runs", mode="append")
    return summary


def keep_predictions(predictions: DataFrame) -> tuple[DataFrame, int]:
    """Persist predictions with spill and count them; call ``unpersist`` afterwards."""
    kept = predictions.persist(StorageLevel.MEMORY_AND_DISK)
    return kept, kept.count()
