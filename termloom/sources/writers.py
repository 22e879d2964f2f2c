"""Writers for predictions, reports, statistics, splits, runs and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.labels import REPORT_ORDER
from termloom.sources.readers import EXACT

QUOTED = {
    "header": True,
    "quoteAll": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_csv(df: DataFrame, path: str, exact: bool = False, mode: str = "errorifexists") -> None:
    """Fully quoted CSV with a header; ``exact`` keeps null and "" apart."""
    writer = df.write.mode(mode).options(**QUOTED)
    if exact:
        writer = writer.options(**EXACT)
    writer.csv(path)


def write_predictions(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    ordered: bool = True,
    exact: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Predictions in row-id order (a range partitioning, no driver step)."""
    rows = df.select("row_id", "group", "text", "predicted_sentiment")
    rows = rows.orderBy("row_id") if ordered else rows
    if fmt == "csv":
        write_csv(rows, path, exact, mode)
    else:
        rows.write.mode(mode).format(fmt).save(path)


def report_document(report: DataFrame, sentiments: Sequence[str] = REPORT_ORDER) -> DataFrame:
    """Global report as one row with a list per sentiment, in rank order."""
    return _nested(report, [], sentiments)


def group_report_documents(
    report: DataFrame, sentiments: Sequence[str] = ("positive", "negative")
) -> DataFrame:
    """Report by group as one row per group with a list per sentiment."""
    return _nested(report, ["group"], sentiments)


def write_group_report(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report by group as lines ``{group: {list per sentiment}}``, one group in each."""
    documents = group_report_documents(report)
    lists = F.struct(*[c for c in documents.columns if c != "group"])
    line = F.to_json(F.create_map("group", lists)).alias("value")
    documents.select(line).write.mode(mode).text(path)


def _nested(report: DataFrame, keys: list[str], sentiments: Sequence[str]) -> DataFrame:
    fields = ["rank", "term", "count"]
    fields += ["examples"] if "examples" in report.columns else []
    entry = F.struct(*fields)

    def ranked(sentiment: str):
        mine = F.collect_list(F.when(F.col("sentiment") == sentiment, entry))
        plain = F.transform(F.sort_array(mine), lambda e: e.dropFields("rank"))
        return plain.alias(f"top_{sentiment}_terms")

    return report.groupBy(*keys).agg(*[ranked(s) for s in sentiments])


def statistics_document(statistics: DataFrame, overall: DataFrame) -> DataFrame:
    """Work statistics as one row: a map by sentiment and the overall list."""
    numbers = [c for c in statistics.columns if c != "sentiment"]
    by_sentiment = statistics.agg(
        F.map_from_entries(F.collect_list(F.struct("sentiment", F.struct(*numbers))))
    )
    order = F.struct((-F.col("count")).alias("n"), "term", "sentiment")
    entry = F.struct(order.alias("order"), F.struct("term", "sentiment", "count").alias("e"))
    listed = overall.agg(F.transform(F.sort_array(F.collect_list(entry)), lambda x: x["e"]))
    return statistics.sparkSession.range(1).select(
        by_sentiment.scalar().alias("sentiment_statistics"),
        listed.scalar().alias("top_terms_overall"),
    )


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines; used for reports, statistics, validation and metadata."""
    df.write.mode(mode).json(path)


def run_summary(
    spark: SparkSession,
    processed_docs: int,
    top_n: int,
    elapsed_seconds: float,
    paths: dict[str, str],
) -> DataFrame:
    """One-row record of a run; append it to a runs table with ``write_json``."""
    row = {
        "processed_docs": processed_docs,
        "top_n": top_n,
        "elapsed_seconds": float(elapsed_seconds),
        **{f"{name}_path": path for name, path in paths.items()},
    }
    return spark.createDataFrame([row]).withColumn("created_at", F.current_timestamp())


def write_split(
    df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists"
) -> None:
    """Train/test rows ``text, sentiment, group``, one folder per split."""
    rows = df.select("text", "sentiment", "group", "split")
    writer = rows.write.mode(mode).partitionBy("split")
    if fmt == "csv":
        writer.options(**QUOTED).csv(path)
    else:
        writer.format(fmt).save(path)


def write_runs(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Run-metrics CSV with header and six columns."""
    columns = ["max_docs", "chunk_size", "workers", "elapsed_seconds", "processed_docs"]
    rows = df.select(*columns, "speedup_vs_first_chunk")
    rows.write.mode(mode).csv(path, header=True)


def save_model(model: PipelineModel, path: str) -> None:
    """Save vectoriser and classifier together."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a model saved by ``save_model``."""
    return PipelineModel.load(path)


def validation_document(
    check: DataFrame, common: DataFrame, found: dict[str, DataFrame]
) -> DataFrame:
    """Validation report as one row: term check with its most common terms, and
    accuracy, class report and confusion matrix of ``jobs.validate``.

    Every input has a row per class, pair of classes or listed term.
    """
    order = F.struct((-F.col("count")).alias("n"), "first_row_id", "term")
    listed = common.agg(
        F.transform(
            F.sort_array(F.collect_list(order)),
            lambda e: F.array(e["term"], (-e["n"]).cast("string")),
        )
    )
    fields = ["class", "precision", "recall", "f1", F.col("support").cast("long").alias("support")]
    lines = found["report"].select(F.lit(0).alias("part"), *fields)
    total = found["report"].agg(F.sum("support").cast("long")).scalar()
    none = F.lit(None).cast("double")
    parts = [F.lit(1).alias("part"), F.lit("accuracy").alias("class"), none.alias("precision")]
    parts += [none.alias("recall"), F.col("accuracy").alias("f1"), total.alias("support")]
    lines = lines.unionByName(found["accuracy"].select(*parts))
    for part, name, suffix in ((2, "macro avg", "macro"), (3, "weighted avg", "weighted")):
        values = [F.col(f"{x}_{suffix}").alias(x) for x in ("precision", "recall", "f1")]
        lines = lines.unionByName(
            found["averages"].select(
                F.lit(part).alias("part"), F.lit(name).alias("class"), *values, total.alias("support")
            )
        )
    value = F.struct("precision", "recall", F.col("f1").alias("f1-score"), "support")
    entries = F.sort_array(F.collect_list(F.struct("part", "class", value.alias("value"))))
    plain = F.transform(entries, lambda e: F.struct(e["class"], e["value"]))
    classes = lines.agg(F.map_from_entries(plain))
    cells = F.sort_array(F.collect_list(F.struct("predicted", "count")))
    lines = (
        found["matrix"].groupBy("actual").agg(F.transform(cells, lambda c: c["count"]).alias("row"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("actual", "row")))
    matrix = lines.agg(F.transform(ordered, lambda line: line["row"]))
    terms = check.select(F.struct(*check.columns, listed.scalar().alias("top_terms")))
    metrics = found["accuracy"].select(
        F.struct(
            "samples_compared",
            "accuracy",
            classes.scalar().alias("classification_report"),
            matrix.scalar().alias("confusion_matrix"),
        )
    )
    return check.sparkSession.range(1).select(
        terms.scalar().alias("term_frequency_validation"),
        metrics.scalar().alias("sentiment_validation"),
    )
