"""Frames that the registered queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import text as tx
from termloom.functions.labels import SENTIMENTS
from termloom.operators import features, scoring, terms
from termloom.operators.scale import materialise, rewritten, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """All documents: ``row_id, group, text`` and further columns."""
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), F.col("source").alias("group"), "text", *more
    )
    return spread(rows, "row_id")


def labelled(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Documents with a label: ``row_id, sentiment, group, text`` and further columns."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("row_id"), sentiment().alias("sentiment")
    )
    return docs(spark, sf_dir, *more).join(labels, "row_id")


def sentiment() -> Column:
    return (
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .otherwise("neutral")
    )


def guessed(n_chars: Column) -> Column:
    """A prediction by text length, to have something to compare with labels."""
    return (
        F.when(n_chars < 600, "negative").when(n_chars < 1200, "neutral").otherwise("positive")
    )


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with null and blank texts and null labels; neutral without a label."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("row_id"), sentiment().alias("sentiment")
    )
    rows = docs(spark, sf_dir, "lang").join(labels, "row_id", "left")
    rows = rows.withColumn("sentiment", F.coalesce("sentiment", F.lit("neutral")))
    text = (
        F.when(F.col("group") == "src3", F.lit(None))
        .when(F.col("group") == "src4", F.lit(" \t\n"))
        .otherwise(F.col("text"))
    )
    label = F.when(F.col("lang") != "de", F.col("sentiment"))
    return rows.select("row_id", text.alias("text"), label.alias("label"), "group", "lang")


def log_odds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int, dict[str, float]]:
    """Smoothed log odds of the terms of labelled documents (``rank`` is lowest for the most
    frequent), their number and the log share of every class. Only three totals reach the driver."""
    profile = materialise(terms.corpus_profile(labelled(spark, sf_dir)))
    found = {r["sentiment"]: r for r in terms.statistics_of(profile).collect()}
    wide = terms.counts_of(profile).groupBy("term").pivot("sentiment", SENTIMENTS)
    wide = rewritten(wide.agg(F.sum("count")).na.fill(0), "counts")
    size = wide.count()
    n_docs = sum(r["document_count"] for r in found.values())

    def weight(name: str) -> Column:
        below = float(found[name]["total_term_count"] + size) if name in found else float(size)
        return F.round(F.log((F.col(name) + 1).cast("double") / F.lit(below)), 6).alias(name)

    shares = {
        name: spark.range(1)
        .select(F.round(F.log(F.lit(r["document_count"] / n_docs)), 6))
        .first()[0]
        for name, r in found.items()
    }
    rank = -sum(F.col(name) for name in SENTIMENTS)
    return wide.select("term", *map(weight, SENTIMENTS), rank.alias("rank")), size, shares


def scorer(spark: SparkSession, sf_dir: str):
    """A fixed model for the jobs: adds ``predicted_sentiment`` to rows with ``model_input``."""
    weights, size, shares = log_odds(spark, sf_dir)

    def score(df: DataFrame) -> DataFrame:
        rows = rewritten(df.withColumn("_row", F.monotonically_increasing_id()), "scored")
        runs = tx.sorted_runs(tx.report_tokens(F.col("model_input")))
        found = rows.select(F.col("_row").alias("row_id"), F.inline_outer(runs))
        found = found.select("row_id", "term", F.col("tf").cast("double").alias("weight"))
        scores = scoring.linear_scores(found, weights, size, shares, rank="rank")
        best = scoring.best_class(digits=6).alias("predicted_sentiment")
        return rows.join(scores.select(F.col("row_id").alias("_row"), best), "_row").drop("_row")

    return score


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every sentiment for every document."""
    weights, size, shares = log_odds(spark, sf_dir)
    runs = tx.sorted_runs(tx.report_tokens(F.col("text")))
    rows = docs(spark, sf_dir).select("row_id", F.inline_outer(runs))
    rows = rows.select("row_id", "term", F.col("tf").cast("double").alias("weight"))
    return scoring.linear_scores(rows, weights, size, shares, rank="rank")


def experiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics derived from documents: one run per (source, language)."""
    size = F.array_position(F.array(*map(F.lit, LANGUAGES)), F.col("lang")) * 500
    rows = table(spark, sf_dir, "documents").select(
        F.regexp_extract("source", r"(\d+)", 1).cast("long").alias("max_docs"),
        size.cast("long").alias("chunk_size"),
        "n_chars",
        "doc_id",
    )
    return rows.groupBy("max_docs", "chunk_size").agg(
        F.lit(1).cast("long").alias("workers"),
        F.min("doc_id").alias("run_seq"),
        F.count("*").alias("processed_docs"),
        (F.sum("n_chars").cast("double") / 1000.0).alias("elapsed_seconds"),
    )


LANGUAGES = ["de", "en", "es", "fr"]
WORDS = features.Features()
BIGRAMS = features.Features(low=1, high=2, min_df=2, max_df=0.98, sublinear=True)
CHARACTERS = features.Features(low=3, high=5, characters=True, min_df=2, sublinear=True)
