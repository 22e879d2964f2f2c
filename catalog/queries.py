"""One function per registered query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import frames as fr
from termloom.functions import labels as lb
from termloom.functions import text as tx
from termloom.models import candidates, metadata, relational, selection, weights
from termloom.operators import documents, features, metrics, runs, scale, scoring, terms
from termloom.plans import jobs
from termloom.sources import readers, writers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# Documents and corpus ---------------------------------------------------------


@query
def normalise_documents(spark, sf_dir):
    return documents.normalise(fr.gappy(spark, sf_dir), group_col="label", keep=["row_id"])


@query
def normalise_without_group(spark, sf_dir):
    rows = fr.gappy(spark, sf_dir).select("row_id", "text")
    return documents.normalise(rows, keep=["row_id"])


@query
def clean_training_rows(spark, sf_dir):
    return documents.drop_unusable(fr.gappy(spark, sf_dir)).select("row_id", "label", "text")


@query
def cleaning_counts(spark, sf_dir):
    return documents.cleaning_counts(fr.gappy(spark, sf_dir))


@query
def map_labels(spark, sf_dir):
    raw = F.pmod(F.col("n_chars"), F.lit(7)).cast("int")
    rows = fr.table(spark, sf_dir, "documents").select("doc_id", raw.alias("label"))
    label = F.col("label")
    return rows.select(
        F.col("doc_id").alias("row_id"),
        lb.five_class(label).alias("five"),
        lb.five_class(label, unknown="null").alias("five_strict"),
        lb.three_class(label).alias("three"),
        lb.three_class(label, unknown="null").alias("three_strict"),
    )


@query
def model_input(spark, sf_dir):
    rows = fr.gappy(spark, sf_dir)
    built = documents.model_input(rows, category="lang")
    return built.select("row_id", "model_input", "group")


def _sources(spark, sf_dir, *keep):
    written = fr.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("row_id"), "text", F.pmod("n_chars", F.lit(5)).alias("label")
    )
    spoken = fr.table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"),
        "text",
        F.pmod(F.length("text"), F.lit(3)).alias("label"),
    )
    return [
        readers.labelled(written, "articles", "documents", keep=keep),
        readers.labelled(spoken, "talks", "conversations", lb.three_class, keep=keep),
    ]


@query
def union_sources(spark, sf_dir):
    return documents.union_sources(_sources(spark, sf_dir))


@query
def corpus_counts(spark, sf_dir):
    rows = documents.union_sources(_sources(spark, sf_dir))
    return documents.corpus_counts(rows, ["category", "label", "source_dataset"])


@query
def preview(spark, sf_dir):
    return documents.preview(fr.docs(spark, sf_dir))


@query
def first_n_documents(spark, sf_dir):
    return documents.first_rows(fr.docs(spark, sf_dir), 100)


@query
def row_numbers(spark, sf_dir):
    rows = fr.table(spark, sf_dir, "documents").orderBy("doc_id").select("doc_id", "text")
    return scale.number_rows(rows)


@query
def file_row_numbers(spark, sf_dir):
    return scale.number_files(spark, f"{sf_dir}/documents.parquet").select("row_id", "doc_id")


@query
def prepare_training(spark, sf_dir):
    split, _ = jobs.prepare_training(_sources(spark, sf_dir, "row_id"), sample_rows=300)
    return split.select("row_id", "group", "label", "model_input", "split")


@query
def exact_sample(spark, sf_dir):
    rows = fr.docs(spark, sf_dir).select("row_id", "group")
    return documents.exact_sample(rows, 60)


@query
def exact_sample_by_group(spark, sf_dir):
    rows = fr.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "lang")
    return documents.exact_sample(rows, 40, by=["lang"])


@query
def stratified_split(spark, sf_dir):
    rows = fr.labelled(spark, sf_dir).select("row_id", F.col("sentiment").alias("label"))
    return documents.stratified_split(rows, 0.2)


@query
def ordinals(spark, sf_dir):
    rows = fr.docs(spark, sf_dir)
    keyed = rows.select("row_id", scale.digest(F.col("text")).alias("key"))
    return scale.ordinals(keyed, ["key"]).select("row_id", "ordinal")


# Tokenisers -------------------------------------------------------------------


def _counts(spark, sf_dir, tokenise):
    return terms.term_counts(fr.docs(spark, sf_dir), [], tokenise)


@query
def tokenise_report(spark, sf_dir):
    return _counts(spark, sf_dir, tx.report_tokens)


@query
def tokenise_check(spark, sf_dir):
    return _counts(spark, sf_dir, tx.check_tokens)


@query
def tokenise_plain(spark, sf_dir):
    return _counts(spark, sf_dir, tx.plain_tokens)


@query
def token_sizes(spark, sf_dir):
    size = F.size(tx.report_tokens(F.col("text"))).cast("long").alias("tokens")
    return fr.docs(spark, sf_dir).select("row_id", size)


def _escaped(spark, sf_dir):
    text = F.replace(F.col("text"), F.lit("\n"), F.lit("\\n"))
    return fr.docs(spark, sf_dir).withColumn("text", text)


@query
def escape_cleaning(spark, sf_dir):
    return _escaped(spark, sf_dir).select(
        "row_id",
        tx.clean_escapes(F.col("text")).alias("cleaned"),
        tx.clean_escapes(F.col("text"), strict=True).alias("cleaned_strict"),
    )


@query
def escaped_term_counts(spark, sf_dir):
    return terms.term_counts(_escaped(spark, sf_dir), [], tx.report_tokens)


# Terms ------------------------------------------------------------------------


@query
def term_counts(spark, sf_dir):
    return terms.term_counts(fr.labelled(spark, sf_dir))


@query
def term_counts_by_group(spark, sf_dir):
    rows = terms.in_sentiments(fr.labelled(spark, sf_dir), ["positive", "negative"])
    return terms.term_counts(rows, ["group", "sentiment"], tx.plain_tokens)


@query
def top_terms_by_sentiment(spark, sf_dir):
    return terms.top_terms(terms.term_counts(fr.labelled(spark, sf_dir)), 20)


def _predictions(spark, sf_dir):
    return fr.labelled(spark, sf_dir).withColumnRenamed("sentiment", "predicted_sentiment")


@query
def top_terms_by_group(spark, sf_dir):
    return jobs.term_report(_predictions(spark, sf_dir), 20, by_group=True)


@query
def term_examples(spark, sf_dir):
    rows = fr.labelled(spark, sf_dir)
    winners = scale.materialise(terms.top_terms(terms.term_counts(rows), 20))
    found = terms.term_examples(rows, winners, winner_rows=60)
    rank = F.col("example_rank").cast("long").alias("example_rank")
    return found.select("sentiment", "term", rank, "row_id", "message")


@query
def term_report(spark, sf_dir):
    report = jobs.term_report(_predictions(spark, sf_dir), 20)
    messages = F.array_join(F.transform("examples", lambda e: e["message"]), "|")
    return report.select("sentiment", "rank", "term", "count", messages.alias("examples"))


@query
def work_statistics(spark, sf_dir):
    statistics, _ = jobs.work_statistics(_predictions(spark, sf_dir))
    average = F.round("average_tokens_per_doc", 6)
    return statistics.withColumn("average_tokens_per_doc", average)


@query
def top_terms_overall(spark, sf_dir):
    return terms.top_terms_overall(terms.term_counts(fr.labelled(spark, sf_dir)))


@query
def merged_top_terms(spark, sf_dir):
    report = jobs.term_report(_predictions(spark, sf_dir), 20, by_group=True)
    return terms.merged_top_terms(report, 10)


@query
def bounded_top_terms(spark, sf_dir):
    """Exact top terms over all groups from lists of 20, with the bounds that the lists gave."""
    rows = terms.in_sentiments(fr.labelled(spark, sf_dir), ["positive", "negative"])
    counts = scale.materialise(terms.term_counts(rows, ["group", "sentiment"], tx.plain_tokens))
    return terms.bounded_top_terms(counts, 10)


@query
def distinct_term_sketches(spark, sf_dir):
    """Distinct terms per sentiment and in all from sketches by group, against the exact counts."""
    rows = fr.labelled(spark, sf_dir)
    path = _folder(spark)
    terms.term_sketches(rows, ["group", "sentiment"]).write.parquet(path)
    saved = spark.read.parquet(path)
    exact = scale.materialise(terms.term_counts(rows))
    by_sentiment = terms.distinct_terms(saved, ["sentiment"]).join(
        exact.groupBy("sentiment").agg(F.count("*").alias("exact")), "sentiment"
    )
    whole = exact.agg(F.countDistinct("term").alias("exact")).scalar().alias("exact")
    overall = terms.distinct_terms(saved).select(F.lit("all").alias("sentiment"), "distinct_terms", whole)
    near = F.abs(F.col("distinct_terms") - F.col("exact")) <= 0.03 * F.col("exact")
    both = by_sentiment.unionByName(overall)
    return both.select("sentiment", "exact", near.alias("within_error"))


@query
def most_common_terms(spark, sf_dir):
    return terms.most_common_terms(fr.docs(spark, sf_dir))


def _rounded(check):
    return check.withColumn("match_ratio", F.round("match_ratio", 6))


@query
def term_frequency_check(spark, sf_dir):
    rows = _escaped(spark, sf_dir)
    return _rounded(terms.term_frequency_check(rows, None, tx.check_tokens, tx.report_tokens))


@query
def first_rows_frequency_check(spark, sf_dir):
    rows = fr.docs(spark, sf_dir)
    return _rounded(terms.term_frequency_check(rows, 50, tx.check_tokens, tx.plain_tokens))


# Metrics ----------------------------------------------------------------------


def _guesses(spark, sf_dir):
    rows = fr.docs(spark, sf_dir, "n_chars")
    return rows.withColumn("predicted_sentiment", fr.guessed(F.col("n_chars"))).drop("n_chars")


def _shifted_labels(spark, sf_dir):
    return fr.labelled(spark, sf_dir).withColumn("row_id", F.col("row_id") + 1)


@query
def align_by_row_id(spark, sf_dir):
    return metrics.align_by_row_id(_guesses(spark, sf_dir), fr.labelled(spark, sf_dir))


@query
def align_by_content(spark, sf_dir):
    return metrics.align_by_content(_guesses(spark, sf_dir), _shifted_labels(spark, sf_dir))


@query
def align_auto(spark, sf_dir):
    return metrics.align(_guesses(spark, sf_dir), _shifted_labels(spark, sf_dir))


def _pairs(spark, sf_dir):
    rows = fr.labelled(spark, sf_dir, "n_chars")
    guess = fr.guessed(F.col("n_chars")).alias("predicted")
    return metrics.pair_counts(rows.select(F.col("sentiment").alias("actual"), guess))


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_pairs(spark, sf_dir), lb.SENTIMENTS)


@query
def confusion_table(spark, sf_dir):
    return metrics.confusion_table(_pairs(spark, sf_dir), lb.SENTIMENTS)


def _six(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def classification_report(spark, sf_dir):
    report = metrics.class_report(_pairs(spark, sf_dir))
    return _six(report, "precision", "recall", "f1")


@query
def metric_averages(spark, sf_dir):
    averages = metrics.metric_averages(metrics.class_report(_pairs(spark, sf_dir)))
    return _six(averages, *averages.columns)


@query
def accuracy(spark, sf_dir):
    return _six(metrics.accuracy(_pairs(spark, sf_dir)), "accuracy")


@query
def validation(spark, sf_dir):
    found = jobs.validate(_guesses(spark, sf_dir), _shifted_labels(spark, sf_dir))
    return _six(found["report"], "precision", "recall", "f1")


def _charts(spark, sf_dir):
    report = jobs.term_report(_predictions(spark, sf_dir), 20, by_group=True)
    counts, guesses = _pairs(spark, sf_dir), _guesses(spark, sf_dir)
    speedup = runs.run_speedup(fr.experiments(spark, sf_dir))
    return jobs.chart_data(speedup, counts, report, guesses)


@query
def chart_labels(spark, sf_dir):
    """The label counts among the chart tables."""
    return _charts(spark, sf_dir)["label_counts"]


@query
def chart_runtime(spark, sf_dir):
    return _charts(spark, sf_dir)["runtime"]


@query
def chart_speedup(spark, sf_dir):
    return _six(_charts(spark, sf_dir)["speedup"], "speedup_vs_first_chunk")


@query
def chart_confusion(spark, sf_dir):
    return _charts(spark, sf_dir)["confusion_matrix"]


@query
def chart_top_positive(spark, sf_dir):
    return _charts(spark, sf_dir)["top_positive"]


@query
def chart_top_negative(spark, sf_dir):
    return _charts(spark, sf_dir)["top_negative"]


@query
def label_distribution(spark, sf_dir):
    rows = _guesses(spark, sf_dir).withColumnRenamed("group", "category")
    return jobs.label_distribution(rows)


# Features and scoring -----------------------------------------------------------


@query
def document_frequency(spark, sf_dir):
    rows = fr.docs(spark, sf_dir)
    found = features.term_statistics(features.term_frequencies(rows, fr.BIGRAMS.terms))
    return features.document_frequency(found, rows.count(), fr.BIGRAMS)


@query
def most_frequent_terms(spark, sf_dir):
    rows = fr.docs(spark, sf_dir)
    settings = features.Features(max_features=1000)
    found = features.corpus_statistics(rows, settings)
    return features.document_frequency(found, rows.count(), settings)


def _weights(df):
    return df.withColumn("weight", F.round("weight", 6))


@query
def tfidf_word(spark, sf_dir):
    return _weights(features.tfidf(fr.docs(spark, sf_dir), fr.WORDS))


@query
def tfidf_bigram(spark, sf_dir):
    return _weights(features.tfidf(fr.docs(spark, sf_dir), fr.BIGRAMS))


def _summary(weights_table):
    return weights_table.groupBy("row_id").agg(
        F.count("*").alias("terms"),
        F.round(F.sum("weight"), 4).alias("weight_sum"),
        F.round(F.max("weight"), 6).alias("weight_max"),
    )


@query
def tfidf_char(spark, sf_dir):
    return _summary(features.tfidf(fr.docs(spark, sf_dir), fr.CHARACTERS))


@query
def tfidf_union(spark, sf_dir):
    rows = fr.docs(spark, sf_dir)
    parts = {name: features.tfidf(rows, s) for name, s in
             {"word": fr.BIGRAMS, "char": fr.CHARACTERS}.items()}
    united = features.feature_union(parts)
    part = F.split_part("term", F.lit("__"), F.lit(1)).alias("part")
    return united.groupBy(part).agg(
        F.count("*").alias("features"), F.round(F.sum("weight"), 2).alias("weight_sum")
    )


@query
def balanced_weights(spark, sf_dir):
    rows = fr.labelled(spark, sf_dir).select(F.col("sentiment").alias("label"))
    return _six(candidates.class_weights(rows), "class_weight")


@query
def linear_scoring_matrix(spark, sf_dir):
    return _six(fr.scored(spark, sf_dir), *lb.SENTIMENTS)


@query
def linear_scoring(spark, sf_dir):
    best = scoring.best_class(digits=6).alias("predicted_sentiment")
    return fr.scored(spark, sf_dir).select("row_id", best)


@query
def linear_confusion(spark, sf_dir):
    predictions = linear_scoring(spark, sf_dir)
    pairs = metrics.align_by_row_id(predictions, fr.labelled(spark, sf_dir))
    return metrics.confusion_matrix(metrics.pair_counts(pairs), lb.SENTIMENTS)


@query
def external_model(spark, sf_dir):
    def load():  # defined here, so that it travels with the job
        return lambda texts: pd.cut(
            texts.str.len(), [-1, 599, 1199, float("inf")],
            labels=["negative", "neutral", "positive"],
        )

    found = scoring.predict_with(fr.docs(spark, sf_dir), load)
    return found.groupBy("group", "predicted_sentiment").agg(F.count("*").alias("count"))


# Runs and candidates ----------------------------------------------------------------


@query
def run_speedup(spark, sf_dir):
    return _six(runs.run_speedup(fr.experiments(spark, sf_dir)), "speedup_vs_first_chunk")


@query
def run_series(spark, sf_dir):
    return runs.run_series(fr.experiments(spark, sf_dir))


@query
def run_table(spark, sf_dir):
    return runs.run_table(fr.experiments(spark, sf_dir), [500, 1000, 1500, 2000])


@query
def candidate_selection(spark, sf_dir):
    rows = fr.labelled(spark, sf_dir, "n_chars", "lang")
    by_language = F.when(F.col("lang") == "de", "negative").otherwise("positive")
    guesses = {"length": fr.guessed(F.col("n_chars")), "language": by_language,
               "constant": F.lit("positive")}
    scores = []
    for index, (name, guess) in enumerate(guesses.items()):
        pairs = rows.select(F.col("sentiment").alias("actual"), guess.alias("predicted"))
        both = selection.test_metrics(scale.materialise(metrics.pair_counts(pairs)))
        scores.append(both.select(F.lit(index).alias("candidate_index"),
                                  F.lit(name).alias("model_name"),
                                  F.round("accuracy", 6).alias("accuracy"),
                                  F.round("f1_macro", 6).alias("f1_macro")))
    return runs.best_candidate(documents.union_sources(scores))


# Sources and sinks ----------------------------------------------------------------


def _folder(spark):
    return f"{scale.shared_folder(spark).rstrip('/')}/out-{uuid.uuid4().hex}"


@query
def csv_roundtrip(spark, sf_dir):
    path = _folder(spark)
    writers.write_predictions(_guesses(spark, sf_dir), path, "csv", exact=True)
    return readers.read_predictions(spark, path, "csv", exact=True)


@query
def parquet_roundtrip(spark, sf_dir):
    path = _folder(spark)
    writers.write_predictions(_guesses(spark, sf_dir), path)
    return readers.read_predictions(spark, path, "parquet")


@query
def report_roundtrip(spark, sf_dir):
    path = _folder(spark)
    report = jobs.term_report(_predictions(spark, sf_dir), 20)
    writers.write_json(writers.report_document(report), path)
    found = readers.read_report(spark, path)
    return found.select("sentiment", "rank", "term", "count", F.size("examples").cast("long")
                        .alias("examples"))


@query
def group_report_roundtrip(spark, sf_dir):
    path = _folder(spark)
    report = jobs.term_report(_predictions(spark, sf_dir), 20, by_group=True)
    writers.write_group_report(report, path)
    found = readers.read_report(spark, path, by_group=True, lines=True)
    return found.select("group", "sentiment", "term", "count", "rank")


@query
def csv_sources(spark, sf_dir):
    """A labelled and an unlabelled source, read from CSV files."""
    path = _folder(spark)
    label = F.pmod("n_chars", F.lit(5)).alias("label")
    writers.write_csv(fr.table(spark, sf_dir, "documents").select("doc_id", "text", label), path)
    labelled = readers.read_labelled(spark, path, "articles", "documents", keep=["doc_id"])
    plain = readers.read_labelled(spark, path, "plain", "documents", mapping=None, keep=["doc_id"])
    both = labelled.unionByName(plain, allowMissingColumns=True)
    text = F.coalesce("text", F.lit("")).alias("text")
    row_id = F.col("doc_id").cast("long").alias("row_id")
    return both.select(row_id, text, "label", "category", "source_dataset")


@query
def statistics_roundtrip(spark, sf_dir):
    path = _folder(spark)
    both = jobs.work_statistics(_predictions(spark, sf_dir))
    writers.write_json(writers.statistics_document(*both), path)
    listed = "top_terms_overall array<struct<term:string,sentiment:string,count:bigint>>"
    return spark.read.schema(listed).json(path).select(F.inline("top_terms_overall"))


@query
def validation_roundtrip(spark, sf_dir):
    path = _folder(spark)
    rows = fr.docs(spark, sf_dir)
    check = terms.term_frequency_check(rows, None)
    found = jobs.validate(_guesses(spark, sf_dir), _shifted_labels(spark, sf_dir))
    document = writers.validation_document(check, terms.most_common_terms(rows), found)
    writers.write_json(document, path)
    saved = readers.read_validation(spark, path)
    averages = F.from_json(
        F.element_at("sentiment_validation.classification_report", F.lit("weighted avg")),
        "support long, recall double",
    )
    cells = F.flatten("sentiment_validation.confusion_matrix")
    total = F.aggregate(cells, F.lit(0).cast("long"), lambda a, b: a + b)
    return saved.select(
        "term_frequency_validation.checked_rows",
        "term_frequency_validation.unique_terms",
        "term_frequency_validation.token_total",
        F.get(F.get("term_frequency_validation.top_terms", F.lit(0)), F.lit(1))
        .cast("long")
        .alias("highest_count"),
        "sentiment_validation.samples_compared",
        F.round("sentiment_validation.accuracy", 6).alias("accuracy"),
        total.alias("matrix_total"),
        averages["support"].alias("support"),
        F.round(averages["recall"], 6).alias("weighted_recall"),
    )


@query
def split_roundtrip(spark, sf_dir):
    path = _folder(spark)
    rows = fr.labelled(spark, sf_dir).withColumn("label", F.col("sentiment"))
    writers.write_split(documents.stratified_split(rows, 0.2), path)
    saved = spark.read.parquet(path)
    return saved.groupBy("split", "sentiment").agg(F.count("*").alias("count"))


#: Characters of a CSV file with line breaks in its fields, which one task reads.
FILE_CHARACTERS = 32_000_000


@query
def ground_truth_validation(spark, sf_dir):
    """Labels from CSV files, numbered by position, against predictions with row ids."""
    path = _folder(spark)
    labels = fr.table(spark, sf_dir, "labels").select("doc_id", fr.sentiment().alias("sentiment"))
    rows = fr.table(spark, sf_dir, "documents").join(labels, "doc_id", "left")
    rows = rows.select("doc_id", "text", F.coalesce("sentiment", F.lit("neutral")).alias("sentiment"))
    # Files in the order of the ids; texts have line breaks, so that a task reads a file whole.
    characters = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    files = max(3, -(-characters // FILE_CHARACTERS))
    writers.write_csv(rows.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id"), path)
    truth = readers.read_ground_truth(spark, path).select("row_id", "sentiment")
    ids = fr.docs(spark, sf_dir, "n_chars").select("row_id", "n_chars")
    numbered = scale.ordinals(ids.withColumn("_all", F.lit(0)), ["_all"], name="position")
    guess = fr.guessed(F.col("n_chars")).alias("predicted_sentiment")
    found = jobs.validate(numbered.select(F.col("position").alias("row_id"), guess), truth, "row_id")
    return _six(found["report"], "precision", "recall", "f1")


@query
def held_out_report(spark, sf_dir):
    """Class report of a fixed model on the saved test split, the only folder that is read."""
    path = _folder(spark)
    rows = fr.labelled(spark, sf_dir).withColumn("label", F.col("sentiment"))
    writers.write_split(documents.stratified_split(rows, 0.2), path)
    report = jobs.held_out(spark, path, fr.scorer(spark, sf_dir))
    return _six(report, "precision", "recall", "f1")


def _fixed_run(spark, sf_dir):
    source, path = _folder(spark), _folder(spark)
    fr.docs(spark, sf_dir).write.parquet(source)
    return path, jobs.run(spark, source, path, fr.scorer(spark, sf_dir), fmt="parquet")


@query
def run_summary(spark, sf_dir):
    """The record of a complete run but for its time and paths."""
    path, _ = _fixed_run(spark, sf_dir)
    saved = spark.read.schema("processed_docs long, top_n long, elapsed_seconds double").json(f"{path}/runs")
    return saved.select("processed_docs", "top_n", (F.col("elapsed_seconds") > 0).alias("timed"))


@query
def run_label_counts(spark, sf_dir):
    """What a complete run with a fixed model has saved."""
    path, _ = _fixed_run(spark, sf_dir)
    saved = readers.read_predictions(spark, f"{path}/predictions", "parquet")
    return jobs.label_distribution(saved, "group")


@query
def scored_sources(spark, sf_dir):
    """Two unlabelled sources scored with their category in front of the text."""
    sources = [s.drop("label") for s in _sources(spark, sf_dir)]
    return jobs.label_distribution(jobs.score_sources(sources, fr.scorer(spark, sf_dir)))


@query
def training_metadata(spark, sf_dir):
    """Fields of the saved record of a training, without its time."""
    path = _folder(spark)
    rows = fr.labelled(spark, sf_dir, "lang").select(
        "row_id", F.col("sentiment").alias("label"), F.col("lang").alias("category"), F.lit("documents").alias("source_dataset")
    )
    scores = spark.createDataFrame([(0, "baseline", 0.9, 0.8, True)], selection.SCORES + ", selected boolean")
    record = metadata.training_record(rows, scores, _pairs(spark, sf_dir), candidates.CANDIDATES[0])
    writers.write_json(record, path)
    saved = spark.read.json(path)
    by_label = [
        F.coalesce(F.col(f"training_data.rows_by_label.{c}"), F.lit(0)).cast("long").alias(c) for c in lb.SENTIMENTS
    ]
    return saved.select(
        "selected_candidate", "training_data.total_rows", *by_label,
        F.round("metrics.accuracy", 6).alias("accuracy"), F.round("metrics.f1_macro", 6).alias("f1_macro"),
        F.size("confusion_matrix").cast("long").alias("cells"), "random_state",
        F.col("created_at").isNotNull().alias("timed"),
    )


@query
def runs_roundtrip(spark, sf_dir):
    path = _folder(spark)
    writers.write_runs(runs.run_speedup(fr.experiments(spark, sf_dir)), path)
    return _six(readers.read_runs(spark, path), "speedup_vs_first_chunk")


# Models (no SQL: iterative fits) -------------------------------------------------------


def _training(spark, sf_dir):
    """Every labelled document with its split; models are fitted on the whole of ``train``."""
    rows = fr.labelled(spark, sf_dir, "lang").withColumnRenamed("sentiment", "label")
    built = documents.model_input(rows, category="lang")
    return scale.materialise(
        documents.stratified_split(built.select("row_id", "group", "label", "model_input"), 0.2)
    )


def _fitted(spark, sf_dir, name):
    rows = _training(spark, sf_dir)
    chosen = next(c for c in candidates.CANDIDATES if c.name == name)
    train = rows.where(F.col("split") == "train")
    return rows, candidates.fit_candidate(train, chosen)


@query
def logreg_predictions(spark, sf_dir):
    rows, model = _fitted(spark, sf_dir, "high_data_accuracy_logreg")
    return selection.predicted(model, rows, ["row_id", "split", "label"])


@query
def saved_model(spark, sf_dir):
    """A model that was saved and loaded decides like the one that was fitted."""
    rows, model = _fitted(spark, sf_dir, "baseline")
    path = _folder(spark)
    writers.save_model(model, path)
    first = selection.predicted(model, rows, ["row_id"])
    again = selection.predicted(writers.load_model(path), rows, ["row_id"])
    both = first.join(again.withColumnRenamed("predicted_sentiment", "again"), "row_id")
    same = F.count_if(F.col("predicted_sentiment") == F.col("again")).alias("same")
    return both.agg(F.count("*").alias("documents"), same)


@query
def complete_run(spark, sf_dir):
    """Score all documents with a fitted model and write every output."""
    _, model = _fitted(spark, sf_dir, "high_data_accuracy_logreg")
    source, path = _folder(spark), _folder(spark)
    fr.docs(spark, sf_dir, "lang").drop("row_id").write.parquet(source)
    jobs.run(spark, source, path, model, fmt="parquet", category_col="lang")
    saved = readers.read_predictions(spark, f"{path}/predictions", "parquet")
    return jobs.label_distribution(saved, "group")


@query
def svm_predictions(spark, sf_dir):
    rows, model = _fitted(spark, sf_dir, "linear_svm_word_ngrams")
    return selection.predicted(model, rows, ["row_id", "split", "label"])


@query
def relational_logreg(spark, sf_dir):
    """Scores of the fitted model by joins; must agree with the model's own."""
    rows, model = _fitted(spark, sf_dir, "baseline")
    table, intercepts = weights.weights_of(spark, model)
    vectors = model.stages[0].stages[0]
    idf = vectors.stages[2].getScalingVec()
    pairs = list(zip(vectors.stages[1].vocabulary, map(float, idf), strict=True))
    vocabulary = spark.createDataFrame(pairs, "term string, idf double")
    settings = candidates.CANDIDATES[0].words
    found = features.term_frequencies(rows, settings.terms, "model_input")
    weighed = features.weigh(found, vocabulary, len(pairs))
    kept = rows.select("row_id").join(weighed, "row_id", "left")
    scores = scoring.linear_scores(kept, table, len(pairs), intercepts)
    return scores.select("row_id", scoring.best_class().alias("predicted_sentiment"))


@query
def relational_training(spark, sf_dir):
    """Labels by a model that was trained without its coefficients in the driver."""
    rows = _training(spark, sf_dir)
    train = rows.where(F.col("split") == "train")
    found = features.corpus_statistics(train, fr.BIGRAMS, "model_input")
    n = train.count()
    vocabulary = scale.rewritten(
        features.with_idf(features.document_frequency(found, n, fr.BIGRAMS), n).select("term", "idf"), "vocabulary"
    )
    size = vocabulary.count()
    weighed = features.term_frequencies(rows, fr.BIGRAMS.terms, "model_input")
    weighed = scale.rewritten(features.weigh(weighed, vocabulary, size, fr.BIGRAMS.sublinear), "weights")
    weights_of = {r["label"]: r["class_weight"] for r in candidates.class_weights(train).collect()}
    fitted = relational.train(weighed, train.select("row_id", "label"), 1.0, weights_of, tolerance=1e-3)
    kept = rows.select("row_id").join(weighed, "row_id", "left")
    table = scale.rewritten(fitted.weights.join(vocabulary, "term"), "weights")
    scores = scoring.linear_scores(kept, table, size, fitted.intercepts, rank="idf")
    return rows.select("row_id", "split", "label").join(
        scores.select("row_id", scoring.best_class().alias("predicted_sentiment")), "row_id"
    )


@query
def model_selection(spark, sf_dir):
    train = _training(spark, sf_dir).where(F.col("split") == "train").drop("split")
    _, scores = selection.select_model(train)
    return scores
