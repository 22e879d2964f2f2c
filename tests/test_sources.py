import json
import pathlib

import pytest

from helpers import rows
from termloom.functions import labels as lb
from termloom.models import candidates as cd
from termloom.operators import metrics, runs, terms
from termloom.plans import jobs
from termloom.sources import readers, writers

HARD = [
    (0, "g", 'say "hi", ok', "positive"),
    (1, "g", "two\nlines\r\nthree", "neutral"),
    (2, "g", "  blanks  ", "negative"),
    (3, "g", "ends with \\", "positive"),
    (4, "NA", "null", "positive"),
    (5, "g", "", "neutral"),
]


@pytest.fixture
def predictions(spark):
    return spark.createDataFrame(HARD, readers.PREDICTIONS)


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_predictions_round_trip(spark, predictions, folder, fmt):
    writers.write_predictions(predictions.repartition(3), folder, fmt, exact=True)
    assert rows(readers.read_predictions(spark, folder, fmt, exact=True)) == HARD


def test_plain_csv_differs_only_in_the_empty_text(spark, predictions, folder):
    writers.write_predictions(predictions, folder, "csv")
    found = rows(readers.read_predictions(spark, folder))
    assert found[:5] == HARD[:5] and found[5][2] in (None, "")


def test_hand_written_csv(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('text,sentiment,group\n"a ""b""\nc",positive,\n,negative,g\n', encoding="utf-8")
    found = readers.read_ground_truth(spark, str(path))
    assert [tuple(r) for r in found.orderBy("row_id").collect()] == [
        (0, 'a "b"\nc', "positive", None), (1, None, "negative", "g")
    ]


def test_labelled_sources(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("text,label\ngood,4\nbad,0\nso,2\n", encoding="utf-8")
    found = readers.read_labelled(spark, str(path), "movies", "set")
    assert [r["label"] for r in found.collect()] == ["positive", "negative", "neutral"]
    tweets = readers.read_labelled(spark, str(path), "tweets", "set", lb.three_class)
    assert [r["label"] for r in tweets.collect()] == ["positive", "negative", "positive"]
    plain = readers.read_labelled(spark, str(path), "tweets", "set", None)
    assert plain.columns == ["text", "category", "source_dataset"]


def test_report_documents(spark, predictions, folder):
    report = jobs.term_report(predictions, 3)
    writers.write_json(writers.report_document(report), folder)
    text = "".join(p.read_text() for p in pathlib.Path(folder).glob("part-*"))
    document = json.loads(text)
    assert list(document) == ["top_positive_terms", "top_neutral_terms", "top_negative_terms"]
    assert list(document["top_positive_terms"][0]) == ["term", "count", "examples"]
    found = readers.read_report(spark, folder).select("sentiment", "rank", "term", "count")
    expected = report.select("sentiment", "rank", "term", "count").collect()
    assert rows(found) == sorted(tuple(r) for r in expected)


def test_report_by_group_layout(spark, tmp_path):
    path = tmp_path / "report.json"
    entry = {"term": "x", "count": 2}
    path.write_text(json.dumps({
        "movies": {"top_positive_terms": [entry], "top_negative_terms": []},
        "tweets": {"top_positive_terms": [entry, {"term": "y", "count": 1}]},
    }, indent=2))
    found = readers.read_report(spark, str(path), by_group=True)
    merged = terms.merged_top_terms(found, 5)
    assert rows(merged.select("term", "count")) == [("x", 4), ("y", 1)]


def test_group_report_documents(spark, predictions, folder):
    report = jobs.term_report(predictions, 2, by_group=True)
    writers.write_json(writers.group_report_documents(report), folder)
    found = spark.read.json(folder)
    assert {"group", "top_positive_terms", "top_negative_terms"} == set(found.columns)


def test_written_validation_document(spark, predictions, folder):
    labels = predictions.withColumnRenamed("predicted_sentiment", "sentiment")
    docs = predictions.select("row_id", "text")
    document = writers.validation_document(
        terms.term_frequency_check(docs, None),
        terms.most_common_terms(docs),
        jobs.validate(predictions, labels),
    )
    writers.write_json(document, folder)
    found = spark.read.schema(
        "term_frequency_validation struct<checked_rows:bigint,match_ratio:double,"
        "top_terms:array<array<string>>>,"
        "sentiment_validation struct<samples_compared:bigint,accuracy:double,"
        "classification_report:map<string,struct<`f1-score`:double,support:bigint>>,"
        "confusion_matrix:array<array<bigint>>>"
    ).json(folder).first()
    assert found["term_frequency_validation"]["checked_rows"] == 6
    assert found["term_frequency_validation"]["match_ratio"] == 1.0
    metrics_found = found["sentiment_validation"]
    assert (metrics_found["samples_compared"], metrics_found["accuracy"]) == (6, 1.0)
    assert metrics_found["confusion_matrix"] == [[1, 0, 0], [0, 2, 0], [0, 0, 3]]
    report = metrics_found["classification_report"]
    assert report["positive"]["support"] == 3
    assert {"accuracy", "macro avg", "weighted avg"} < set(report)
    assert report["accuracy"]["f1-score"] == report["macro avg"]["f1-score"] == 1.0
    ours = readers.read_validation(spark, folder).first()
    assert all(len(pair) == 2 for pair in ours["term_frequency_validation"]["top_terms"])
    assert ours["term_frequency_validation"]["top_terms"]
    assert json.loads(ours["sentiment_validation"]["classification_report"]["weighted avg"])["support"] == 6


def test_validation_document(spark, tmp_path):
    path = tmp_path / "v.json"
    path.write_text(json.dumps({
        "term_frequency_validation": {"checked_rows": 2, "unique_terms": 3, "token_total": 4,
            "overlap_tokens": 4, "match_ratio": 1.0, "top_terms": [["food", 17]]},
        "sentiment_validation": {"samples_compared": 2, "accuracy": 0.5,
            "classification_report": {"a": {"precision": 1.0}, "accuracy": 0.5},
            "confusion_matrix": [[1, 0], [1, 0]]},
    }, indent=1))
    found = readers.read_validation(spark, str(path)).first()
    assert found["sentiment_validation"]["confusion_matrix"] == [[1, 0], [1, 0]]
    assert found["term_frequency_validation"]["top_terms"] == [["food", "17"]]


RUNS = [(100, 500, 9.0, 0), (100, 1000, 4.5, 1), (100, 2000, 0.0, 2), (500, 500, 5.0, 3)]


def test_runs(spark, folder):
    df = spark.createDataFrame(
        [(d, c, 1, e, d, s) for d, c, e, s in RUNS],
        "max_docs long, chunk_size long, workers long, elapsed_seconds double, "
        "processed_docs long, run_seq long",
    )
    sped = runs.run_speedup(df.repartition(3))
    writers.write_runs(sped, folder)
    found = readers.read_runs(spark, folder).orderBy("max_docs", "chunk_size").collect()
    assert [r["speedup_vs_first_chunk"] for r in found] == [1.0, 2.0, None, 1.0]
    table = runs.run_table(df, [500, 1000, 2000]).collect()
    assert [tuple(r) for r in table] == [(100, 9.0, 4.5, 0.0), (500, 5.0, None, None)]


def test_best_candidate(spark):
    scores = spark.createDataFrame(
        [(0, "a", 0.7, 0.5), (1, "b", 0.8, 0.4), (2, "c", 0.8, 0.6), (3, "d", 0.8, 0.6)],
        "candidate_index int, model_name string, accuracy double, f1_macro double",
    )
    assert runs.best_candidate(scores).first()["model_name"] == "c"


def test_split_files(spark, folder):
    data = [(f"t{i}\n", "positive", "g", "test" if i % 5 == 0 else "train") for i in range(10)]
    df = spark.createDataFrame(data, "text string, sentiment string, group string, split string")
    writers.write_split(df, folder, "csv")
    assert readers.read_csv(spark, f"{folder}/split=test").count() == 2


def test_run_end_to_end(spark, tmp_path):
    data = [(i, ["negative", "positive"][i % 2], f"{['awful', 'great'][i % 2]} place {i % 5}", "g")
            for i in range(40)]
    train = spark.createDataFrame(data, "row_id long, label string, model_input string, group string")
    model = cd.fit_candidate(train, cd.CANDIDATES[1], max_iter=15)
    source = tmp_path / "in.csv"
    lines = [f'"{text}\nsecond line",{label}' for _, label, text, _ in data]
    source.write_text("text,sentiment\n" + "\n".join(lines) + "\n", encoding="utf-8")
    out = str(tmp_path / "out")
    summary = jobs.run(spark, str(source), out, model, top_n=3).first()
    assert summary["processed_docs"] == 40
    saved = readers.read_predictions(spark, f"{out}/predictions", "parquet")
    assert {r["group"] for r in saved.collect()} == {"unknown"}
    found = jobs.validate(saved, readers.read_ground_truth(spark, str(source)), "row_id")
    assert found["accuracy"].first()["accuracy"] == 1.0
    report = readers.read_report(spark, f"{out}/report")
    assert report.where("sentiment = 'positive' and term = 'great'").first()["count"] == 20
    assert spark.read.json(f"{out}/statistics").count() == 1
    assert spark.read.json(f"{out}/runs").first()["top_n"] == 3
    charts = jobs.chart_data(
        spark.createDataFrame([(100, 500, 1.0, 1.0)],
            "max_docs long, chunk_size long, elapsed_seconds double, speedup_vs_first_chunk double"),
        metrics.pair_counts(spark.createDataFrame([("a", "a")], "actual string, predicted string")),
        report, saved,
    )
    assert charts["top_positive"].first()["term"] == "great"
    assert charts["label_counts"].count() == 2
    assert charts["confusion_matrix"].count() == 1 and charts["speedup"].count() == 1


def test_held_out_rows_come_from_their_folder_alone(spark, folder):
    data = [(f"t{i}", "positive", "g", "test" if i % 4 == 0 else "train") for i in range(20)]
    df = spark.createDataFrame(data, "text string, sentiment string, group string, split string")
    writers.write_split(df, folder)
    found = readers.read_split(spark, folder, "test")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan and "= test)]" in plan
    assert found.count() == 5 and found.columns == ["text", "sentiment", "group"]


def test_ground_truth_files_grow_in_number_not_in_size(spark, monkeypatch, tmp_path):
    from catalog import queries

    tables = "/root/testdata/sf0.001"
    usual = sorted(map(str, queries.ground_truth_validation(spark, tables).collect()))
    monkeypatch.setattr(queries, "_folder", lambda _: str(tmp_path / "truth"))
    monkeypatch.setattr(queries, "FILE_CHARACTERS", 50_000)
    found = sorted(map(str, queries.ground_truth_validation(spark, tables).collect()))
    files = list((tmp_path / "truth").glob("*.csv"))
    assert len(files) > 5 and found == usual
