import dataclasses

import pytest
from pyspark.sql import functions as F

from helpers import rows
from termloom.models import candidates as cd
from termloom.models import selection, vectoriser, weights
from termloom.models.metadata import training_record
from termloom.operators import documents, features, scoring
from termloom.plans import jobs
from termloom.sources import readers, writers

TOPICS = {
    "negative": "awful terrible broken rude stale",
    "neutral": "table chair window street number",
    "positive": "great lovely superb tasty friendly",
}


@pytest.fixture(scope="module")
def corpus(spark):
    data = []
    for i in range(90):
        label = list(TOPICS)[i % 3]
        words = TOPICS[label].split()
        data.append((i, label, f"shop {words[i % 5]} {words[(i // 3) % 5]} item{i % 7}", "shops"))
    return spark.createDataFrame(data, "row_id long, label string, model_input string, group string")


def test_candidates_are_the_eight():
    names = [c.name for c in cd.CANDIDATES]
    assert len(set(names)) == 8 and names[-1] == "high_data_accuracy_logreg"


def test_class_weights(spark):
    df = spark.createDataFrame([("negative",)] * 2 + [("positive",)] * 6, "label string")
    found = {r["label"]: r["class_weight"] for r in cd.class_weights(df).collect()}
    assert found == {"negative": 2.0, "positive": pytest.approx(8 / 12)}


@pytest.mark.parametrize("index", [0, 3, 4, 7])
def test_candidates_learn_separable_classes(corpus, index):
    model = cd.fit_candidate(corpus, cd.CANDIDATES[index], max_iter=30)
    counts = selection.evaluate(model, corpus)
    assert selection.test_metrics(counts).first()["accuracy"] == 1.0


def test_saved_model_scores_alike_and_equals_relational_scores(spark, corpus, folder):
    model = cd.fit_candidate(corpus, cd.CANDIDATES[0], max_iter=20)
    writers.save_model(model, folder)
    loaded = writers.load_model(folder)
    ours = rows(selection.predicted(model, corpus, ["row_id"]))
    assert rows(selection.predicted(loaded, corpus, ["row_id"])) == ours
    table, intercepts = weights.weights_of(spark, loaded)
    vectoriser = loaded.stages[0].stages[0]
    pairs = list(zip(vectoriser.stages[1].vocabulary, map(float, vectoriser.stages[2].getScalingVec())))
    vocabulary = spark.createDataFrame(pairs, "term string, idf double")
    found = features.term_frequencies(corpus, cd.CANDIDATES[0].words.terms, "model_input")
    weighed = features.weigh(found, vocabulary, len(pairs))
    scored = scoring.linear_scores(weighed, table, len(pairs), intercepts)
    assert rows(scored.select("row_id", scoring.best_class())) == ours


def test_selection_takes_the_best_and_refits(corpus):
    weak = dataclasses.replace(
        cd.CANDIDATES[0], name="weak", words=features.Features(min_df=60)
    )
    model, scores = selection.select_model(corpus, [weak, cd.CANDIDATES[1]], max_iter=20)
    found = {r["model_name"]: r for r in scores.collect()}
    assert found["improved_tfidf_sublinear"]["selected"] and not found["weak"]["selected"]
    assert selection.test_metrics(selection.evaluate(model, corpus)).first()["accuracy"] == 1.0


def test_training_record(spark, corpus, folder):
    data = corpus.withColumns({"category": F.col("group"), "source_dataset": F.lit("set")})
    scores = spark.createDataFrame(
        [(0, "baseline", 0.9, 0.8, True)], selection.SCORES + ", selected boolean"
    )
    counts = spark.createDataFrame(
        [("positive", "positive", 3), ("negative", "positive", 1)],
        "actual string, predicted string, count long",
    )
    record = training_record(data, scores, counts, cd.CANDIDATES[0])
    writers.write_json(record, folder)
    found = spark.read.json(folder).first()
    assert found["training_data"]["total_rows"] == 90
    assert found["training_data"]["rows_by_label"]["neutral"] == 30
    assert found["selected_candidate"] == "baseline"
    assert found["metrics"]["accuracy"] == 0.75
    assert found["model_parameters"]["word"]["max_features"] == "50000"
    assert len(found["confusion_matrix"]) == 9


def test_prepare_training_and_score(spark, corpus):
    raw = corpus.select("row_id", F.col("model_input").alias("text"), F.pmod("row_id", F.lit(3)).alias("label"))
    sources = []
    for name in ("movies", "tweets"):
        source = readers.labelled(raw, name, f"set-{name}")
        sources.append(source.withColumn("row_id", F.monotonically_increasing_id()))
    split, cleaning = jobs.prepare_training(sources, sample_rows=50)
    assert tuple(cleaning.first()) == (100, 100, 0)
    assert rows(split.groupBy("category").count()) == [("movies", 50), ("tweets", 50)]
    assert split.select("row_id").distinct().count() == 100
    by_class = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
    for label in {label for label, _ in by_class}:
        total = by_class[label, "train"] + by_class[label, "test"]
        assert by_class[label, "test"] == int(0.2 * total + 0.5)
    model = cd.fit_candidate(corpus, cd.CANDIDATES[1], max_iter=10)
    unlabelled = [readers.labelled(raw, "movies", "set", None), readers.labelled(raw, "tweets", "set", None)]
    scored = jobs.score_sources(unlabelled, model)
    assert scored.count() == 180
    combined = jobs.label_distribution(scored).where("category is null")
    assert combined.agg(F.sum("count")).first()[0] == 180


def test_score_numbers_documents_without_ids(corpus):
    model = cd.fit_candidate(corpus, cd.CANDIDATES[1], max_iter=10)
    docs = corpus.select(F.col("model_input").alias("text"), "group")
    found = jobs.score(docs, model, max_docs=40)
    assert sorted(r["row_id"] for r in found.collect()) == list(range(40))
    assert found.columns == ["row_id", "group", "text", "predicted_sentiment"]
    kept, count = jobs.keep_predictions(found)
    assert count == 40
    kept.unpersist()
    assert documents.first_rows(kept, 3).count() == 3


def test_vocabulary_reaches_the_model_in_a_few_calls(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(["größe 𝄞a word stall", "word 𝄞a x1 größe", "word"])]
    df = spark.createDataFrame(rows, "row_id long, model_input string")

    def one_by_one(*_):
        raise AssertionError("a call for every term")

    monkeypatch.setattr(vectoriser.CountVectorizerModel, "_new_java_array", one_by_one)
    model = vectoriser.fit_vectoriser(df, features.Features(low=1, high=2))
    terms = model.stages[1].vocabulary
    assert {"größe", "word", "word stall", "x1 größe"} <= set(terms) and terms == sorted(terms)
    assert model.stages[1].getOrDefault("vocabSize") == len(terms)
    found = {r["row_id"]: r["word_counts"] for r in model.transform(df).collect()}
    assert found[2].indices.tolist() == [terms.index("word")]


def test_queries_fit_on_every_labelled_row(spark, folder, monkeypatch):
    """Models, splits and counts come from all labelled documents, not from a sample of them."""
    from catalog import queries

    docs = [(i, f"word{i % 7} stall{i % 5} shop", "en", f"s{i % 3}") for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    frame.write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame([(i, i % 2, int(i % 5 == 0)) for i in range(50)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{folder}/labels.parquet")
    monkeypatch.setattr(queries, "TRAINING_ROWS", 20, raising=False)
    rows = queries._training(spark, folder)
    assert rows.count() == 50 and rows.select("row_id").distinct().count() == 50
    assert {r["row_id"] for r in queries.logreg_predictions(spark, folder).collect()} == set(range(50))
    assert tuple(queries.saved_model(spark, folder).first()) == (50, 50)


def test_blocks_hold_the_vectors_of_the_pipeline(spark, monkeypatch):
    """Features cut from texts at once are those that the stages make, a column at a time."""
    texts = ["größe 𝄞a word stall", "word 𝄞a x1 größe the a", "", None, "a b c", "stall word stall word stall größe x1 x1"]
    data = [(i, t, "positive" if i % 2 else "negative") for i, t in enumerate(texts * 3)] + [(99, "word", "odd")]
    df = spark.createDataFrame(data, "row_id long, model_input string, label string").repartition(3)
    chars = features.Features(low=3, high=5, characters=True, min_df=2, sublinear=True)
    given = [
        cd.Candidate("plain", features.Features(low=1, high=2, max_features=6)),
        cd.Candidate("threes", features.Features(low=2, high=3, min_df=2, sublinear=True)),
        cd.Candidate("both", features.Features(low=1, high=2, sublinear=True), chars, "svm"),
        cd.Candidate("long", features.Features(max_features=5), features.Features(low=4, high=4, characters=True)),
    ]
    vectors, columns, widths = cd.vectorisers(df, given)

    def transformed(*_):
        raise AssertionError("the stages cut every text anew")

    with monkeypatch.context() as patch:
        patch.setattr(vectoriser.TermArray, "_transform", transformed)
        found = cd.feature_blocks(df, vectors, widths, "label", len(data)).collect()
    rows = vectors.transform(df.where("label <> 'odd'")).select("label", *columns).collect()

    def row(label, entries):
        return label, tuple(tuple(sorted((int(i), round(float(v), 9)) for i, v in e if v)) for e in entries)

    expected = sorted(
        row({"negative": 0, "positive": 2}[r["label"]], [enumerate(r[c].toArray()) for c in columns]) for r in rows
    )
    ours = []
    for block in found:
        for k, label in enumerate(block.labels.tolist()):
            held = []
            for c in columns:
                m = block.matrices[c]
                own = slice(m.starts[k], m.starts[k] + m.lengths[k] - 1)
                held.append(zip(m.indices[own], m.values[own], strict=True))
            ours.append(row(label, held))
    assert sorted(ours) == expected and len(ours) == 18
