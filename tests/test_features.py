import math
import random
from collections import Counter

import pytest
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from termloom.models.vectoriser import fit_vectoriser
from termloom.operators import features as ft
from termloom.operators import grams
from termloom.operators import scale, scoring

WORDS = "alpha beta gamma delta the omega kappa food a7 x".split()


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(11)
    texts = [" ".join(pick.choices(WORDS, k=pick.randint(0, 25))) for _ in range(60)]
    return texts + ["", "the the", "x"]


@pytest.fixture
def docs(spark, corpus):
    return spark.createDataFrame(list(enumerate(corpus)), "row_id long, text string").repartition(3)


def terms_by_hand(text, settings):
    if settings.characters:
        found = []
        for word in text.lower().split():
            padded = f" {word} "
            if len(padded) < settings.low:
                found.append(padded)
                continue
            for n in range(settings.low, settings.high + 1):
                found += [padded[i : i + n] for i in range(len(padded) - n + 1)]
        return found
    words = [w for w in text.lower().split() if len(w) > 1 and w != "the"]
    return [
        " ".join(words[i : i + n])
        for n in range(settings.low, settings.high + 1)
        for i in range(len(words) - n + 1)
    ]


def tfidf_by_hand(texts, settings):
    counted = [Counter(terms_by_hand(text, settings)) for text in texts]
    df = Counter(term for c in counted for term in c)
    cf = sum(counted, Counter())
    kept = {t for t in df if settings.min_df <= df[t] <= settings.max_df * len(texts)}
    if settings.max_features is not None:
        import hashlib

        order = sorted(kept, key=lambda t: (-cf[t], hashlib.md5(t.encode()).hexdigest()))
        kept = set(order[: settings.max_features])
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}
    result = {}
    for row_id, c in enumerate(counted):
        raw = {
            t: (1 + math.log(n) if settings.sublinear else n) * idf[t]
            for t, n in c.items()
            if t in kept
        }
        length = math.sqrt(sum(w * w for w in raw.values()))
        result.update({(row_id, t): w / length for t, w in raw.items()})
    return result


SETTINGS = [
    ft.Features(),
    ft.Features(low=1, high=2, min_df=2, max_df=0.8, sublinear=True),
    ft.Features(low=1, high=3, min_df=3, max_features=25, sublinear=True),
    ft.Features(low=1, high=2, max_features=10),
    ft.Features(low=3, high=5, characters=True, min_df=2, sublinear=True),
    ft.Features(low=4, high=6, characters=True, max_features=40),
]


@pytest.mark.parametrize("settings", SETTINGS)
def test_tfidf_equals_the_formulas(docs, corpus, settings):
    found = {(r["row_id"], r["term"]): r["weight"] for r in ft.tfidf(docs, settings).collect()}
    expected = tfidf_by_hand(corpus, settings)
    assert found.keys() == expected.keys()
    for key, weight in expected.items():
        assert found[key] == pytest.approx(weight, abs=1e-12)


@pytest.mark.parametrize("settings", [SETTINGS[1], SETTINGS[2], SETTINGS[4]])
def test_vectoriser_equals_the_long_table(docs, settings):
    model = fit_vectoriser(docs, settings, text="text")
    names = model.stages[1].vocabulary
    found = {}
    for row in model.transform(docs).select("row_id", "word").collect():
        vector = row["word"]
        assert isinstance(vector, SparseVector)
        for i, value in zip(vector.indices, vector.values):
            found[row["row_id"], names[i]] = value
    expected = {(r["row_id"], r["term"]): r["weight"] for r in ft.tfidf(docs, settings).collect()}
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(v, abs=1e-9) for k, v in expected.items())


def test_large_vocabulary_is_split_and_filtered(docs, monkeypatch):
    settings = SETTINGS[1]
    usual = {tuple(r)[:2]: r["weight"] for r in ft.tfidf(docs, settings).collect()}
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(ft, "BROADCAST_ROWS", 3)
    split = ft.tfidf(docs, settings)
    plan = split._jdf.queryExecution().toString()
    assert "Union" in plan and "_bits" in plan
    found = {tuple(r)[:2]: r["weight"] for r in split.collect()}
    assert found.keys() == usual.keys()
    assert all(found[k] == pytest.approx(usual[k]) for k in usual)


def test_the_vocabulary_is_exact(docs):
    """Whatever its size: the vectors hold the weights of the long table."""
    model = fit_vectoriser(docs, SETTINGS[4], text="text")
    long = ft.tfidf(docs, SETTINGS[4])
    vocabulary = model.stages[1].vocabulary
    assert len(vocabulary) == long.select("term").distinct().count()
    found = {}
    for r in model.transform(docs).select("row_id", "word").collect():
        for i, w in zip(r["word"].indices, r["word"].values, strict=True):
            found[r["row_id"], vocabulary[i]] = w
    want = {(r["row_id"], r["term"]): r["weight"] for r in long.collect()}
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k]) for k in want)


def test_feature_union_keeps_parts_apart(docs):
    parts = {"word": ft.tfidf(docs, SETTINGS[0]), "char": ft.tfidf(docs, SETTINGS[4])}
    united = ft.feature_union(parts)
    counted = united.groupBy(F.split_part("term", F.lit("__"), F.lit(1)).alias("p")).count()
    assert {r["p"]: r["count"] for r in counted.collect()} == {
        name: part.count() for name, part in parts.items()
    }


def test_linear_scores_keep_documents_without_terms(spark):
    features = spark.createDataFrame(
        [(1, "good", 2.0), (1, "odd", 1.0), (2, None, None), (3, "bad", 1.0)],
        "row_id long, term string, weight double",
    )
    long = spark.createDataFrame(
        [("positive", "good", 1.5), ("negative", "bad", 2.0)],
        "sentiment string, term string, weight double",
    )
    weights = scoring.wide_weights(long)
    scored = scoring.linear_scores(features, weights, weights.count(), {"neutral": 0.5})
    found = {r["row_id"]: r for r in scored.select("*", scoring.best_class().alias("b")).collect()}
    assert (found[1]["positive"], found[1]["b"]) == (3.0, "positive")
    assert (found[2]["neutral"], found[2]["b"]) == (0.5, "neutral")
    assert (found[3]["negative"], found[3]["b"]) == (2.0, "negative")


def test_ties_go_to_the_first_class(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (0.0, 2.0, 2.0)], "positive double, neutral double, negative double")
    assert [r[0] for r in df.select(scoring.best_class()).collect()] == ["negative", "negative"]


@pytest.mark.parametrize("batch", ["10000", "1", "7"])
def test_external_model_does_not_depend_on_the_batch(spark, docs, batch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    def load():
        return lambda texts: ["long" if len(t) > 60 else "short" for t in texts]

    df = docs.withColumn("group", F.lit(None).cast("string"))
    found = scoring.predict_with(df, load).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == docs.count()
    assert all(r["group"] == "unknown" for r in found)
    assert all((r["predicted_sentiment"] == "long") == (len(r["text"]) > 60) for r in found)


def vocabulary_of(spark, idf):
    return spark.createDataFrame(sorted(idf.items()), "term string, idf double")


def test_membership_filter_holds_back_no_member(spark):
    terms = spark.range(5_000).select(F.concat(F.lit("t"), "id").alias("term"))
    members = ft.membership_filter(terms.where("term like '%7%'"))
    assert members.count() <= ft.FILTER_WORDS
    passed = {r["term"] for r in ft.possible_terms(terms, members).collect()}
    wanted = {f"t{k}" for k in range(5_000) if "7" in str(k)}
    assert wanted <= passed
    # Three bits in one of 262,144 words: hardly any other term passes.
    assert len(passed - wanted) < 50


def test_membership_filter_of_no_terms_lets_nothing_pass(spark):
    none = spark.createDataFrame([], "term string")
    found = spark.createDataFrame([("a",), ("",)], "term string")
    assert ft.possible_terms(found, ft.membership_filter(none)).count() == 0


@pytest.mark.parametrize(
    ("limit", "often"), [(0, ""), (1, "a"), (2, "a"), (3, "abc"), (4, "abcd"), (9, "abcdef")]
)
def test_split_vocabulary_keeps_equal_frequencies_together(spark, limit, often):
    terms = vocabulary_of(spark, dict(zip("abcdef", [1.0, 2.0, 2.0, 3.0, 4.0, 4.0], strict=True)))
    near, far = ft.split_vocabulary(terms, limit)
    assert "".join(sorted(r["term"] for r in near.collect())) == often
    assert "".join(sorted(r["term"] for r in far.collect())) == "abcdef"[len(often) :]


@pytest.mark.parametrize("rows", [7, None])
@pytest.mark.parametrize("limit", [0, 1, 3, 6, 100])
def test_vocabulary_join_is_a_plain_join(spark, limit, rows):
    """A third of all rows hold one term; half of the terms are unknown."""
    pick = random.Random(limit)
    idf = {f"w{k}": 1.0 + k // 2 for k in range(7)}
    pairs = [(i, "w0", 1) for i in range(60)]
    pairs += [(i, f"w{k}", 1 + k) for i in range(60) for k in pick.sample(range(1, 14), 2)]
    found = spark.createDataFrame(pairs, "row_id long, term string, tf int").repartition(3)
    got = ft.vocabulary_join(found, vocabulary_of(spark, idf), rows, limit)
    wanted = sorted((i, t, tf, idf[t]) for i, t, tf in pairs if t in idf)
    assert sorted((r["row_id"], r["term"], r["tf"], r["idf"]) for r in got.collect()) == wanted


def test_vocabulary_join_of_empty_tables(spark):
    found = spark.createDataFrame([(1, "a", 1)], "row_id long, term string, tf int")
    none = vocabulary_of(spark, {"a": 1.0}).where("false")
    assert ft.vocabulary_join(found, none, None).count() == 0
    assert ft.vocabulary_join(found.where("false"), vocabulary_of(spark, {"a": 1.0}), None, 0).count() == 0


def test_no_loop_join_beyond_a_broadcast_vocabulary(spark):
    found = spark.createDataFrame([(1, "a", 1), (1, "b", 1)], "row_id long, term string, tf int")
    joined = ft.vocabulary_join(found, vocabulary_of(spark, {"a": 1.0, "b": 2.0}), 2, 1)
    plan = joined._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_large_weights_are_split_and_filtered(spark, monkeypatch):
    """Frequent terms are broadcast, rare ones shuffled; every document stays."""
    pick = random.Random(5)
    pairs = [(i, f"w{k}", float(1 + k)) for i in range(40) for k in pick.sample(range(12), 4)]
    pairs += [(i, None, None) for i in range(40, 43)] + [(50, "odd", 1.0), (None, "w1", 1.0)]
    rows = spark.createDataFrame(pairs, "row_id long, term string, weight double").repartition(3)
    made = [(f"w{k}", k / 8, 1.0 - k / 8, 0.5, -(20 - k)) for k in range(9)]
    weights = spark.createDataFrame(
        made, "term string, negative double, neutral double, positive double, rank long"
    )
    usual = sorted(map(str, scoring.linear_scores(rows, weights, 9, {"neutral": 0.25}).collect()))
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 3)
    split = scoring.linear_scores(rows, weights, 9, {"neutral": 0.25}, rank="rank")
    plan = split._jdf.queryExecution().toString()
    assert "_bits" in plan and "_salt" not in plan
    assert sorted(map(str, split.collect())) == usual
    assert len(usual) == 45


@pytest.mark.parametrize("settings", [SETTINGS[0], SETTINGS[1], SETTINGS[4], SETTINGS[5]])
def test_terms_of_a_large_vocabulary_are_not_shuffled_by_document(docs, monkeypatch, settings):
    usual = {tuple(r)[:2]: r["weight"] for r in ft.tfidf(docs, settings).collect()}
    monkeypatch.setattr(ft, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(ft, "TASK_CHARACTERS", 300)
    split = ft.tfidf(docs, settings)
    found = {tuple(r)[:2]: r["weight"] for r in split.collect()}
    assert found.keys() == usual.keys()
    assert all(found[k] == pytest.approx(usual[k]) for k in usual)
    # The window reads the terms as the texts lie: texts and rare terms are moved, then nothing.
    plan = split._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window"):]
    assert window.index("Generate") < window.index("Exchange")


def test_rare_terms_of_repeated_and_missing_ids(spark, monkeypatch):
    rows = [(1, "aa bb cc"), (1, "cc dd dd"), (None, "bb dd ee"), (None, None), (2, "aa ee ff")]
    df = spark.createDataFrame(rows, "row_id long, text string")
    for settings in (SETTINGS[0], ft.Features(low=3, high=5, characters=True)):
        usual = sorted((str(r["row_id"]), r["term"], round(r["weight"], 9)) for r in ft.tfidf(df, settings).collect())
        with monkeypatch.context() as patch:
            patch.setattr(ft, "BROADCAST_ROWS", 2)
            found = ft.tfidf(df, settings).collect()
        assert sorted((str(r["row_id"]), r["term"], round(r["weight"], 9)) for r in found) == usual


@pytest.mark.parametrize("settings", [SETTINGS[0], SETTINGS[1], SETTINGS[4]])
def test_terms_are_counted_by_marks_and_not_as_strings(docs, corpus, monkeypatch, settings):
    def strings(*_, **__):
        raise AssertionError("terms are shuffled as strings")

    for name in ("document_counts", "corpus_statistics", "rare_terms"):
        monkeypatch.setattr(ft, name, strings)
    found = {(r["row_id"], r["term"]): r["weight"] for r in ft.tfidf(docs, settings).collect()}
    expected = tfidf_by_hand(corpus, settings)
    assert found.keys() == expected.keys()
    assert all(found[k] == pytest.approx(w, abs=1e-12) for k, w in expected.items())


@pytest.mark.parametrize("settings", [SETTINGS[0], SETTINGS[1], ft.Features(low=2, high=3), SETTINGS[4], ft.Features(low=4, high=6, characters=True)])
def test_texts_in_pieces_and_buckets_in_chunks(spark, corpus, monkeypatch, settings):
    rows = [*enumerate(corpus), (3, corpus[5]), (3, corpus[6]), (None, corpus[7]), (None, corpus[8]), (None, None), (90, "größe 𝄞a größe")]
    df = spark.createDataFrame(rows, "row_id long, text string").repartition(3)

    def found():
        return sorted((str(r["row_id"]), r["term"], round(r["weight"], 9)) for r in ft.tfidf(df, settings).collect())

    usual = found()
    # The rows of a repeated id have one length together.
    squares = {}
    for row_id, _, weight in usual:
        squares[row_id] = squares.get(row_id, 0.0) + weight**2
    assert {"3", "None"} <= set(squares) and all(v == pytest.approx(1.0, abs=1e-6) for v in squares.values())
    for name, value in {"PIECE": 3, "CHUNK": 5, "KEPT": 0, "ROWS": 4, "RANGE_CHARACTERS": 200}.items():
        monkeypatch.setattr(grams, name, value)
    monkeypatch.setattr(ft, "TASK_CHARACTERS", 500)
    assert found() == usual
