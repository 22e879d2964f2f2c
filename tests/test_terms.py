from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import rows
from termloom.functions import text as tx
from termloom.operators import terms
from termloom.plans import jobs

DOCS = [
    (0, "g1", "positive", "good food good"),
    (1, "g1", "positive", "food bar"),
    (2, "g2", "positive", "the a of"),
    (3, "g2", "negative", "bad food"),
    (4, "g1", "negative", "bad bad service"),
    (5, "g2", "neutral", "table chair"),
    (6, "g2", "other", "ignored words"),
    (7, "g1", "positive", "food"),
    (8, "g1", "positive", "food"),
    (9, "g1", "positive", "food"),
    (10, "g1", "positive", "food food"),
]
SCHEMA = "row_id long, group string, sentiment string, text string"


@pytest.fixture(params=[1, 5])
def docs(spark, request):
    """The same documents in one and in several partitions."""
    return spark.createDataFrame(DOCS, SCHEMA).repartition(request.param, "row_id")


@pytest.fixture
def predictions(docs):
    return docs.withColumnRenamed("sentiment", "predicted_sentiment")


def test_term_counts(docs):
    found = {(r[0], r[1]): r[2] for r in terms.term_counts(terms.in_sentiments(docs)).collect()}
    assert found == {
        ("positive", "good"): 2,
        ("positive", "food"): 7,
        ("positive", "bar"): 1,
        ("negative", "bad"): 3,
        ("negative", "food"): 1,
        ("negative", "service"): 1,
        ("neutral", "table"): 1,
        ("neutral", "chair"): 1,
    }


def test_top_terms_break_ties_by_term(docs):
    top = terms.top_terms(terms.term_counts(terms.in_sentiments(docs)), 2)
    found = [(r["sentiment"], r["rank"], r["term"]) for r in top.collect()]
    assert sorted(found) == [
        ("negative", 1, "bad"),
        ("negative", 2, "food"),
        ("neutral", 1, "chair"),
        ("neutral", 2, "table"),
        ("positive", 1, "food"),
        ("positive", 2, "good"),
    ]


def test_report_keeps_the_five_earliest_examples(predictions):
    report = {(r["sentiment"], r["term"]): r for r in jobs.term_report(predictions, 2).collect()}
    food = report["positive", "food"]
    assert [e["message"] for e in food["examples"]] == [
        "good food good", "food bar", "food", "food", "food"
    ]
    assert {e["sentiment_tag"] for e in food["examples"]} == {"positive"}
    assert [e["message"] for e in report["positive", "good"]["examples"]] == ["good food good"]
    assert [e["message"] for e in report["negative", "bad"]["examples"]] == [
        "bad food", "bad bad service"
    ]


def test_statistics_count_documents_without_tokens(predictions):
    statistics, overall = jobs.work_statistics(predictions)
    found = {r["sentiment"]: tuple(r)[1:] for r in statistics.collect()}
    assert found["positive"] == (7, 10, 3, pytest.approx(10 / 7), 0, 3)
    assert found["negative"] == (2, 5, 3, 2.5, 2, 3)
    assert found["neutral"] == (1, 2, 2, 2.0, 2, 2)
    top = [tuple(r) for r in overall.collect()]
    assert top[:4] == [
        ("positive", "food", 7), ("negative", "bad", 3), ("positive", "good", 2),
        ("positive", "bar", 1),
    ]


def test_statistics_of_documents_without_any_token(spark):
    only = spark.createDataFrame([(1, "g", "positive", "the")], SCHEMA)
    statistics = terms.statistics_of(terms.corpus_profile(only))
    assert rows(statistics) == [("positive", 1, 0, 0, 0.0, 0, 0)]


def test_profile_sums_agree(docs):
    profile = terms.corpus_profile(docs)
    counted = terms.term_counts(terms.in_sentiments(docs))
    assert rows(terms.counts_of(profile)) == rows(counted)
    totals = {r["sentiment"]: r["total_term_count"] for r in terms.statistics_of(profile).collect()}
    assert totals == {
        r[0]: r[1] for r in counted.groupBy("sentiment").agg(F.sum("count")).collect()
    }


def test_counts_by_group_sum_to_global_counts(docs):
    both = terms.in_sentiments(docs, ["positive", "negative"])
    grouped = terms.term_counts(both, ["group", "sentiment"], tx.plain_tokens)
    merged = grouped.groupBy("sentiment", "term").agg(F.sum("count"))
    assert rows(merged) == rows(terms.term_counts(both, ["sentiment"], tx.plain_tokens))


def test_report_by_group(predictions):
    report = jobs.term_report(predictions, 1, by_group=True)
    found = sorted((r["group"], r["sentiment"], r["term"], r["count"]) for r in report.collect())
    assert found == [
        ("g1", "negative", "bad", 2),
        ("g1", "positive", "food", 7),
        ("g2", "negative", "bad", 1),
        ("g2", "positive", "of", 1),
    ]


def test_merged_top_terms(spark):
    report = spark.createDataFrame(
        [("g1", "positive", "b", 2), ("g2", "positive", "b", 1), ("g1", "positive", "a", 3),
         ("g2", "positive", "c", 1)],
        "group string, sentiment string, term string, count long",
    )
    merged = terms.merged_top_terms(report, 2).orderBy("rank")
    assert [(r["term"], r["count"]) for r in merged.collect()] == [("a", 3), ("b", 3)]


def test_top_terms_overall_orders_equal_terms_by_sentiment(spark):
    counts = spark.createDataFrame(
        [("positive", "x", 1), ("negative", "x", 1), ("neutral", "w", 1)],
        "sentiment string, term string, count long",
    )
    found = [(r["term"], r["sentiment"]) for r in terms.top_terms_overall(counts, 3).collect()]
    assert found == [("w", "neutral"), ("x", "negative"), ("x", "positive")]


def test_most_common_terms_break_ties_by_appearance(spark):
    texts = ["zeta alpha", "alpha beta zeta", "gamma"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, text string")
    found = [(r["term"], r["count"]) for r in terms.most_common_terms(df.repartition(3)).collect()]
    counted = Counter(" ".join(texts).split())
    assert found == counted.most_common(20)


def test_frequency_check_of_a_tokeniser_with_itself(docs):
    found = terms.term_frequency_check(docs, 4).first()
    assert found["checked_rows"] == 4
    assert found["match_ratio"] == 1.0
    assert found["overlap_tokens"] == found["token_total"]


def test_frequency_check_of_two_tokenisers(spark):
    df = spark.createDataFrame([(0, "really good 'food'"), (1, "just")], "row_id long, text string")
    found = terms.term_frequency_check(df, None, tx.check_tokens, tx.report_tokens).first()
    assert found.asDict() == {
        "checked_rows": 2, "unique_terms": 4, "token_total": 4, "overlap_tokens": 1,
        "match_ratio": 0.25,
    }


def test_frequency_check_of_nothing(spark):
    empty = spark.createDataFrame([], "row_id long, text string")
    found = terms.term_frequency_check(empty, 50).first()
    assert (found["checked_rows"], found["match_ratio"]) == (0, 1.0)
    blank = spark.createDataFrame([(1, "a")], "row_id long, text string")
    found = terms.term_frequency_check(blank, None).first()
    assert (found["token_total"], found["match_ratio"]) == (1, 0.0)


def test_messages_are_read_from_the_range_of_the_chosen_ids(spark, docs, folder):
    docs.write.parquet(folder)
    saved = spark.read.parquet(folder)
    winners = terms.top_terms(terms.term_counts(saved), 2)
    found = terms.term_examples(saved, winners, 6)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_id,0)" in plan and "LessThanOrEqual(row_id," in plan


@pytest.mark.parametrize("bound", [6, None])
def test_examples_with_and_without_a_bound(docs, bound):
    winners = terms.top_terms(terms.term_counts(docs), 2)
    found = terms.term_examples(docs, winners, bound, per_term=2)
    if bound is None:
        assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    assert found.where("term = 'food' and sentiment = 'positive'").count() == 2
    assert found.where("sentiment = 'negative'").count() == 3


def test_bounded_lists_find_a_term_that_no_list_ranks_high(spark):
    """A term that is just below the cut of every group is the most frequent one of all."""
    data = []
    for g in range(6):
        data += [(f"g{g}", "positive", f"own{g}_{i}", 50 + i) for i in range(4)]
        data.append((f"g{g}", "positive", "everywhere", 49))
        data += [(f"g{g}", "positive", f"rare{g}_{i}", 1) for i in range(5)]
    data.append((None, "positive", "own0_0", 7))
    data.append(("g1", "negative", "single", 3))
    counts = spark.createDataFrame(data, "group string, sentiment string, term string, count long")
    summed = Counter()
    for _, sentiment, term, count in data:
        summed[sentiment, term] += count
    for listed in (2, 4, 5, 50):
        found = terms.bounded_top_terms(counts, 5, listed).collect()
        want = sorted(((-c, t) for (s, t), c in summed.items() if s == "positive"))[:5]
        got = sorted((r["rank"], r["term"], r["count"]) for r in found if r["sentiment"] == "positive")
        assert [(t, c) for _, t, c in got] == [(t, -c) for c, t in want]
        assert got[0][1] == "everywhere"
        assert all(r["lower"] <= r["count"] <= r["upper"] for r in found)
        assert [(r["term"], r["count"]) for r in found if r["sentiment"] == "negative"] == [("single", 3)]


def test_sketches_unite_over_groups(spark):
    data = [(i, f"g{i % 7}", "positive" if i % 3 else "negative", f"word{i % 900} other{i}") for i in range(3000)]
    df = spark.createDataFrame(data, "row_id long, group string, sentiment string, text string")
    sketches = terms.term_sketches(df, ["group", "sentiment"], tx.plain_tokens)
    exact = df.select("sentiment", F.explode(tx.plain_tokens(F.col("text"))).alias("term"))
    for keys in ([], ["sentiment"]):
        want = {tuple(r)[:-1]: r["n"] for r in exact.groupBy(*keys).agg(F.countDistinct("term").alias("n")).collect()}
        found = {tuple(r)[:-1]: r["distinct_terms"] for r in terms.distinct_terms(sketches, keys).collect()}
        assert found.keys() == want.keys()
        assert all(found[k] == pytest.approx(want[k], rel=0.03) for k in want)
