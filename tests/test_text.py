import random
import re

import pytest
from pyspark.sql import functions as F

from termloom.functions import stopwords
from termloom.functions import text as tx

STOP = ["the", "and", "movie", "ni", "of"]


def by_hand(text, stop):
    """Report tokeniser in plain Python."""
    if text is None:
        return []
    text = re.sub(r"\\[nrtfvba0]+", " ", text)
    text = re.sub(r"\\u[0-9a-fA-F]{4}", " ", text).replace("\\", " ")
    words = (word.strip("'") for word in re.findall(r"[A-Za-z']+", text.lower()))
    return [word for word in words if len(word) > 1 and word not in stop]


def column(spark, texts, build):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(3)
    found = df.select("i", build(F.col("text")).alias("r")).orderBy("i").collect()
    return [row["r"] for row in found]


@pytest.mark.parametrize(
    "text, expected",
    [
        (r"\nI loved\n\nit's the movie", ["loved", "it's"]),
        (r"\nthe rat \nrat café café", ["he", "rat", "caf", "caf"]),
        (None, []),
        ("", []),
        ("'' 'a' ''don't'' rock'n'roll", ["don't", "rock'n'roll"]),
        ("Kelvin İstanbul STRASSEß", ["kelvin", "stanbul", "strasse"]),
        (r"a\\nb \x41 \u12 ñando", ["ando"]),
        ("line\nreal\ttab \\", ["line", "real", "tab"]),
    ],
)
def test_report_tokens_on_known_texts(spark, text, expected):
    assert column(spark, [text], lambda c: tx.tokens(c, stop_words=STOP)) == [expected]


def test_report_tokens_equal_plain_python(spark):
    pick = random.Random(7)
    pieces = ["\\n", "\\u00e9", "\\", "'", "the ", "Food", "it's", " ", "\n", "é", "ni", "a1b", "B"]
    texts = ["".join(pick.choices(pieces, k=pick.randint(0, 30))) for _ in range(500)]
    found = column(spark, texts, lambda c: tx.tokens(c, stop_words=STOP))
    assert found == [by_hand(text, STOP) for text in texts]


def test_strict_escapes_remove_one_letter(spark):
    text = [r"\nthe \nrat \ttab"]
    assert column(spark, text, lambda c: tx.tokens(c, strict_escapes=True)) == [
        ["the", "rat", "tab"]
    ]
    assert column(spark, text, lambda c: tx.tokens(c)) == [["he"]]


def test_check_and_plain_tokens_skip_cleaning(spark):
    text = ["The movie's 'just\\nfine' really"]
    assert column(spark, text, tx.check_tokens) == [["movie's", "'just", "nfine'", "really"]]
    assert column(spark, text, tx.plain_tokens) == [
        ["the", "movie's", "'just", "nfine'", "really"]
    ]


def test_stop_words(spark):
    base = set(stopwords.base_words())
    assert len(base) == 318
    assert {"the", "yourselves", "amoungst", "thru"} <= base
    assert not {"just", "did", "really", "it's", "don"} & base
    assert set(stopwords.report_words()) == base | set(
        "anything something everything really just also movies movie restaurants "
        "restaurant tweets tweet ni".split()
    )


def test_model_words(spark):
    texts = ["The café_1 is a 42 b Été", None]
    assert column(spark, texts, tx.model_words) == [["café_1", "42", "été"], []]


def ngrams_by_hand(words, low, high):
    return [
        " ".join(words[i : i + n])
        for n in range(low, high + 1)
        for i in range(len(words) - n + 1)
    ]


@pytest.mark.parametrize("low, high", [(1, 1), (1, 2), (1, 3), (2, 3)])
def test_word_ngrams(spark, low, high):
    texts = ["aa bb cc dd", "aa", "", "aa bb aa"]
    found = column(spark, texts, lambda c: tx.word_ngrams(tx.model_words(c, []), low, high))
    assert found == [ngrams_by_hand(text.split(), low, high) for text in texts]


def char_ngrams_by_hand(word, low, high):
    padded, found = f" {word} ", []
    if len(padded) < low:
        return [padded]
    for n in range(low, high + 1):
        found += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return found


@pytest.mark.parametrize("low, high", [(3, 5), (4, 6), (1, 2)])
def test_char_ngrams(spark, low, high):
    words = ["a", "ab", "abc", "abcdefg", "über"]
    found = column(spark, words, lambda c: tx.char_ngrams(c, low, high))
    assert found == [char_ngrams_by_hand(word, low, high) for word in words]


def test_sorted_runs(spark):
    texts = ["b a b c a b", "", "z"]
    found = column(spark, texts, lambda c: tx.sorted_runs(tx.blank_separated(c)))
    assert [[tuple(run) for run in runs] for runs in found] == [
        [("a", 2), ("b", 3), ("c", 1)],
        [],
        [("z", 1)],
    ]
