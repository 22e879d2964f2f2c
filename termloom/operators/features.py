"""TF-IDF features as long tables ``(row_id, term, weight)``.

``term_frequencies`` counts terms inside a row, ``term_statistics`` aggregates them
per term, ``document_frequency`` applies the cuts, ``tfidf`` weighs and normalises.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termloom.functions import text as tx
from termloom.operators import grams
from termloom.operators.documents import union_sources
from termloom.operators.scale import (
    BROADCAST_ROWS,
    cutoffs,
    materialise,
    rewritten,
)

#: Characters of text that one task cuts to weighed terms.
TASK_CHARACTERS = 4_000_000
#: Words of 64 bits in a membership filter, and where the three bits of a hash are taken
#: from; the low bits choose the word.
FILTER_WORDS = 1 << 18
FILTER_SHIFTS = (20, 32, 44)


@dataclasses.dataclass(frozen=True)
class Features:
    """Settings of one TF-IDF vectoriser.

    ``low``/``high`` bound the n-gram size; ``characters`` takes n-grams of the
    characters of a word instead of words. ``min_df`` is a number of documents,
    ``max_df`` a share of them, ``max_features`` keeps the most frequent terms.
    """

    low: int = 1
    high: int = 1
    characters: bool = False
    min_df: int = 1
    max_df: float = 1.0
    max_features: int | None = None
    sublinear: bool = False

    def terms(self, text: Column) -> Column:
        """All terms of a text, with repeats."""
        if self.characters:
            grams = F.transform(
                tx.blank_separated(text), lambda word: tx.char_ngrams(word, self.low, self.high)
            )
            return F.flatten(grams)
        return tx.word_ngrams(tx.model_words(text), self.low, self.high)

    def words(self, text: Column) -> Column:
        """The words that terms are made of, with repeats."""
        return tx.blank_separated(text) if self.characters else tx.model_words(text)

    def distinct_terms(self, text: Column) -> Column:
        """Each term of a text once."""
        if self.characters:
            words = F.array_distinct(tx.blank_separated(text))
            grams = F.transform(words, lambda word: tx.char_ngrams(word, self.low, self.high))
            return F.array_distinct(F.flatten(grams))
        return F.array_distinct(self.terms(text))


def term_frequencies(
    df: DataFrame, terms: Callable[[Column], Column], text: str = "text"
) -> DataFrame:
    """Distinct terms of every document: ``row_id, term, tf``; needs no shuffle."""
    return df.select("row_id", F.inline(tx.sorted_runs(terms(F.col(text)))))


def _placed_frequencies(df: DataFrame, settings: Features, text: str) -> DataFrame:
    """Term frequencies of documents that are partitioned by row id already.

    Character n-grams are cut from the distinct words of a document and summed per
    (row id, term), which needs no shuffle there and is faster than sorting them all.
    """
    if not settings.characters:
        return term_frequencies(df, settings.terms, text)
    runs = tx.sorted_runs(tx.blank_separated(F.col(text)))
    words = df.select("row_id", F.inline(runs)).select(
        "row_id", "tf", F.concat(F.lit(" "), F.col("term"), F.lit(" ")).alias("word")
    )
    sizes = F.explode(F.sequence(F.lit(settings.low), F.lit(settings.high)))
    length, size = F.length("word"), F.col("size")
    sized = words.select("*", sizes.alias("size")).where(
        (length >= size) | (size == settings.low)
    )
    starts = F.explode(F.sequence(F.lit(1), F.greatest(length - size + 1, F.lit(1))))
    grams = sized.select("*", starts.alias("start")).select(
        "row_id", "tf", F.substring(F.col("word"), F.col("start"), size).alias("term")
    )
    return grams.groupBy("row_id", "term").agg(F.sum("tf").alias("tf"))


def _placed_with_rare(df: DataFrame, settings: Features) -> DataFrame:
    """Term frequencies ``row_id, term, tf, idf`` of texts and ``rare_terms`` in one table.

    Both are partitioned by row id; rows of a rare term have no text. ``idf`` is null in the
    rows of the texts, and those of rare terms come twice then unless they are merged.
    """
    given = F.array(F.struct("term", "tf", "idf"))
    if not settings.characters:
        runs = tx.sorted_runs(settings.terms(F.col("text")))
        none = F.lit(None).cast("double").alias("idf")
        own = F.transform(runs, lambda r: F.struct(r["term"].alias("term"), r["tf"].alias("tf"), none))
        return df.select("row_id", F.inline(F.when(F.col("term").isNotNull(), given).otherwise(own)))
    # A rare term passes the cutting as a word of its own.
    term = F.col("term")
    runs = tx.sorted_runs(tx.blank_separated(F.col("text")))
    padded = F.transform(
        runs,
        lambda r: F.struct(
            F.concat(F.lit(" "), r["term"], F.lit(" ")).alias("term"), r["tf"].alias("tf"),
            F.lit(None).cast("double").alias("idf"),
        ),
    )
    words = df.select("row_id", F.inline(F.when(term.isNotNull(), given).otherwise(padded)))
    length, size, whole = F.length("term"), F.col("size"), F.col("idf").isNotNull()
    every = F.sequence(F.lit(settings.low), F.lit(settings.high))
    sizes = F.explode(F.when(whole, F.array(length)).otherwise(every))
    sized = words.select("*", sizes.alias("size")).where(
        (length >= size) | (size == settings.low)
    )
    starts = F.explode(F.sequence(F.lit(1), F.greatest(length - size + 1, F.lit(1))))
    grams = sized.select("*", starts.alias("start")).select(
        "row_id", "tf", "idf", F.substring(F.col("term"), F.col("start"), size).alias("term")
    )
    return grams.groupBy("row_id", "term").agg(F.sum("tf").alias("tf"), F.max("idf").alias("idf"))


def _word_and_bits(hashed: Column) -> tuple[Column, Column]:
    """Word of the membership filter that a hash falls into, and its three bits there."""
    word = hashed.bitwiseAND(F.lit(FILTER_WORDS - 1).cast("long"))
    one, places = F.lit(1).cast("long"), F.lit(63).cast("long")
    bits = [
        F.call_function(
            "shiftleft", one, F.shiftrightunsigned(hashed, k).bitwiseAND(places).cast("int")
        )
        for k in FILTER_SHIFTS
    ]
    return word, bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def membership_filter(terms: DataFrame) -> DataFrame:
    """Bloom filter of a table of terms: ``word, bits``, built by one aggregate.

    It has at most ``FILTER_WORDS`` rows, however many terms there are. A crowded filter
    lets further terms pass, it never holds back one of the table.
    """
    word, bits = _word_and_bits(F.xxhash64("term"))
    placed = terms.select(word.alias("word"), bits.alias("bits"))
    return placed.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def possible_terms(found: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of ``found`` (with a column ``term``) whose term may be in the filter.

    The filter is broadcast (its size is bounded): rows stay where they are, and the others are
    dropped before any shuffle.
    """
    word, bits = _word_and_bits(F.xxhash64("term"))
    held = members.select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    marked = found.select("*", word.alias("_word"), bits.alias("_own"))
    near = marked.join(F.broadcast(held), "_word")
    return near.where(F.col("_bits").bitwiseAND(F.col("_own")) == F.col("_own")).drop(
        "_word", "_bits", "_own"
    )


def document_counts(df: DataFrame, settings: Features, text: str = "text") -> DataFrame:
    """Documents with each term: ``term, df``; cheaper than all term statistics."""
    found = df.select(F.explode(settings.distinct_terms(F.col(text))).alias("term"))
    return found.groupBy("term").agg(F.count("*").alias("df"))


def corpus_statistics(df: DataFrame, settings: Features, text: str = "text") -> DataFrame:
    """What the cuts of ``settings`` need: ``cf`` only if ``max_features`` is set."""
    if settings.max_features is None:
        return document_counts(df, settings, text)
    return term_statistics(term_frequencies(df, settings.terms, text))


def term_statistics(frequencies: DataFrame) -> DataFrame:
    """Documents with the term and occurrences in all: ``term, df, cf``."""
    return frequencies.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("tf").alias("cf")
    )


def document_frequency(
    statistics: DataFrame, n_docs: int, settings: Features, stored: bool = False
) -> DataFrame:
    """Term statistics within the cuts ``min_df``, ``max_df`` and ``max_features``.

    Terms with equal occurrences at the ``max_features`` border are taken in the
    order of their MD5, which cuts evenly however many there are. ``stored``: the statistics are
    a table already and need no copy.
    """
    kept = statistics.where(
        (F.col("df") >= settings.min_df)
        & (F.col("df").cast("double") <= F.lit(settings.max_df * n_docs))
    )
    if settings.max_features is None:
        return kept
    return most_frequent(kept if stored else materialise(kept), settings.max_features)


def most_frequent(statistics: DataFrame, n: int) -> DataFrame:
    """Exactly the ``n`` terms with the highest ``cf`` (all if there are fewer).

    ``statistics`` is read several times and should be materialised.
    """
    if statistics.count() <= n:
        return statistics
    ranked = statistics.select("*", (-F.col("cf")).alias("_rank"))
    # One bucket per frequency: few, because high frequencies are rare.
    border = ranked.groupBy("_rank").agg(F.count("*").alias("_rows"))
    upto = W.orderBy("_rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    border = border.withColumn("_upto", F.sum("_rows").over(upto))
    found = border.where(F.col("_upto") >= n).orderBy("_rank").limit(1).first()
    missing = n - (found["_upto"] - found["_rows"])
    at_border = ranked.where(F.col("_rank") == found["_rank"])
    hashed = at_border.withColumn("_hash", F.md5("term"))
    bucket = F.substring("_hash", 1, 4)
    last = cutoffs(hashed, [], "_hash", bucket, lambda _: F.lit(missing)).first()["cutoff"]
    above = F.col("_rank") < found["_rank"]
    chosen = (F.col("_rank") == found["_rank"]) & (F.md5("term") <= last)
    return ranked.where(above | chosen).drop("_rank")


def with_idf(statistics: DataFrame, n_docs: int) -> DataFrame:
    """Add the smoothed inverse document frequency ``ln((1+N)/(1+df)) + 1``."""
    above = F.lit(float(1 + n_docs))
    return statistics.withColumn("idf", F.log(above / (F.col("df") + 1).cast("double")) + 1.0)


def term_weight(tf: Column, sublinear: bool) -> Column:
    """Term frequency as double, or ``1 + ln(tf)``."""
    tf = tf.cast("double")
    return F.log(tf) + 1.0 if sublinear else tf


def split_vocabulary(
    vocabulary: DataFrame, limit: int, rank: str = "idf"
) -> tuple[DataFrame, DataFrame]:
    """The terms of most documents, at most ``limit`` of them, and all others.

    ``rank`` falls with the number of documents or occurrences of a term. Terms of equal rank
    stay together. More than ``limit`` terms are as frequent as any of the others or more
    so, so each of those holds less than 1 / ``limit`` of all term rows: a shuffle on them
    has no hot key.
    """
    counted = vocabulary.groupBy(rank).agg(F.count("*").alias("_rows"))
    upto = W.orderBy(rank).rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = counted.select(rank, F.sum("_rows").over(upto).alias("_upto"))
    border = counted.where(F.col("_upto") <= limit).agg(F.max(rank)).first()[0]
    often = F.lit(False) if border is None else F.col(rank) <= border
    return vocabulary.where(often), vocabulary.where(~often)


def vocabulary_join(
    frequencies: DataFrame,
    vocabulary: DataFrame,
    vocabulary_rows: int | None,
    limit: int | None = None,
) -> DataFrame:
    """Term frequencies with the ``idf`` of their terms; other terms are dropped.

    Up to ``limit`` terms (``BROADCAST_ROWS``) are broadcast. Of a larger vocabulary the terms of most documents
    are; what is left of the frequencies passes a membership filter of the rare terms before
    it is shuffled to them. ``vocabulary`` is then read several times and should be a table.
    """
    limit = BROADCAST_ROWS if limit is None else limit
    terms = vocabulary.select("term", "idf")
    if vocabulary_rows is not None and vocabulary_rows <= limit:
        return frequencies.join(F.broadcast(terms), "term")
    often, rare = split_vocabulary(terms, limit)
    members = rewritten(membership_filter(rare), "filter")
    near = frequencies.join(F.broadcast(often), "term")
    return near.unionByName(possible_terms(frequencies, members).join(rare, "term"))


def weigh(
    frequencies: DataFrame,
    vocabulary: DataFrame,
    vocabulary_rows: int | None,
    sublinear: bool = False,
) -> DataFrame:
    """Weights of documents under a vocabulary with ``idf``, length 1 per document."""
    return _unit_length(vocabulary_join(frequencies, vocabulary, vocabulary_rows), sublinear)


def _unit_length(joined: DataFrame, sublinear: bool) -> DataFrame:
    """``row_id, term, weight`` from rows with ``tf`` and ``idf``."""
    raw = joined.select(
        "row_id", "term", (term_weight(F.col("tf"), sublinear) * F.col("idf")).alias("_raw")
    )
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(W.partitionBy("row_id")))
    return raw.select("row_id", "term", (F.col("_raw") / length).alias("weight"))


def rare_terms(df: DataFrame, settings: Features, text: str, rare: DataFrame) -> DataFrame:
    """The rare terms of every document: ``row_id, term, tf, idf``.

    Terms pass the membership filter of ``rare`` (``term, idf``) before they are shuffled to
    it. Character n-grams come without their number (``tf`` 0), which the text gives.
    """
    members = rewritten(membership_filter(rare), "filter")
    if settings.characters:
        once = F.explode(settings.distinct_terms(F.col(text))).alias("term")
        found = df.select("row_id", once, F.lit(0).cast("long").alias("tf"))
    else:
        found = term_frequencies(df, settings.terms, text)
    return possible_terms(found, members).join(rare, "term").select("row_id", "term", "tf", "idf")


def _by_row_id(df: DataFrame, characters: int) -> DataFrame:
    """Rows moved by row id to tasks of about ``TASK_CHARACTERS`` of text.

    A given number of tasks: small partitions are merged by their bytes otherwise, and a text
    grows to many times its size when it is cut to terms.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(tasks, -(-characters // TASK_CHARACTERS)), "row_id")


def tfidf(df: DataFrame, settings: Features, text: str = "text") -> DataFrame:
    """TF-IDF weights of a corpus under its own vocabulary: ``row_id, term, weight``.

    Texts, smaller than their term rows, are moved by row id once, and the length of a
    document needs no shuffle of its terms. ``grams.weights`` counts and looks up the terms by
    64-bit marks. With ``max_features`` the vocabulary, whose border is found by the MD5 of terms,
    is written once and counted; it is broadcast if it is small, else its
    most frequent terms are, and the rare terms of a document travel to its text
    (``rare_terms``).
    """
    n_docs, characters = df.agg(F.count("*"), F.sum(F.length(text))).first()
    if settings.max_features is None:
        # No alias where none is needed: both passes over the texts share their shuffle then.
        given = df.select("row_id", "text" if text == "text" else F.col(text).alias("text"))
        return grams.weights(
            given, settings.words(F.col("text")), settings.low, settings.high, settings.characters,
            (settings.min_df, settings.max_df * n_docs), settings.sublinear, (n_docs, characters or 0), TASK_CHARACTERS,
        )
    counted = document_frequency(corpus_statistics(df, settings, text), n_docs, settings)
    vocabulary = rewritten(with_idf(counted, n_docs).select("term", "idf"), "vocabulary")
    rows = vocabulary.count()
    placed = df.select("row_id", F.col(text).alias("text"))
    often = vocabulary
    if rows > BROADCAST_ROWS:
        often, rare = split_vocabulary(vocabulary, BROADCAST_ROWS)
        near = rare_terms(placed, settings, "text", rare)
        placed = placed.unionByName(near, allowMissingColumns=True)
    placed = _by_row_id(placed, characters or 0)
    if rows <= BROADCAST_ROWS:
        return weigh(_placed_frequencies(placed, settings, "text"), often, rows, settings.sublinear)
    found = _placed_with_rare(placed, settings)
    known = found.join(F.broadcast(often.withColumnRenamed("idf", "_idf")), "term", "left")
    idf = F.coalesce("idf", "_idf")
    joined = known.select("row_id", "term", "tf", idf.alias("idf")).where("idf IS NOT NULL")
    return _unit_length(joined, settings.sublinear)


def feature_union(parts: dict[str, DataFrame]) -> DataFrame:
    """Union of weight tables with the name of the part in front of the term."""
    return union_sources(
        [
            part.select(
                "row_id", F.concat(F.lit(f"{name}__"), F.col("term")).alias("term"), "weight"
            )
            for name, part in parts.items()
        ]
    )
