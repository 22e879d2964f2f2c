"""Term counts, rankings, examples and corpus statistics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termloom.functions import text as tx
from termloom.functions.labels import REPORT_ORDER
from termloom.operators.documents import first_rows
from termloom.operators.scale import id_range, lookup_join, materialise

Tokeniser = Callable[[Column], Column]


def in_sentiments(df: DataFrame, sentiments: Sequence[str] = REPORT_ORDER) -> DataFrame:
    """Rows whose sentiment is one of the given ones."""
    return df.where(F.col("sentiment").isin(list(sentiments)))


def term_rows(df: DataFrame, keep: Sequence[str], tokenise: Tokeniser | None = None) -> DataFrame:
    """One row per token: ``keep`` and ``term``. Documents without tokens vanish."""
    tokenise = tokenise or tx.report_tokens
    return df.select(*keep, F.explode(tokenise(F.col("text"))).alias("term"))


def term_counts(
    df: DataFrame, keys: Sequence[str] = ("sentiment",), tokenise: Tokeniser | None = None
) -> DataFrame:
    """Occurrences by ``keys`` and term, aggregated before the shuffle."""
    rows = term_rows(df, keys, tokenise)
    return rows.groupBy(*keys, "term").agg(F.count("*").alias("count"))


def corpus_profile(df: DataFrame, tokenise: Tokeniser | None = None) -> DataFrame:
    """Term counts and document statistics of every sentiment in one aggregate.

    Each document adds its tokens and one row with a null term. ``count`` of a null
    term is the number of documents; ``min_tokens`` and ``max_tokens`` of that row
    are the extremes over all documents, those without tokens included. Reports and
    statistics are both made from this frame, so texts are tokenised once.
    """
    tokenise = tokenise or tx.report_tokens
    found = in_sentiments(df).select("sentiment", tokenise(F.col("text")).alias("tokens"))
    marker = F.array(F.lit(None).cast("string"))
    rows = found.select(
        "sentiment",
        F.size("tokens").cast("long").alias("size"),
        F.explode(F.concat("tokens", marker)).alias("term"),
    )
    return rows.groupBy("sentiment", "term").agg(
        F.count("*").alias("count"),
        F.min("size").alias("min_tokens"),
        F.max("size").alias("max_tokens"),
    )


def counts_of(profile: DataFrame) -> DataFrame:
    """Term counts by sentiment out of a corpus profile."""
    return profile.where(F.col("term").isNotNull()).select("sentiment", "term", "count")


def statistics_of(profile: DataFrame) -> DataFrame:
    """One row per sentiment: documents, terms, distinct terms, tokens per document."""
    is_documents = F.col("term").isNull()

    def of_documents(column: str) -> Column:
        return F.coalesce(F.max(F.when(is_documents, F.col(column))), F.lit(0).cast("long"))

    summed = profile.groupBy("sentiment").agg(
        of_documents("count").alias("document_count"),
        F.coalesce(F.sum(F.when(~is_documents, F.col("count"))), F.lit(0).cast("long")).alias(
            "total_term_count"
        ),
        F.count("term").alias("distinct_term_count"),
        of_documents("min_tokens").alias("min_tokens_per_doc"),
        of_documents("max_tokens").alias("max_tokens_per_doc"),
    )
    average = F.col("total_term_count").cast("double") / F.col("document_count")
    return summed.select(
        "sentiment",
        "document_count",
        "total_term_count",
        "distinct_term_count",
        F.coalesce(average, F.lit(0.0)).alias("average_tokens_per_doc"),
        "min_tokens_per_doc",
        "max_tokens_per_doc",
    )


def top_terms(counts: DataFrame, n: int = 20, keys: Sequence[str] = ("sentiment",)) -> DataFrame:
    """The ``n`` most frequent terms per ``keys``, ties by term, with their rank.

    The filter on the row number lets every task keep ``n`` rows per key before the
    shuffle.
    """
    order = W.partitionBy(*keys).orderBy(F.desc("count"), F.asc("term"))
    ranked = counts.withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= n).withColumn("rank", F.col("rank").cast("long"))


def top_terms_overall(counts: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` most frequent (sentiment, term) pairs, ties by term and sentiment."""
    return counts.orderBy(F.desc("count"), F.asc("term"), F.asc("sentiment")).limit(n)


def term_examples(
    df: DataFrame,
    winners: DataFrame,
    winner_rows: int | None,
    per_term: int = 5,
    keys: Sequence[str] = ("sentiment",),
    tokenise: Tokeniser | None = None,
) -> DataFrame:
    """Up to ``per_term`` earliest messages of every winning (keys, term).

    ``winner_rows`` bounds the rows of ``winners`` (None if unknown); they are read
    twice and should be materialised. Only winning
    terms enter the window, it carries row ids instead of texts, and each task keeps
    ``per_term`` ids per term before the shuffle. Texts are fetched for those ids, out
    of the range they lie in.
    """
    keys, tokenise = list(keys), tokenise or tx.report_tokens
    if winner_rows is not None and winner_rows <= _FEW_WINNERS:
        wanted = winners.agg(F.collect_set("term")).scalar()
        hits = term_rows(
            df, ["row_id", *keys], lambda text: F.array_intersect(tokenise(text), wanted)
        )
    else:
        hits = term_rows(df, ["row_id", *keys], lambda text: F.array_distinct(tokenise(text)))
    hits = lookup_join(
        hits, winners.select(*keys, "term"), [*keys, "term"], winner_rows, "row_id"
    )
    earliest = W.partitionBy(*keys, "term").orderBy("row_id")
    chosen = (
        hits.withColumn("example_rank", F.row_number().over(earliest))
        .where(F.col("example_rank") <= per_term)
        .withColumnRenamed("row_id", "_example")
    )
    bound = None if winner_rows is None else winner_rows * per_term
    if bound is not None and bound <= _MESSAGE_ROWS:
        # The earliest ids are low ones: as a plain range they prune the second scan.
        chosen = materialise(chosen)
        low, high = id_range(chosen, "_example")
        df = df.where(F.col("row_id").between(low, high))
        chosen = F.broadcast(chosen)
    messages = df.select("row_id", "text", F.col("sentiment").alias("sentiment_tag"))
    return messages.join(chosen, F.col("row_id") == F.col("_example")).select(
        *keys, "term", "example_rank", "row_id", F.col("text").alias("message"), "sentiment_tag"
    )


# Up to this number of winners, other tokens are dropped inside the row.
_FEW_WINNERS = 1_000
# Chosen (term, row id) pairs up to this number are sent to the scan of the texts.
_MESSAGE_ROWS = 100_000


def collect_examples(examples: DataFrame, keys: Sequence[str] = ("sentiment",)) -> DataFrame:
    """Examples of a term as one array in row-id order; a term has only a few."""
    entry = F.struct("example_rank", "message", "sentiment_tag")
    grouped = examples.groupBy(*keys, "term").agg(
        F.sort_array(F.collect_list(entry)).alias("examples")
    )
    return grouped.withColumn(
        "examples",
        F.transform(
            "examples",
            lambda e: F.struct(
                e["message"].alias("message"), e["sentiment_tag"].alias("sentiment_tag")
            ),
        ),
    )


def merged_top_terms(report: DataFrame, n: int = 10) -> DataFrame:
    """Top lists of any layout merged to one list per sentiment.

    Takes rows (sentiment, term, count) with or without a group column; counts of a
    term are summed over groups, ties are ordered by term.
    """
    merged = report.groupBy("sentiment", "term").agg(F.sum("count").alias("count"))
    return top_terms(merged, n)


def bounded_top_terms(
    counts: DataFrame, n: int = 10, listed: int = 20, group: str = "group"
) -> DataFrame:
    """The exact ``n`` most frequent terms per sentiment over all groups, from short lists.

    Every group keeps only its ``listed`` most frequent terms. The last count on a full list
    bounds every term that is not on it, so a term has a lower bound (what lists
    say) and an upper one (with the last counts of lists that lack it). Terms whose upper
    bound reaches the n-th lower bound are counted exactly in a second pass; terms on no list
    are bounded by the sum of the last counts, and take part unless that is too small.
    Returns ``sentiment, term, lower, upper, count, rank``; ties are ordered by term.
    """
    keys = ["sentiment", group]
    lists = materialise(top_terms(counts, listed, keys))
    last = F.when(F.count("*") >= listed, F.min("count")).otherwise(0)
    ends = lists.groupBy(*keys).agg(last.alias("last"))
    totals = ends.groupBy("sentiment").agg(F.sum("last").alias("unseen"))
    named = ends.select(F.col("sentiment").alias("_sentiment"), F.col(group).alias("_group"), "last")
    same = F.col("sentiment").eqNullSafe(F.col("_sentiment")) & F.col(group).eqNullSafe(F.col("_group"))
    seen = lists.join(named, same).select("sentiment", "term", "count", "last")
    bounds = seen.groupBy("sentiment", "term").agg(
        F.sum("count").alias("lower"), F.sum("last").alias("own")
    )
    bounds = bounds.join(totals, "sentiment").select(
        "sentiment", "term", "lower", (F.col("lower") + F.col("unseen") - F.col("own")).alias("upper"), "unseen"
    )
    # Lists of one sentiment together are short: ``listed`` terms for each group.
    place = F.row_number().over(W.partitionBy("sentiment").orderBy(F.desc("lower"), "term"))
    bounds = materialise(bounds.withColumn("_place", place))
    border = bounds.where(F.col("_place") <= n).groupBy("sentiment").agg(
        F.min("lower").alias("border"), F.count("*").alias("_held"), F.max("unseen").alias("unseen")
    )
    border = border.withColumn("border", F.when(F.col("_held") >= n, F.col("border")).otherwise(0))
    bounds = bounds.drop("unseen", "_place")
    summed = counts.groupBy("sentiment", "term").agg(F.sum("count").alias("count"))
    asked = bounds.join(border, "sentiment").where("upper >= border").select(*bounds.columns)
    exact = asked.join(summed, ["sentiment", "term"])
    # Where even a term on no list could reach the border, all terms are counted.
    open_ = border.where("unseen >= border").select("sentiment", "unseen")
    rest = summed.join(open_, "sentiment").join(bounds.select("sentiment", "term"), ["sentiment", "term"], "left_anti")
    rest = rest.select("sentiment", "term", F.lit(0).cast("long").alias("lower"), F.col("unseen").alias("upper"), "count")
    return top_terms(exact.unionByName(rest), n, ["sentiment"])


def term_sketches(df: DataFrame, keys: Sequence[str] = ("sentiment",), tokenise: Tokeniser | None = None) -> DataFrame:
    """One mergeable sketch of the distinct terms per group: ``keys, sketch``.

    A few kilobytes a group, whatever the number of terms; write it as a table and unite
    any groups later with ``distinct_terms``.
    """
    tokenise = tokenise or tx.report_tokens
    tokens = df.select(*keys, F.explode(tokenise(F.col("text"))).alias("term"))
    return tokens.groupBy(*keys).agg(F.hll_sketch_agg("term", F.lit(SKETCH)).alias("sketch"))


def distinct_terms(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Estimated distinct terms by ``keys`` from the sketches of any finer groups.

    The standard error is 1.04 / sqrt(2**SKETCH), below one per cent.
    """
    united = sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    return united.select(*keys, F.hll_sketch_estimate("sketch").alias("distinct_terms"))


#: Binary logarithm of the number of registers of a sketch.
SKETCH = 14


def most_common_terms(df: DataFrame, n: int = 20, tokenise: Tokeniser | None = None) -> DataFrame:
    """The ``n`` most frequent terms, ties by first appearance (row id, position)."""
    tokenise = tokenise or tx.check_tokens
    rows = df.select("row_id", F.posexplode(tokenise(F.col("text"))).alias("pos", "term"))
    # Id and position as one number: a struct would turn the hash aggregate to a sort.
    place = F.col("row_id").cast("decimal(20,0)") * F.lit(_POSITIONS) + F.col("pos")
    counted = rows.groupBy("term").agg(
        F.count("*").alias("count"),
        F.min("row_id").alias("first_row_id"),
        F.min(place.cast("decimal(38,0)")).alias("_first"),
    )
    ranked = counted.orderBy(F.desc("count"), F.asc("_first")).limit(n)
    return ranked.drop("_first")


# More than any number of tokens in one text.
_POSITIONS = 1 << 31


def term_frequency_check(
    df: DataFrame,
    rows: int | None = 50,
    tokenise: Tokeniser | None = None,
    compared: Tokeniser | None = None,
) -> DataFrame:
    """How far two tokenisers agree on the term counts of the first rows.

    ``rows=None`` checks all documents. Both token lists are counted in the same
    aggregate; the overlap is the sum of the smaller counts.
    """
    tokenise, compared = tokenise or tx.check_tokens, compared or tx.check_tokens
    sample = df if rows is None else first_rows(df, rows)

    def flagged(token_list: Column, first: int, second: int) -> Column:
        return F.transform(
            token_list,
            lambda term: F.struct(
                term.alias("term"),
                F.lit(first).cast("long").alias("a"),
                F.lit(second).cast("long").alias("b"),
            ),
        )

    marker = F.array(
        F.struct(
            F.lit(None).cast("string").alias("term"),
            F.lit(1).cast("long").alias("a"),
            F.lit(0).cast("long").alias("b"),
        )
    )
    text = F.col("text")
    pairs = F.concat(flagged(tokenise(text), 1, 0), flagged(compared(text), 0, 1), marker)
    counted = (
        sample.select(F.inline(pairs))
        .groupBy("term")
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    is_term = F.col("term").isNotNull()
    totals = counted.agg(
        F.coalesce(F.max(F.when(~is_term, F.col("a"))), F.lit(0).cast("long")).alias(
            "checked_rows"
        ),
        F.count_if(is_term & (F.col("a") > 0)).alias("unique_terms"),
        F.greatest(
            F.coalesce(F.sum(F.when(is_term, F.col("a"))), F.lit(0)), F.lit(1).cast("long")
        ).alias("token_total"),
        F.coalesce(
            F.sum(F.when(is_term, F.least("a", "b"))), F.lit(0).cast("long")
        ).alias("overlap_tokens"),
    )
    ratio = F.col("overlap_tokens").cast("double") / F.col("token_total")
    nothing = F.col("checked_rows") == 0
    return totals.withColumn("match_ratio", F.when(nothing, F.lit(1.0)).otherwise(ratio))
