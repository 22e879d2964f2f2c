"""Projections, filters and counts on document and corpus frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.scale import cutoffs, lookup_join, with_pieces


def normalise(
    source: DataFrame,
    text_col: str = "text",
    group_col: str = "group",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Columns ``keep``, ``text`` and ``group`` as strings without nulls.

    A null text is empty, a null group is "unknown", and so is every group when the
    source has no group column.
    """
    if group_col in source.columns:
        group = F.coalesce(F.col(group_col).cast("string"), F.lit("unknown"))
    else:
        group = F.lit("unknown")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return source.select(*keep, text.alias("text"), group.alias("group"))


def not_blank(text: Column) -> Column:
    """True for text with a character that is not white space."""
    return text.rlike(r"(?U)[^\s\x1c-\x1f]")


def drop_unusable(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """Rows with a text, a label and something in the text."""
    return df.dropna(subset=[text, label]).where(not_blank(F.col(text)))


def cleaning_counts(df: DataFrame, text: str = "text", label: str = "label") -> DataFrame:
    """One row: rows before cleaning, after it and removed by it."""
    usable = F.col(text).isNotNull() & F.col(label).isNotNull() & not_blank(F.col(text))
    counted = df.agg(
        F.count("*").alias("rows_before"), F.count_if(usable).alias("rows_after")
    )
    removed = F.col("rows_before") - F.col("rows_after")
    return counted.withColumn("rows_removed", removed)


def model_input(df: DataFrame, category: str = "category", text: str = "text") -> DataFrame:
    """Add ``model_input`` = category, blank, text (null if either is null) and ``group``."""
    return df.withColumns(
        {
            "model_input": F.concat(F.col(category), F.lit(" "), F.col(text)),
            "group": F.col(category),
        }
    )


def union_sources(sources: Sequence[DataFrame]) -> DataFrame:
    """Union all of frames with the same columns, matched by name."""
    return reduce(DataFrame.unionByName, sources)


def corpus_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row counts by each column on its own: ``dimension, value, count``.

    One scan: every row is expanded to its (column, value) pairs and aggregated
    before the shuffle.
    """
    pairs = [
        F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value"))
        for c in columns
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .groupBy("dimension", "value")
        .agg(F.count("*").alias("count"))
    )


def preview(
    df: DataFrame, rows: int = 10, characters: int = 120, row_id: str = "row_id", text: str = "text"
) -> DataFrame:
    """The first rows with the start of their text, for display."""
    return first_rows(df, rows, row_id).withColumn(
        text, F.substring(F.col(text), 1, characters)
    )


def first_rows(df: DataFrame, n: int, row_id: str = "row_id") -> DataFrame:
    """The ``n`` rows with the smallest ids (ids must be unique).

    The n-th smallest id is found on the id column alone and becomes a plain filter
    that reaches the scan; no task holds ``n`` documents.
    """
    if n <= 0:
        return df.limit(0)
    placed = with_pieces(df.select(row_id), row_id)
    found = cutoffs(placed, [], row_id, F.col("_piece"), lambda _: F.lit(n)).first()
    return df.limit(0) if found is None else df.where(F.col(row_id) <= found["cutoff"])


def shuffle_key(row_id: str, seed: int) -> Column:
    """Seeded pseudo-random order of rows: MD5 of id and seed."""
    return F.md5(F.concat_ws("|", F.col(row_id).cast("string"), F.lit(str(seed))))


def _hash_cutoffs(df: DataFrame, keys: Sequence[str], wanted) -> DataFrame:
    # The first four hex digits cut the hash range into 65,536 even buckets.
    return cutoffs(df, keys, "_shuffle", F.substring("_shuffle", 1, 4), wanted)


def exact_sample(
    df: DataFrame,
    n: int,
    seed: int = 42,
    by: Sequence[str] = (),
    row_id: str = "row_id",
) -> DataFrame:
    """Exactly ``n`` seeded random rows (per ``by`` group); all rows of a smaller one.

    Groups with a null key are kept apart like any other group.
    """
    by = list(by)
    keyed = df.withColumn("_shuffle", shuffle_key(row_id, seed))
    if not by:
        found = _hash_cutoffs(keyed, by, lambda _: F.lit(n)).first()
        if found is None:
            return df.limit(0)
        return keyed.where(F.col("_shuffle") <= found["cutoff"]).drop("_shuffle")
    slots = [f"_by{i}" for i in range(len(by))]
    keyed = keyed.withColumns(dict(zip(slots, map(_null_safe, by), strict=True)))
    cuts = _hash_cutoffs(keyed, slots, lambda _: F.lit(n))
    joined = lookup_join(keyed, cuts, slots, cuts.count(), row_id)
    return joined.where(F.col("_shuffle") <= F.col("cutoff")).select(*df.columns)


def _null_safe(column: str) -> Column:
    value = F.col(column).cast("string")
    return F.coalesce(F.concat(F.lit("="), value), F.lit(""))


def stratified_split(
    df: DataFrame,
    fraction: float,
    label: str = "label",
    seed: int = 42,
    row_id: str = "row_id",
    names: tuple[str, str] = ("train", "test"),
) -> DataFrame:
    """Add ``split``: ``round(fraction * class size)`` seeded rows of every class are
    the second name, the others the first."""
    keyed = df.withColumns(
        {"_shuffle": shuffle_key(row_id, seed), "_class": _null_safe(label)}
    )
    cuts = _hash_cutoffs(
        keyed, ["_class"], lambda total: F.round(total.cast("double") * F.lit(fraction))
    )
    joined = lookup_join(keyed, cuts, ["_class"], cuts.count(), row_id, "left")
    held_out = F.coalesce(F.col("_shuffle") <= F.col("cutoff"), F.lit(False))
    split = F.when(held_out, names[1]).otherwise(names[0]).alias("split")
    return joined.select(*df.columns, split)
