"""Anchors of fixed-length windows, shared by the two repeat-removal operators.

Every window of a sequence is owned by the least hash of the short grams inside it (the
leftmost of equal ones), so equal windows anywhere have equal owners at the same offset.
Consecutive windows with one owner make a unit: all that one anchor owns. A unit carries
two hashes: ``k`` of its gram and ``e`` of everything its windows cover. Windows can only be
equal if their units share ``k``, and units that share both are equal window by window.
That is how the operators aggregate before they shuffle anything larger: units whose
gram occurs once are dropped, and equal units count as one class.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import kept, mark

#: Stands for a missing id in the order of documents: last.
LAST_ID = (1 << 63) - 1


def slim(docs: DataFrame) -> DataFrame:
    """``doc_id, id, mark, text``: ``id`` is never null, rows without an id come last."""
    text = F.col("text").cast("string")
    number = F.col("doc_id").cast("long")
    return docs.select(
        number.alias("doc_id"),
        F.coalesce(number, F.lit(LAST_ID)).alias("id"),
        # 31 bits, since a unit carries them in one long with its place.
        mark(text).bitwiseAND(F.lit(0x7FFFFFFF)).alias("mark"),
        F.coalesce(text, F.lit("")).alias("text"),
    )


def sliding_least(hashes: np.ndarray, window: int) -> np.ndarray:
    """Place of the least of every ``window`` consecutive hashes, the leftmost of equals."""
    place = np.arange(len(hashes), dtype=np.uint64)
    low = (hashes & np.uint64(0xFFFFFFFF00000000)) | place
    span = 1
    while 2 * span <= window:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    if span < window:
        rest = window - span
        low = np.minimum(low[: len(low) - rest], low[rest:])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def units(owners: np.ndarray, rows: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each run of equal owners (and equal ``rows``)."""
    new = owners[1:] != owners[:-1]
    if rows is not None:
        new |= rows[1:] != rows[:-1]
    first = np.concatenate(([0], np.flatnonzero(new) + 1))
    return first, np.diff(np.concatenate((first, [len(owners)])))


def spot(marks: int | np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mark of the text and place of the first window in one long."""
    return (np.asarray(marks, np.int64) << np.int64(32)) | first.astype(np.int64)


def mark_of(column: str = "spot") -> Column:
    return F.shiftright(column, 32).alias("mark")


def first_of(column: str = "spot") -> Column:
    return F.col(column).bitwiseAND(F.lit(0xFFFFFFFF))


def by_class(live: DataFrame) -> DataFrame:
    """One row per class (k, e): how many units, first and last document, one unit's place,
    and over the whole gram: how many classes, the first document."""
    found = live.groupBy("k", "e").agg(
        F.count("*").alias("copies"),
        F.min("id").alias("first"),
        F.max("id").alias("last"),
        F.min_by("spot", "id").alias("spot"),
        F.min("shape").alias("shape"),
    )
    found = kept(found, "classes")
    whole = found.groupBy("k").agg(
        F.count("*").alias("classes"), F.min("first").alias("least")
    )
    return found.join(kept(whole.where("classes > 1"), "open"), "k", "left")


def asked(open_classes: DataFrame) -> DataFrame:
    """The places whose text is needed, gathered by document: at most its own units."""
    place = F.struct(
        first_of().cast("long").alias("at"), "shape", "k", "e", F.least("copies", F.lit(2)).alias("copies")
    )
    return open_classes.groupBy(F.col("first").alias("id"), mark_of()).agg(
        F.collect_list(place).alias("places")
    )
