"""Line deduplication over overlapping three-line windows.

Every run of three consecutive lines is hashed; a run that occurs more than once in the
corpus keeps its first occurrence (by document id, then place), and the lines that later
occurrences cover are removed, overlapping runs merged. Two 64-bit hashes stand for a run.
The first place of a run is a partial aggregate; later places are found by a join that
adaptive execution can split, so a run found in a third of all documents needs no
task of its own. Texts are shuffled once, to meet their list of removed lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import kept, let, mark

WINDOW = 3


def lines_of(text: Column) -> Column:
    """Lines of a text; one empty line for the empty text, none for null."""
    return F.coalesce(F.split(text, "\n"), F.array().cast("array<string>"))


def _windows(lines: Column) -> Column:
    def hashed(i: Column) -> Column:
        run = [F.get(lines, i + k) for k in range(WINDOW)]
        return F.struct(
            i.alias("at"),
            F.xxhash64(*run).alias("h"),
            F.xxhash64(F.lit("second"), *reversed(run)).alias("g"),
        )

    spots = F.sequence(F.lit(0), F.size(lines) - WINDOW)
    return F.when(F.size(lines) >= WINDOW, F.transform(spots, hashed))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_lines, n_removed``: one row per row of ``docs``.

    ``text`` holds the kept lines (null stays null). Rows without an id come last in the
    order of occurrences; rows that share an id are ordered by a hash of their text, and
    rows that share both count as one occurrence.
    """
    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), mark(text).alias("mark"), text.alias("text")
    )
    windows = kept(
        rows.select("doc_id", "mark", F.explode(let(lines_of(F.col("text")), _windows)).alias("w")).select(
            F.struct(
                F.col("doc_id").isNull().alias("late"), "doc_id", "mark", F.col("w.at").alias("at")
            ).alias("place"),
            "w.h",
            "w.g",
        ),
        "windows",
    )
    first = windows.groupBy("h", "g").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    # Written before the join, so that adaptive execution can split its hot keys.
    first = kept(first.where("n > 1").drop("n"), "first")
    later = windows.join(first, ["h", "g"]).where(F.col("place") > F.col("first"))
    spots = later.groupBy(F.col("place.doc_id").alias("_id"), F.col("place.mark").alias("_mark")).agg(
        F.collect_set("place.at").alias("spots")
    )
    same = rows["doc_id"].eqNullSafe(spots["_id"]) & (rows["mark"] == spots["_mark"])
    joined = rows.join(spots, same, "left")

    def cleaned(lines: Column) -> Column:
        covered = F.flatten(F.transform("spots", lambda s: F.sequence(s, s + (WINDOW - 1))))
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), covered)
        some = let(stay, lambda i: F.transform(i, lambda k: F.get(lines, k)))
        lasting = F.when(F.col("spots").isNull(), lines).otherwise(some)
        return F.struct(lasting.alias("lasting"), F.size(lines).alias("n"))

    made = joined.select("doc_id", "text", let(lines_of(F.col("text")), cleaned).alias("c"))
    return made.select(
        "doc_id",
        F.when(F.col("text").isNotNull(), F.array_join("c.lasting", "\n")).alias("text"),
        F.col("c.n").cast("long").alias("n_lines"),
        (F.col("c.n") - F.size("c.lasting")).cast("long").alias("n_removed"),
    )
