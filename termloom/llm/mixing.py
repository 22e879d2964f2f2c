"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order (by the MD5 of the id), up to
``EPOCHS`` times over. A document's virtual finish time is its source's running
word count divided by the source's target; all queues are merged by finish time and cut
where the running total reaches the budget, the words of all documents.

Running sums never order a whole source in one task: rows are dealt into pieces of the
order (a prefix of the shuffle hash, a slice of the finish times), pieces are summed, and
a window inside a piece adds the sum of the earlier pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termloom.llm.common import kept, words_of

EPOCHS = 3
WEIGHTS = (1, 2, 3)
PIECE = 10_000


def targets(sources: DataFrame) -> DataFrame:
    """Add ``target`` to one row per source: ``source, source_size``.

    Sources by code point, null last, weigh ``WEIGHTS`` in turn and share all words; a
    target stops at ``EPOCHS`` times its source's size and the excess goes to the others by
    weight. Sources are capped in the order of cap by weight, so each is compared
    once with the level that the sources not yet capped would get.
    """
    by_name = W.orderBy(F.col("source").isNull(), "source")
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS)))
    weight = F.get(F.array(*[F.lit(float(w)) for w in WEIGHTS]), turn)
    cap = (EPOCHS * F.col("source_size")).cast("double")
    sized = sources.withColumn("weight", weight).withColumn("cap", cap)
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.partitionBy()
    left = F.sum("source_size").over(whole).cast("double") - F.coalesce(
        F.sum("cap").over(before), F.lit(0.0)
    )
    level = sized.withColumn("level", left / F.sum("weight").over(after))
    capped = F.col("cap") / F.col("weight") <= F.col("level")
    level = level.withColumn("capped", capped)
    # All sources beyond the first that is not capped get its level.
    common = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(whole)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * common["level"])
    return level.select("source", "source_size", target.alias("target"))


def _running(
    rows: DataFrame, keys: Sequence[str], piece: Column, order: Sequence[Column | str], value: str
) -> DataFrame:
    """Add ``before`` and ``upto``: sums of ``value`` over earlier pieces and, within the
    row's piece, up to the row, by ``keys``. ``piece`` must follow ``order``."""
    keys = list(keys)
    pieced = rows.withColumn("_piece", piece)
    sums = pieced.groupBy(*keys, "_piece").agg(F.sum(value).alias("_sum"))
    earlier = W.partitionBy(*keys).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("before")
    offsets = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_piece").alias("_at"), start)
    here = W.partitionBy(*keys, "_piece").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = pieced.withColumn("_local", F.sum(value).over(here))
    same = local["_piece"] == offsets["_at"]
    for k in keys:
        same = same & local[k].eqNullSafe(offsets[f"_{k}"])
    joined = local.join(offsets, same).drop("_at", *[f"_{k}" for k in keys])
    return joined.withColumn("upto", F.col("before") + F.col("_local")).drop("_local", "_piece")


def _cut(rows: DataFrame, order: Sequence[Column | str], budget: int) -> DataFrame:
    """The first rows in ``order`` whose sizes add up to no more than the budget.

    Slices of the order (``_piece``) before the one that crosses the budget are taken whole;
    only the rows of that one are put in order.
    """
    sums = rows.groupBy("_piece").agg(F.sum("size").alias("sum"))  # one row per slice
    upto = F.sum("sum").over(W.orderBy("_piece").rowsBetween(W.unboundedPreceding, 0))
    beyond = sums.withColumn("upto", upto).where(F.col("upto") > F.lit(budget))
    crossing = beyond.agg(F.min(F.struct("_piece", (F.col("upto") - F.col("sum")).alias("before")))).first()[0]
    if crossing is None:
        return rows
    here = W.partitionBy("_piece").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    last = rows.where(F.col("_piece") == crossing["_piece"]).withColumn("_upto", F.sum("size").over(here))
    last = last.where(F.col("_upto") <= budget - crossing["before"]).drop("_upto")
    return rows.where(F.col("_piece") < crossing["_piece"]).unionByName(last)


def sized(docs: DataFrame) -> DataFrame:
    """``rid, doc_id, source, size``, written once so that every step sees the same rows."""
    size = F.size(words_of(F.col("text").cast("string"))).cast("long").alias("size")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), size
    )
    return kept(slim.select(F.monotonically_increasing_id().alias("rid"), "*"), "sizes")


def plan(rows: DataFrame) -> DataFrame:
    """Add ``source_size, target, taken`` to ``rid, doc_id, source, size``.

    Documents without words take no part and have ``taken`` 0. A null source is a source;
    equal ids keep the order of their sizes. An empty table gives an empty result.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = kept(targets(totals), "targets")
    budget, count = rows.agg(F.sum("size"), F.count("*")).first()
    digits = 1
    while 16**digits * PIECE < count:
        digits += 1
    shuffled = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    queue = rows.where("size > 0").withColumn("_hash", shuffled)
    queue = _running(
        queue, ["source"], F.substring("_hash", 1, digits), ["_hash", "doc_id", "size", "rid"], "size"
    )
    queue = queue.select("rid", "source", "size", "_hash", F.col("upto").alias("cum"))
    named = aims.withColumnRenamed("source", "_source")
    queue = queue.join(named, queue["source"].eqNullSafe(named["_source"])).drop("_source")
    epoch = F.explode(F.array(*[F.lit(e).cast("long") for e in range(EPOCHS)])).alias("epoch")
    queue = queue.select("*", epoch)
    finish = (F.col("epoch") * F.col("source_size") + F.col("cum")).cast("double") / F.col("target")
    queue = kept(queue.select("rid", "source", "size", "epoch", "_hash", finish.alias("finish")), "queue")
    slices = max(64, EPOCHS * count // PIECE)
    piece = F.least(F.floor(F.col("finish") * slices), F.lit(2 * slices)).cast("long")
    order = ["finish", F.col("source").isNull(), "source", "epoch", "_hash", "size", "rid"]
    merged = _cut(queue.withColumn("_piece", piece), order, budget or 0)
    taken = merged.groupBy("rid").agg(F.sum("size").alias("taken"))
    out = rows.join(named, rows["source"].eqNullSafe(named["_source"])).join(taken, "rid", "left")
    return out.select(
        "rid", "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mix with the columns of ``docs``, repeats as rows of their own.

    Documents without words go: the mix takes nothing of them.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.struct(*[F.col(c) for c in docs.columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.size(words_of(F.col("text").cast("string"))).cast("long").alias("size"),
    )
    numbered = kept(numbered, "numbered")
    times = plan(numbered.drop("_row")).where("taken > 0")
    times = times.select("rid", (F.col("taken") / F.col("size")).cast("int").alias("_times"))
    joined = numbered.select("rid", "_row").join(times, "rid")
    copies = F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("_copy")
    return joined.select("_row", copies).select("_row.*")
