"""Sharding over a hierarchical weighted hash tree of regions, racks and shards.

Every shard draws -ln(u) / weight for a document, u being a hash of (id, shard). A rack's
draw is the least of its shards' draws and a region's the least of its racks', which is
what a draw with the summed weight is distributed like. A document descends to the region,
the rack and the shard with the least draw. A changed weight changes the draws of
its own subtree alone, so documents move only into or out of that subtree, and a new
shard takes documents only into itself.

Slots are numbered without a window over a whole shard: rows are dealt into pieces of a
shard, pieces are counted, and a row's slot is its place in its piece after the earlier
pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termloom.llm.common import let

SHARDS = 16
SHARDS_PER_RACK = 4
RACKS_PER_REGION = 2
PIECE = 5_000


def tree(weights: Sequence[float]) -> list[list[list[tuple[int, float]]]]:
    """Regions of racks of (shard, weight), filled in order."""
    leaves = list(enumerate(weights))
    racks = [leaves[i : i + SHARDS_PER_RACK] for i in range(0, len(leaves), SHARDS_PER_RACK)]
    return [racks[i : i + RACKS_PER_REGION] for i in range(0, len(racks), RACKS_PER_REGION)]


def _draw(key: Column, shard: int, weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit("shard"), F.lit(shard), key), 11)
    return -F.log((bits.cast("double") + 0.5) / float(1 << 53)) / weight


def _least_child(children: Column, draw) -> Column:
    """The child with the least draw, the earlier one if two are equal."""
    found = F.array_min(F.transform(children, lambda c, i: F.struct(draw(c).alias("d"), i.alias("i"))))
    return F.get(children, found["i"])


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """Shard of a key under one weight per shard; a null key is a key like any other."""
    def leaf(shard: int, weight: float) -> Column:
        return F.struct(_draw(key, shard, weight).alias("draw"), F.lit(shard).alias("shard"))

    regions = F.array(
        *[F.array(*[F.array(*[leaf(*x) for x in rack]) for rack in region]) for region in tree(weights)]
    )

    def of_rack(rack: Column) -> Column:
        return F.array_min(F.transform(rack, lambda x: x["draw"]))

    def of_region(region: Column) -> Column:
        return F.array_min(F.transform(region, of_rack))

    def descend(top: Column) -> Column:
        rack = let(_least_child(top, of_region), lambda region: _least_child(region, of_rack))
        return let(rack, lambda r: _least_child(r, lambda x: x["draw"])["shard"])

    return let(regions, descend)


def sharded(docs: DataFrame, carry: Sequence[str], weights: Sequence[float] = (1.0,) * SHARDS) -> DataFrame:
    """``carry`` columns in a struct ``row``, then ``doc_id, size, text_crc32, law, shard, slot,
    grown_shard``.

    A null text has no bytes (size 1, checksum 0). Rows with equal ids go to one shard and
    get slots of their own; a null id is an id. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.col("doc_id").cast("long")
    count = docs.count()
    pieces = 1 + count // (len(weights) * PIECE)
    rows = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"),
        key.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        shard_of(key, weights).alias("shard"),
        shard_of(key, [*weights, 1.0]).alias("grown_shard"),
        F.pmod(F.xxhash64(F.lit("piece"), key, text), F.lit(pieces)).alias("piece"),
    )
    slim = docs.select(
        shard_of(key, weights).alias("shard"),
        F.pmod(F.xxhash64(F.lit("piece"), key, text), F.lit(pieces)).alias("piece"),
    )
    earlier = W.partitionBy("shard").orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    counted = slim.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    starts = counted.select(
        "shard", "piece", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")
    )
    place = F.row_number().over(W.partitionBy("shard", "piece").orderBy("doc_id", "text_crc32", "size"))
    placed = rows.withColumn("place", place).join(starts, ["shard", "piece"])
    slot = (F.col("start") + F.col("place") - 1).cast("long").alias("slot")
    law = F.lit("key").alias("law")
    return placed.select("row", "doc_id", "size", "text_crc32", law, "shard", slot, "grown_shard")
