"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints of 64 bits are made in Arrow batches. For a radius of two bits seven
structured masks cover every pair: bit i carries the vector (i mod 7) + 1 of three bits,
mask v keeps the bits whose vector has an odd product with v. The vectors of any two
differing bits leave at least one v that both miss, so the pair is equal under that
mask. Only fingerprints that share a masked value with another one go on; copies were
collapsed before, and no pairs are made inside a table: the remaining
fingerprints are linked exactly through the values one bit away (two fingerprints within
two bits share such a value, and only those do), each value keeping its least member.
Connected components alternate large-star and small-star steps on the written edges.

``distinct_documents`` keeps one document of each class; the bit distance alone decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import kept, mark, text_bytes

SEED = 42
SHINGLE = 3
RADIUS = 2


def masks() -> list[int]:
    """The covering masks for the radius: 2**(radius + 1) - 1 of them."""
    size = RADIUS + 1
    vectors = [i % (2**size - 1) + 1 for i in range(64)]
    return [
        sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2)
        for v in range(1, 2**size)
    ]


def fingerprint(text: bytes) -> int:
    """Majority bits of the XXH64 of all word shingles; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(SHINGLE, len(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :], strict=False)], np.uint64
    )
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):  # long texts in pieces
        part = hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, fp``: the fingerprint of every row as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in text_bytes(batch["text"])], np.uint64)
            columns = [batch["doc_id"], batch["mark"], pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "fp"])

    text = F.col("text").cast("string")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), mark(text).alias("mark"), text.alias("text")
    )
    return slim.mapInArrow(run, "doc_id long, mark long, fp long")


def links(fps: DataFrame) -> DataFrame:
    """Edges ``a > b`` between distinct fingerprints (column ``fp``) within the radius."""
    tables = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_long(m))) for m in masks()]))
    keyed = fps.select("fp", tables.alias("table", "value"))
    shared = keyed.groupBy("table", "value").count().where("count > 1").drop("count")
    near = kept(keyed.join(shared, ["table", "value"], "left_semi").select("fp").distinct(), "near")
    flips = [F.col("fp").bitwiseXOR(F.lit(_long(1 << i))) for i in range(64)]
    through = near.select("fp", F.explode(F.array(F.col("fp"), *flips)).alias("via"))
    least = through.groupBy("via").agg(F.min("fp").alias("b"), F.max("fp").alias("most"))
    least = least.where("b < most").drop("most")
    edges = through.join(least, "via").where("fp > b")
    return edges.select(F.col("fp").alias("a"), "b").distinct()


def _long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def components(edges: DataFrame) -> DataFrame:
    """``a, b``: every node that has an edge, and the least node that it can reach."""
    edges = kept(edges, "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = kept(large.where("a != b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        edges = kept(small.where("a != b").distinct(), "edges")
        found = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if found == state:
            return edges
        state = found


def _rooted(prints: DataFrame) -> DataFrame:
    """``prints`` (written) with ``root`` and ``component_id``."""
    ids = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(ids.select("fp")))
    roots = roots.select(F.col("a").alias("fp"), F.col("b").alias("root"))
    rooted = ids.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.drop("least").join(first, "root"), "fp")


def classes(docs: DataFrame) -> DataFrame:
    """``doc_id, mark, fp, root, component_id``: one row per row of ``docs``.

    Texts without words (null too) have fingerprint zero and are linked like any other.
    Rows with equal ids or texts are rows of their own. ``root`` is the least fingerprint
    of the class, ``component_id`` the smallest id in it; rows without an id never give one.
    """
    return _rooted(kept(fingerprints(docs), "prints"))


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest id, with all its columns.

    Classes are what ``classes`` links: fingerprints of ``SHINGLE`` words within ``RADIUS``
    bits, chains included. A class in which no row has an id keeps one of its rows; rows
    that share id and text count as one. Texts without words are copies of each other. An
    empty table stays empty; further columns are kept, whatever their names.

    Decisions are made on narrow tables, which are written, so Spark knows their size and
    broadcasts what is below its threshold; beyond it the texts are shuffled once.
    """
    own = ["_none", "_id", "_mark"]
    text = F.col("text").cast("string")
    identity = _identity(F.col("doc_id").cast("long"), text)
    rooted = kept(classes(docs), "rooted")
    keys = _identity(F.col("doc_id"), None)
    firsts = rooted.select("root", *keys).groupBy("root").agg(F.min(F.struct(*own)).alias("first"))
    stay = kept(firsts.select("first.*"), "stay")
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row"), *identity)
    rows = rows.join(stay, own, "left_semi")
    repeated = rooted.select(*keys).join(stay, own, "left_semi").groupBy(*own).count()
    if not repeated.where("count > 1").isEmpty():
        rows = rows.dropDuplicates(own)
    return rows.select("_row.*")


def _identity(number: Column, text: Column | None) -> list[Column]:
    """Keys of a row that are never null: whether it has no id, the id, the mark of its text
    (the column ``mark`` if there is no text)."""
    return [
        number.isNull().alias("_none"),
        F.coalesce(number, F.lit(0).cast("long")).alias("_id"),
        (F.col("mark") if text is None else mark(text)).alias("_mark"),
    ]
