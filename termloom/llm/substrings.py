"""Substring deduplication with fixed-block anchors.

A word is removed if a window of ``WINDOW`` words that covers it also starts in a document
with a smaller id. Blocks of ``BLOCK`` words at fixed, non-overlapping places of each
document are the index; ``WINDOW`` = 2 * ``BLOCK`` - 1, so every window holds a whole
block. Every rolling ``BLOCK``-word window is a probe; a probe that meets a block of an
earlier document is a hit, and hits are extended to the windows around them, which are
compared whole (two 64-bit hashes) with the reference windows. Joined windows make the
maximal repeats.

Index and probes do not run over raw documents but over the classes of units from
``anchors``: units whose gram occurs in one document only cannot hold a hit, and equal
units are one class, so a passage that a third of all documents share is indexed and
probed once. An index entry keeps the smallest id, so no pairs are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.anchors import (
    asked,
    by_class,
    first_of,
    mark_of,
    sliding_least,
    slim,
    spot,
    units,
)
from termloom.llm.common import Ranges, WordHashes, grams, kept, signed, slices, text_bytes

WINDOW = 13
BLOCK = 7
GRAM = 4
SECOND = 0xD6E8FEB86659FD93  # multiplier of the second hash of a window
#: Bytes of text that are worked on at once.
BYTES = 1 << 22


def _units(docs: DataFrame, whole: bool) -> DataFrame:
    """``id, k`` of every unit of every document; with ``whole`` also ``spot, e, shape`` (the
    number of windows), which only the units that share a gram need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            for part in slices(batch, BYTES):
                hashes, sizes = words.of_texts(text_bytes(part["text"]))
                if len(hashes) < WINDOW:
                    continue
                # All documents of the slice at once; windows that cross from one to the next go.
                begin = np.cumsum(sizes) - sizes
                owner = np.repeat(np.arange(len(sizes)), np.maximum(sizes - WINDOW + 1, 0))
                if not len(owner):
                    continue
                counts = np.maximum(sizes - WINDOW + 1, 0)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                windows = begin[owner] + place
                small = grams(hashes, GRAM)
                owners = sliding_least(small, WINDOW - GRAM + 1)[windows]
                first, count = units(owners, owner)
                row = owner[first]
                columns = [part["id"].to_numpy(zero_copy_only=False)[row], signed(small[owners[first]])]
                if whole:
                    start = windows[first]
                    every = Ranges(hashes).hashes(start, start + count + WINDOW - 1)
                    marks = part["mark"].to_numpy(zero_copy_only=False)[row]
                    columns += [spot(marks, place[first]), signed(every + count.astype(np.uint64)), count.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    names = ["id", "k", "spot", "e", "shape"] if whole else ["id", "k"]
    schema = "id long, k long, spot long, e long, shape int" if whole else "id long, k long"
    return docs.select("id", "mark", "text").mapInArrow(run, schema)


def _opened(docs: DataFrame, open_classes: DataFrame) -> DataFrame:
    """``id, k, e, at, words``: the word hashes that the windows of a class cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for part in slices(batch, BYTES):
                hashes, sizes = cache.of_texts(text_bytes(part["text"]))
                begin = np.cumsum(sizes) - sizes
                counts = part["places"].value_lengths().to_numpy(zero_copy_only=False)
                row = np.repeat(np.arange(len(sizes)), counts)
                places = part["places"].flatten()
                at, shape, k, e = (
                    places.field(c).to_numpy(zero_copy_only=False) for c in ("at", "shape", "k", "e")
                )
                lengths = shape.astype(np.int64) + WINDOW - 1
                ends = np.cumsum(lengths)
                taken = np.arange(lengths.sum()) + np.repeat(begin[row] + at - (ends - lengths), lengths)
                offsets = np.concatenate(([0], ends)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(hashes[taken])))
                numbers = part["id"].to_numpy(zero_copy_only=False)[row]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c) for c in (numbers, k, e, at)], lists], ["id", "k", "e", "at", "words"]
                )

    texts = docs.select("id", "mark", "text").join(asked(open_classes), ["id", "mark"])
    return texts.select("id", "text", "places").mapInArrow(
        run, "id long, k long, e long, at long, words array<long>"
    )


def _emitted(opened: DataFrame, what: str) -> DataFrame:
    """Rows ``h, g, id, k, e, place`` of the classes: their index blocks, their probes, or
    their windows (``place`` from the class's first word; ``g`` is 0 but for windows)."""

    size = WINDOW if what == "windows" else BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch["words"].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = batch["words"].flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            # All classes of the batch at once; runs that cross from one to the next go.
            starts = np.cumsum(lengths) - lengths
            row = np.repeat(np.arange(len(lengths)), np.maximum(lengths - size + 1, 0))
            if not len(row):
                continue
            counts = np.bincount(row, minlength=len(lengths))
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            meta = [batch[c].to_numpy(zero_copy_only=False) for c in ("id", "k", "e", "at")]
            if what == "blocks":
                fixed = (place + meta[3][row]) % BLOCK == 0
                row, place = row[fixed], place[fixed]
            spots = starts[row] + place
            h = signed(grams(flat, size)[spots])
            g = signed(grams(flat, size, SECOND)[spots]) if what == "windows" else np.zeros(len(h), np.int64)
            made = [h, g, *(m[row] for m in meta[:3]), place.astype(np.int32)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in made], ["h", "g", "id", "k", "e", "place"]
            )

    return opened.mapInArrow(run, "h long, g long, id long, k long, e long, place int")


def repeats(rows: DataFrame) -> DataFrame:
    """``id, mark, runs``: starts and counts of the windows that an earlier document has."""
    shared = _units(rows, False).groupBy("k").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b")
    live = kept(_units(rows, True).join(kept(shared.select("k"), "grams"), "k", "left_semi"), "units")
    classes = kept(by_class(live), "classes")
    opened = kept(_opened(rows, classes.where("classes > 1")), "opened")

    # Aggregates are written before they are joined: a join of two plain shuffles is one
    # whose hot keys adaptive execution can split.
    index = kept(_emitted(opened, "blocks").groupBy("h").agg(F.min("id").alias("least")), "index")
    probes = _emitted(opened, "probes").select("h", "id", "k", "e", "place")
    hits = probes.join(index, "h").where("least < id").select("k", "e", F.col("place").alias("hit"))
    # A class has a few words, so its lists of hits and places are short.
    hits = kept(hits.groupBy("k", "e").agg(F.collect_set("hit").alias("hits")), "hits")
    windows = kept(_emitted(opened, "windows"), "windows")
    reference = kept(windows.groupBy("h", "g").agg(F.min("id").alias("least")), "reference")
    near = windows.join(hits, ["k", "e"]).where(
        F.exists("hits", lambda x: (x >= F.col("place")) & (x <= F.col("place") + (WINDOW - BLOCK)))
    )
    extended = near.join(reference, ["h", "g"]).where("least < id")
    own = extended.groupBy("k", "e").agg(F.collect_set("place").alias("places"))

    done = classes.join(own, ["k", "e"], "left").where("last > first OR places IS NOT NULL")
    done = kept(done.select("k", "e", "first", "places"), "done")
    joined = live.join(done, ["k", "e"])
    at = first_of().cast("long")
    every = F.array(F.struct(at.alias("start"), F.col("shape").cast("long").alias("count")))
    some = F.transform(
        "places", lambda p: F.struct((at + p).alias("start"), F.lit(1).cast("long").alias("count"))
    )
    runs = F.when(F.col("id") > F.col("first"), every).otherwise(some)
    covered = joined.select("id", mark_of(), F.explode(runs).alias("run"))
    return covered.groupBy("id", "mark").agg(F.collect_list("run").alias("runs"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_words, n_removed``: one row per row of ``docs``.

    ``text`` holds the kept words joined by one blank. Null texts have no words. Rows without
    an id come after all others and never count as earlier than one another; rows
    that share an id belong to one document in the order of ids.
    """
    rows = slim(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, sizes, removed = [], [], []
            for text, runs in zip(text_bytes(batch["text"]), batch["runs"].to_pylist(), strict=True):
                words = text.split()
                edges = np.zeros(len(words) + 1, np.int64)
                for r in runs or ():
                    edges[r["start"]] += 1
                    edges[r["start"] + r["count"] + WINDOW - 1] -= 1
                stays = np.cumsum(edges[:-1]) == 0
                lasting = [words[i] for i in np.flatnonzero(stays)] if runs else words
                texts.append(b" ".join(lasting).decode())
                sizes.append(len(words))
                removed.append(len(words) - len(lasting))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(texts, pa.string()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())],
                ["doc_id", "text", "n_words", "n_removed"],
            )

    joined = rows.join(repeats(rows), ["id", "mark"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(run, "doc_id long, text string, n_words long, n_removed long")


