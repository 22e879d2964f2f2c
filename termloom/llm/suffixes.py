"""Exact repeats of ``WINDOW`` bytes by suffix arrays.

A byte is removed if a string of ``WINDOW`` bytes that covers it also starts anywhere else, in
the same document or another. Units from ``anchors`` narrow the work: a unit whose
64-byte gram occurs once holds no repeat, and equal units are one class, counted before
anything else is shuffled; a class of two or more repeats as a whole. Every other
class that shares its gram is cut into slices of at most ``SLICE`` windows, which share a
core of WINDOW - SLICE + 1 bytes, and the slices with equal cores form a group. For many
groups at a time a suffix array is built by linear grouping (``gsaca``) over the bytes left
and right of the core, the core being one symbol; neighbours in the array
that agree on a whole window are repeats.

A group never holds more than ``MOST`` slices: a core that more slices share (a passage at
the same place in a third of all documents) is cut further, into single windows, whose
suffixes are equal exactly if they are one string, so counting them sorts them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
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
from termloom.llm.common import ODD, ODD_INVERSE, kept, mixed, signed, text_bytes
from termloom.llm.gsaca import suffix_array

WINDOW = 400
GRAM = 64
SLICE = 32
MOST = 1000
#: Slices that one call sorts together, on average.
BATCH = 400
#: Texts longer than this are hashed in overlapping parts.
PART = 1 << 20


def gram_hashes(text: np.ndarray) -> np.ndarray:
    """Hash of the ``GRAM`` bytes at every place, in parts of bounded size."""
    out = []
    n = len(text) - GRAM + 1
    power = np.full(min(n, PART) + GRAM, ODD, np.uint64)
    power[0] = 1
    back = np.full(min(n, PART), ODD_INVERSE, np.uint64)
    back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    for start in range(0, n, PART):
        part = text[start : start + PART + GRAM - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * power[: len(part)], out=sums[1:])
        size = len(part) - GRAM + 1
        out.append(mixed((sums[GRAM:] - sums[:size]) * back[:size]))
    return np.concatenate(out)


def _units(docs: DataFrame) -> DataFrame:
    """``id, spot, k, e, shape`` for every unit; shape: windows * 512 + bytes before the gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(5)]
            rows = zip(batch["id"].to_pylist(), batch["mark"].to_pylist(), text_bytes(batch["text"]), strict=True)
            for number, mark, text in rows:
                if len(text) < WINDOW:
                    continue
                hashes = gram_hashes(np.frombuffer(text, np.uint8))
                owners = sliding_least(hashes, WINDOW - GRAM + 1)
                first, count = units(owners)
                ends = first + count + WINDOW - 1
                whole = [digest(text[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                out[0].append(np.full(len(first), number, np.int64))
                out[1].append(spot(mark, first))
                out[2].append(hashes[owners[first]])
                out[3].append(np.array(whole, np.uint64))
                out[4].append(count * 512 + owners[first] - first)
            if out[0]:
                made = [signed(np.concatenate(c)) for c in out[:4]] + [np.concatenate(out[4]).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in made], ["id", "spot", "k", "e", "shape"])

    rows = docs.select("id", "mark", "text")
    return rows.mapInArrow(run, "id long, spot long, k long, e long, shape int")


def _slices(docs: DataFrame, open_classes: DataFrame) -> DataFrame:
    """``core, c2, k, e, copies, start, left, right``: the slices of every open class.

    Slices lie on a grid of the distance between window and gram, so equal windows lie
    in slices with the same core. ``start``: the first window, from the class's first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(text_bytes(batch["text"]), batch["places"].to_pylist(), strict=True):
                for p in places:
                    count, lead = divmod(p["shape"], 512)
                    # The window at distance d from the gram starts at lead - d.
                    near = lead - count + 1
                    for cell in range(near // SLICE, lead // SLICE + 1):
                        low, high = max(near, cell * SLICE), min(lead, cell * SLICE + SLICE - 1)
                        gram = p["at"] + lead
                        core_start = gram - cell * SLICE
                        core_end = gram - (cell * SLICE + SLICE - 1) + WINDOW
                        core = xxhash.xxh3_128_digest(text[core_start:core_end], cell)
                        c1, c2 = np.frombuffer(core, np.int64).tolist()
                        rows.append((
                            c1, c2, p["k"], p["e"], p["copies"], lead - high,
                            text[gram - high : core_start], text[core_end : gram - low + WINDOW],
                        ))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            types = [pa.int64()] * 6 + [pa.binary()] * 2
            names = ["core", "c2", "k", "e", "copies", "start", "left", "right"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

    texts = docs.select("id", "mark", "text").join(asked(open_classes), ["id", "mark"])
    schema = """core long, c2 long, k long, e long, copies long, start long, left binary,
    right binary"""
    return texts.select("text", "places").mapInArrow(run, schema)


def repeated_starts(rows: list[tuple[int, bytes, bytes]]) -> list[tuple[int, int]]:
    """(row, start) of the windows that occur at least twice, by one suffix array.

    ``rows``: number of the core, bytes left and right of it. The core counts as
    WINDOW - SLICE + 1 bytes in one symbol.
    """
    size = SLICE  # symbols of a window: the core and the rest of its bytes
    text: list[int] = []
    owner: list[int] = []
    valid: list[bool] = []
    for number, (core, left, right) in enumerate(rows):
        symbols = [*(c + 1 for c in left), 257 + core, *(c + 1 for c in right), 0]
        text += symbols
        owner += [number] * len(symbols)
        last = min(len(left), len(symbols) - 1 - size)
        valid += [i <= last for i in range(len(symbols))]
    begin = {}
    for i, number in enumerate(owner):
        begin.setdefault(number, i)
    coded = np.array(text, np.uint32).tobytes()
    found, before = set(), None
    for i in suffix_array(text):
        if not valid[i]:
            continue
        window = coded[4 * i : 4 * (i + size)]
        if before is not None and before[1] == window:
            found.update((before[0], i))
        before = (i, window)
    return sorted((owner[i], i - begin[owner[i]]) for i in found)


def _sorted_groups(slices: DataFrame, count: int) -> DataFrame:
    """``k, e, at``: repeated windows of the slices, many groups to a suffix array."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        cores = pd.factorize(pd.MultiIndex.from_arrays([group["core"], group["c2"]]))[0]
        rows = list(zip(cores.tolist(), group["left"], group["right"], strict=True))
        found = repeated_starts(rows)
        which = [r for r, _ in found]
        at = group["start"].to_numpy()[which] + np.array([s for _, s in found], np.int64)
        return pd.DataFrame({"k": group["k"].to_numpy()[which], "e": group["e"].to_numpy()[which], "at": at})

    pieces = 1 + count // BATCH
    pieced = slices.withColumn("piece", F.pmod(F.xxhash64("core", "c2"), F.lit(pieces)))
    return pieced.groupBy("piece").applyInPandas(run, "k long, e long, at long")


def _single_windows(slices: DataFrame) -> DataFrame:
    """``k, e, at``: repeated windows of slices whose core too many others share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for core, c2, k, e, start, left, right in zip(
                *[batch[c].to_pylist() for c in ("core", "c2", "k", "e", "start", "left", "right")], strict=True
            ):
                for i in range(min(len(left), len(left) + len(right) - SLICE + 1) + 1):
                    taken = left[i:] + b"|" + right[: SLICE - 1 - (len(left) - i)]
                    h, g = np.frombuffer(xxhash.xxh3_128_digest(taken, len(left) - i), np.int64).tolist()
                    rows.append((core ^ h, c2 ^ g, k, e, start + i))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["h", "g", "k", "e", "at"]
            )

    windows = kept(
        slices.select("core", "c2", "k", "e", "start", "left", "right").mapInArrow(
            run, "h long, g long, k long, e long, at long"
        ),
        "windows",
    )
    many = kept(windows.groupBy("h", "g").count().where("count > 1").select("h", "g"), "many")
    return windows.join(many, ["h", "g"], "left_semi").select("k", "e", "at")


def repeats(rows: DataFrame) -> DataFrame:
    """``id, mark, runs``: starts and counts of the repeated windows of each document."""
    found = _units(rows)
    # Aggregates are written before they are joined: a join of two plain shuffles is one
    # whose hot keys adaptive execution can split.
    shared = kept(found.groupBy("k").count().where("count > 1").select("k"), "grams")
    live = kept(found.join(shared, "k", "left_semi"), "units")
    classes = kept(by_class(live), "classes")
    slices = kept(_slices(rows, classes.where("classes > 1")), "slices")
    sizes = kept(slices.groupBy("core", "c2").count().where("count > 1"), "cores")
    several = slices.join(sizes.where(F.col("count") <= MOST), ["core", "c2"], "left_semi")
    hot = slices.join(sizes.where(F.col("count") > MOST), ["core", "c2"], "left_semi")
    total = sizes.where(F.col("count") <= MOST).agg(F.sum("count")).first()[0] or 0
    single = _sorted_groups(several, total).unionByName(_single_windows(hot))
    own = single.groupBy("k", "e").agg(F.collect_set("at").alias("places"))

    done = classes.join(own, ["k", "e"], "left").where("copies > 1 OR places IS NOT NULL")
    joined = live.join(kept(done.select("k", "e", "copies", "places"), "done"), ["k", "e"])
    at = first_of().cast("long")
    count = F.shiftright("shape", 9).cast("long")
    every = F.array(F.struct(at.alias("start"), count.alias("count")))
    some = F.transform(
        "places", lambda p: F.struct((at + p).alias("start"), F.lit(1).cast("long").alias("count"))
    )
    runs = F.when(F.col("copies") > 1, every).otherwise(some)
    covered = joined.select("id", mark_of(), F.explode(runs).alias("run"))
    return covered.groupBy("id", "mark").agg(F.collect_list("run").alias("runs"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``: one row per row of ``docs``.

    ``kept`` holds the remaining bytes. Null texts are empty. Rows that share id and text are
    two places like any others, so both lose what they share. Rows without an id are treated
    like rows with one.
    """
    rows = slim(docs)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"

    def cleaned(text: bytes, runs: list[dict] | None) -> tuple:
        lasting, spans, removed, end = [], 0, 0, 0
        reach = -1
        for a, b in sorted((r["start"], r["start"] + r["count"] + WINDOW - 1) for r in runs or ()):
            if a > reach:
                lasting.append(text[end:a])
                spans += 1
                removed += b - a
            elif b > reach:
                removed += b - reach
            reach = max(reach, b)
            end = reach
        lasting.append(text[end:])
        kept_bytes = b"".join(lasting)
        return len(text), removed, spans, hashlib.sha256(kept_bytes).hexdigest(), kept_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
        for batch in batches:
            made = [cleaned(t, r) for t, r in zip(text_bytes(batch["text"]), batch["runs"].to_pylist(), strict=True)]
            columns = list(zip(*made, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    joined = rows.join(repeats(rows), ["id", "mark"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(run, schema)
