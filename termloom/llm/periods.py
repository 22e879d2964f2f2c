"""Periodic runs of words by block convolution.

A run is a stretch of consecutive words with smallest period q that holds at least ``TIMES``
periods and ``LEAST`` words and that no neighbouring word extends. Periods are searched at
dyadic scales: at scale L those of L to 2L - 1. The text is cut into blocks of L words; a run
of period q there holds at least two whole neighbouring blocks, and each of these occurs again
q words later. The sum of squared differences of a block and every place of the window that
follows it is one convolution, made by a number-theoretic transform of 2L points in exact
integers modulo ``PRIME``. Word numbers are written in digits so small that no sum reaches
``PRIME``, so a sum is zero exactly where every word is equal.

The distances of zero sums are seeds. Seeds of neighbouring blocks with one distance are
chained, chains too short for a run go, as do those inside a run already found whose period
divides theirs (a multiple of a smaller period); the others are extended word by word
by less than a block to either side. The work for n words is of the order n log(n)**2 whatever
the text, each document stays where it is, and all documents of an Arrow batch are
transformed together in pieces of ``ENTRIES`` numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import let, slices, text_bytes, words_of

TIMES = 4
LEAST = 6
#: 15 * 2**27 + 1, and a generator of its multiplicative group.
PRIME = 2013265921
GENERATOR = 31
#: Numbers that are transformed at once, and bytes of text.
ENTRIES = 1 << 18
BYTES = 1 << 21


#: Factors that a worker has made; a cached function would travel by name, and workers have no copy of it.
_MADE: dict[tuple[int, bool], list[np.ndarray]] = {}


def _twiddles(size: int, inverse: bool) -> list[np.ndarray]:
    """Factors of each step of a transform of ``size`` points, made once."""
    if (size, inverse) not in _MADE:
        _MADE[size, inverse] = _factors(size, inverse)
    return _MADE[size, inverse]


def _factors(size: int, inverse: bool) -> list[np.ndarray]:
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    powers = np.ones(max(size // 2, 1), np.uint64)
    span = 1
    while span < len(powers):  # doubling: powers[span:2 * span] = powers[:span] * root**span
        powers[span : 2 * span] = powers[:span] * np.uint64(pow(root, span, PRIME)) % np.uint64(PRIME)
        span *= 2
    place = np.arange(len(powers))
    return [powers[place >> s << s][:, None] for s in range(size.bit_length() - 1)]


def _reduced(x: np.ndarray) -> np.ndarray:
    """``x`` modulo ``PRIME``; division by a constant is far faster than the remainder."""
    x -= x // np.uint64(PRIME) * np.uint64(PRIME)
    return x


def forward(x: np.ndarray) -> np.ndarray:
    """Transform along the first axis; the places of the result are permuted. Values are below
    ``PRIME``, the size is a power of two."""
    prime, half = np.uint64(PRIME), len(x) // 2
    for factor in _twiddles(len(x), False):
        low, high, out = x[:half], x[half:], np.empty_like(x)
        total = low + high
        np.minimum(total, total - prime, out=out[0::2])
        out[1::2] = _reduced((low + prime - high) * factor)
        x = out
    return x


def backward(x: np.ndarray) -> np.ndarray:
    """Undo ``forward`` but for a factor of the size."""
    prime, half = np.uint64(PRIME), len(x) // 2
    for factor in reversed(_twiddles(len(x), True)):
        even, odd, out = x[0::2], _reduced(x[1::2] * factor), np.empty_like(x)
        total = even + odd
        np.minimum(total, total - prime, out=out[:half])
        total = even + (prime - odd)
        np.minimum(total, total - prime, out=out[half:])
        x = out
    return x


def digits(values: np.ndarray, size: int, distinct: int) -> list[np.ndarray]:
    """``values`` below ``distinct`` in as few digits as keep a sum of ``size`` squared differences
    below ``PRIME``."""
    count = 1
    while (base := math.isqrt((PRIME - 1) // (count * size)) + 1) ** count < distinct:
        count += 1
    return [values // np.uint64(base**k) % np.uint64(base) if count > 1 else values for k in range(count)]


def zero_places(text: np.ndarray, starts: np.ndarray, size: int, distinct: int) -> np.ndarray:
    """Where the blocks ``text[start:start + size]`` occur in the windows that follow them.

    ``text`` is padded by 3 * size words. Returns booleans (distance - size, block).
    """
    shape = (len(starts), 2 * size) if size >= 32 else (2 * size, len(starts))
    sums, squares = None, np.zeros((size, len(starts)), np.uint64)
    for part in digits(text, size, distinct):
        rows = np.zeros((2, *shape), np.uint64)  # long axis innermost
        block, window = (r.T if size >= 32 else r for r in rows)
        spots = starts[None, :] + np.arange(size)[:, None]
        block[:size] = part[spots[::-1]]
        window[:size] = part[spots + size]
        window[size:] = part[spots + 2 * size]
        own = (block[:size] ** 2).sum(axis=0)
        upto = np.cumsum(window**2, axis=0)
        squares += own + upto[size - 1 : 2 * size - 1]
        squares[1:] -= upto[: size - 1]
        product = _reduced(forward(block) * forward(window))
        sums = product if sums is None else sums + product
    common = backward(_reduced(sums))[size - 1 : 2 * size - 1]
    scale = np.uint64(2 * pow(2 * size, -1, PRIME) % PRIME)
    return _reduced(common * scale) == _reduced(squares)


def seeds(text: np.ndarray, first: np.ndarray, sizes: np.ndarray, distinct: np.ndarray, size: int):
    """(document, block, distance) arrays of the zero places at one scale."""
    docs = np.flatnonzero(sizes >= TIMES * size)
    counts = sizes[docs] // size - 1
    owner = np.repeat(docs, counts)
    block = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    found = []
    step = max(1, ENTRIES // (2 * size))
    for k in range(0, len(owner), step):
        who, at = owner[k : k + step], block[k : k + step] * size
        zero = zero_places(text, first[who] + at, size, int(distinct[who].max()))
        apart = np.arange(size, 2 * size)[:, None]
        zero &= (at + apart + size <= sizes[who]) & (TIMES * apart <= sizes[who])
        away, which = np.nonzero(zero)
        found.append((who[which], block[k : k + step][which], away + size))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 3


def chains(doc: np.ndarray, block: np.ndarray, distance: np.ndarray, size: int):
    """(document, first word, end, distance) of the chains of neighbouring blocks that may be
    part of a run."""
    order = np.lexsort((block, distance, doc))
    doc, block, distance = doc[order], block[order], distance[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (distance[1:] != distance[:-1]) | (block[1:] != block[:-1] + 1)
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(doc)))
    doc, distance, begin = doc[at], distance[at], block[at] * size
    enough = length * size + 2 * (size - 1) >= (TIMES - 1) * distance
    return doc[enough], begin[enough], (begin + length * size)[enough], distance[enough]


def extended(words: np.ndarray, begin: int, end: int, distance: int, size: int) -> tuple[int, int]:
    """The widest stretch around words ``begin`` to ``end``, equal to those ``distance`` later."""
    low = max(0, begin - size)
    same = words[low:begin] == words[low + distance : begin + distance]
    apart = np.flatnonzero(~same)
    start = low + int(apart[-1]) + 1 if len(apart) else low
    high = min(end + size, len(words) - distance)
    apart = np.flatnonzero(words[end:high] != words[end + distance : high + distance])
    return start, end + int(apart[0]) if len(apart) else high


def multiples(found: list[tuple[int, int, int]], begin: np.ndarray, end: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Which stretches lie inside a found run (start, length, period) that divides their distance."""
    inside = np.zeros(len(begin), bool)
    by_period: dict[int, list[tuple[int, int]]] = {}
    for start, length, period in found:
        by_period.setdefault(period, []).append((start, start + length))
    for period, runs in by_period.items():
        # Maximal runs of one period are in the same order by start and by end.
        runs = np.array(sorted(runs))
        at = np.searchsorted(runs[:, 0], begin, side="right") - 1
        covered = (at >= 0) & (runs[np.maximum(at, 0), 1] >= end + distance)
        inside |= covered & (distance % period == 0)
    return inside


def batch_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each list of words, by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(texts) or sizes.max() < LEAST:
        return found
    numbered, distinct = [], []
    for words in texts:
        known: dict[bytes, int] = {}
        numbered.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.uint64, len(words)))
        distinct.append(max(1, len(known)))
    first = np.cumsum(sizes) - sizes
    text = np.concatenate([*numbered, np.zeros(3 * int(sizes.max()), np.uint64)])
    size = 1
    while TIMES * size <= sizes.max():
        doc, begin, end, distance = chains(*seeds(text, first, sizes, np.array(distinct), size), size)
        cuts = np.flatnonzero(np.diff(doc)) + 1
        for part in np.split(np.arange(len(doc)), cuts) if len(doc) else []:
            number = int(doc[part[0]])
            known = multiples(found[number], begin[part], end[part], distance[part])
            for i in part[~known].tolist():
                apart = int(distance[i])
                start, stop = extended(numbered[number], int(begin[i]), int(end[i]), apart, size)
                length = stop - start + apart
                if length >= max(LEAST, TIMES * apart):
                    found[number].append((start, length, apart))
        size *= 2
    return [sorted(f, key=lambda r: (r[0], r[2])) for f in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)])


SCHEMA = """doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>,
text string"""


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, text``: one row per row of ``docs``.

    ``runs`` lists every run by start, then period; ``text`` holds the words that stay when
    each run keeps its first period, joined by one space. Null, empty and blank texts have no
    words, no runs and an empty text. Ids play no part: equal or missing ones change nothing,
    rows that repeat are rows of their own. An empty table gives an empty result; further
    columns of ``docs`` are not read.
    """
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, BYTES):
                texts = [t.split() for t in text_bytes(part["text"])]
                found = batch_runs(texts)
                flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
                ends = np.concatenate(([0], np.cumsum([len(runs) for runs in found]))).astype(np.int32)
                structs = pa.StructArray.from_arrays([pa.array(c) for c in flat.T], fields=list(run_type))
                lists = pa.ListArray.from_arrays(pa.array(ends), structs)
                sizes = pa.array([len(t) for t in texts], pa.int64())
                kept = [collapsed(t, runs).decode() for t, runs in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], sizes, lists, pa.array(kept, pa.string())], ["doc_id", "n_words", "runs", "text"]
                )

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: every tenth document by the checksum of its id with a periodic tail.

    With h the checksum, g = h // 10 and n words, the words from a = g mod n on become
    repetitions of the p = 1 + (n - a) // (3 + g mod 8) words there. Rows without an id and
    texts without words stay as they are.
    """
    number = F.col("doc_id").cast("long")
    text = F.col("text").cast("string")
    check = F.crc32(number.cast("string"))
    g = F.floor(check / 10).cast("long")

    def tail(words: Column) -> Column:
        n = F.size(words).cast("long")

        def from_place(at: Column) -> Column:
            def of_period(period: Column) -> Column:
                return F.array_join(
                    F.transform(
                        words,
                        lambda w, i: F.when(i >= at, F.get(words, (at + (i - at) % period).cast("int"))).otherwise(w),
                    ),
                    " ",
                )

            return let(1 + F.floor((n - at) / (3 + g % 8)).cast("long"), of_period)

        return F.when(n > 0, let(g % n, from_place)).otherwise(text)

    changed = F.when(check % 10 == 0, let(words_of(text), tail)).otherwise(text)
    return docs.select(number.alias("doc_id"), changed.alias("text"))


def best(runs: Column) -> Column:
    """The run of the greatest exact length / period, the first by start, then period, of equals."""
    nothing = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(
        runs,
        nothing,
        lambda held, x: F.when(
            held.isNull() | (x["length"] * held["period"] > held["length"] * x["period"]), x
        ).otherwise(held),
    )
