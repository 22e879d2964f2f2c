"""Benchmark decontamination with SimHash over item-sized windows.

A document leaks a benchmark item if a window as long as the item holds at least
``SIMILARITY`` of the item's weighted five-word shingles (weight: how often a shingle
occurs). Windows without a common shingle have similarity zero, so only the
windows that a common shingle lines up with an item are looked at; each gets a 64-bit
SimHash of its words. A multi-index over the items' fingerprints finds every item within
``RADIUS`` bits: six blocks of the bits, one of which differs in at most RADIUS // 6
bits, so all neighbours of a block value are looked up. Candidates are then
compared exactly on their shingles.

Documents stay where they are: no shuffle. The benchmark is broadcast in blocks of at
most ``BLOCK_BYTES`` of text, one pass over the documents for each.
"""

from __future__ import annotations

import itertools
import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import WordHashes, grams, text_bytes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 16
BLOCK_BYTES = 8_000_000
#: Borders of the blocks of a fingerprint's bits.
CUTS = [0, 11, 22, 33, 44, 54, 64]
#: Upper- to lower-case ASCII letters; other ASCII signs than letters and digits part words.
FOLD = bytes(
    ord(chr(c).lower()) if c >= 128 or chr(c).isalnum() else 32 for c in range(128)
) + bytes(range(128, 256))
FILTER_BITS = 22


def tokens(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the shingles; of the whole sequence if it is shorter than one."""
    return grams(hashes, min(SHINGLE, len(hashes))) if len(hashes) else hashes


def simhash(hashes: np.ndarray) -> int:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def similarity(item: Counter, window: Counter) -> float:
    """Share of the item's shingle weight that the window holds."""
    return sum(min(n, window[s]) for s, n in item.items()) / sum(item.values())


class MultiIndex:
    """Finds every fingerprint within ``RADIUS`` bits of a given one."""

    def __init__(self, prints: list[int]):
        self.prints = prints
        self.blocks = list(itertools.pairwise(CUTS))
        apart = RADIUS // len(self.blocks)
        self.near, self.tables = [], []
        for a, b in self.blocks:
            flips = [c for k in range(apart + 1) for c in itertools.combinations(range(b - a), k)]
            self.near.append([sum(1 << i for i in c) for c in flips])
            values = defaultdict(list)
            for number, x in enumerate(prints):
                values[x >> a & (1 << b - a) - 1].append(number)
            self.tables.append(dict(values))

    def within(self, x: int) -> set[int]:
        found = set()
        for (a, b), near, values in zip(self.blocks, self.near, self.tables, strict=True):
            own = x >> a & (1 << b - a) - 1
            for flip in near:
                found.update(values.get(own ^ flip, ()))
        return {i for i in found if (self.prints[i] ^ x).bit_count() <= RADIUS}


class Benchmark:
    """Items of one block of the benchmark, ready to be looked up."""

    def __init__(self, items: list[tuple[int, bytes]]):
        words = WordHashes()
        hashed = [(i, words.of(tokens(t))) for i, t in items]
        hashed = [(i, h) for i, h in hashed if len(h)]
        self.ids = [i for i, _ in hashed]
        self.sizes = [len(h) for _, h in hashed]
        self.weights = [Counter(shingles(h).tolist()) for _, h in hashed]
        self.index = MultiIndex([simhash(h) for _, h in hashed])
        #: By shingle length: where a shingle stands, as (item length, offset).
        self.places: dict[int, dict[int, set]] = defaultdict(lambda: defaultdict(set))
        for _, h in hashed:
            for offset, s in enumerate(shingles(h).tolist()):
                self.places[min(SHINGLE, len(h))][s].add((len(h), offset))
        self.places = {k: dict(v) for k, v in self.places.items()}
        self.filters = {}
        for length, known in self.places.items():
            flags = np.zeros(1 << FILTER_BITS, bool)
            flags[np.fromiter(known, np.uint64, len(known)) >> np.uint64(64 - FILTER_BITS)] = True
            self.filters[length] = flags

    def windows(self, hashes: np.ndarray) -> set[tuple[int, int]]:
        """(start, end) of the windows that a common shingle lines up with an item."""
        found = set()
        for length, flags in self.filters.items():
            values = grams(hashes, length)
            maybe = np.flatnonzero(flags[values >> np.uint64(64 - FILTER_BITS)])
            known = self.places[length]
            for at, s in zip(maybe.tolist(), values[maybe].tolist(), strict=True):
                for size, offset in known.get(s, ()):
                    start = max(0, min(at - offset, len(hashes) - size))
                    found.add((start, min(start + size, len(hashes))))
        return found

    def leaks(self, hashes: np.ndarray) -> list[tuple[int, float, int, int]]:
        """Best window by item that is leaked: (item, similarity, first word, words)."""
        best: dict[int, tuple[float, int, int]] = {}
        for start, end in sorted(self.windows(hashes)):
            part = hashes[start:end]
            near = [
                i for i in self.index.within(simhash(part))
                if end - start == min(self.sizes[i], len(hashes))
            ]
            held = {}
            for i in near:
                length = min(SHINGLE, self.sizes[i])
                if length not in held:
                    held[length] = Counter(grams(part, length).tolist())
                score = similarity(self.weights[i], held[length])
                if score >= SIMILARITY and score > best.get(i, (0.0,))[0]:
                    best[i] = (score, start, end - start)
        return sorted((self.ids[i], *found) for i, found in best.items())


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """The benchmark's items in blocks of bounded size; null texts are left out."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // BLOCK_BYTES)
    for k in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == k)
        yield [(r["item_id"], r["text"].encode()) for r in part.orderBy("item_id").collect()]


def _sent(docs: DataFrame, block: list[tuple[int, bytes]]) -> Broadcast:
    """A block of the benchmark, prepared and broadcast with its class, so that workers need
    no copy of this package."""
    return docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Benchmark(block)))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, n_words`` for each leaked item.

    Documents without words (null, empty) leak nothing; items without words are never
    leaked, items shorter than a shingle need their whole sequence. Rows that share
    an id are searched each on its own.
    """
    schema = "doc_id long, item_id long, similarity double, first_word long, n_words long"
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(benchmark):
        sent = _sent(docs, block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            words, known = WordHashes(), pickle.loads(sent.value)
            for batch in batches:
                rows = [
                    (doc_id, *x)
                    for doc_id, text in zip(batch["doc_id"].to_pylist(), text_bytes(batch["text"]), strict=True)
                    for x in known.leaks(words.of(tokens(text)))
                ]
                names = ["doc_id", "item_id", "similarity", "first_word", "n_words"]
                types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                columns = list(zip(*rows, strict=True)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
                )

        out = out.unionByName(slim.mapInArrow(run, schema))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item, with all their columns.

    Documents without words (null, empty) stay, as do all under a benchmark without items or
    with null texts only. Repeated rows are judged each on its own, ids play no part, and
    further columns are kept, whatever their names. An empty table stays empty.
    """
    for block in blocks(benchmark):
        sent = _sent(docs, block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            words, known = WordHashes(), pickle.loads(sent.value)
            for batch in batches:
                texts = text_bytes(batch["text"].cast(pa.string()))
                stays = [not known.leaks(words.of(tokens(t))) for t in texts]
                yield batch.filter(pa.array(stays, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
