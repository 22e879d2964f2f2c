"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.operators import scale

# What separates words, as a regular expression and as SQL text.
SPACE = r"[\x20\x09-\x0D]+"

#: An odd multiplier, its inverse modulo 2**64, and the constants of a 64-bit mixer.
ODD = 0x9E3779B97F4A7C15
ODD_INVERSE = pow(ODD, -1, 2**64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives executors."""
    path = scale.written(df, name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    """Words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def text_bytes(column: pa.Array) -> list[bytes]:
    """Texts of an Arrow column as UTF-8; null is empty."""
    return column.fill_null("").cast(pa.binary()).to_pylist()


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``size`` bytes of text (at least one row): what is held at once."""
    sizes = pc.binary_length(batch["text"]).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // size)) + 1
    for a, b in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)


class WordHashes(dict):
    """64-bit hash of a word; words seen are remembered up to a bound."""

    MOST = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.MOST:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def of_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all texts one after the other, and the words of each text."""
        lists = [t.split() for t in texts]
        sizes = np.array([len(words) for words in lists], np.int64)
        every = map(self.__getitem__, itertools.chain.from_iterable(lists))
        return np.fromiter(every, np.uint64, int(sizes.sum())), sizes


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit mixer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(values: np.ndarray, size: int, factor: int = ODD) -> np.ndarray:
    """Hash of every run of ``size`` consecutive hashes."""
    n = len(values) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = values[:n].copy()
    for j in range(1, size):
        total = total * np.uint64(factor) + values[j : j + n]
    return mixed(total)


class Ranges:
    """Hashes of arbitrary ranges of one sequence, from prefix sums modulo 2**64."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        power = np.full(n + 1, ODD, np.uint64)
        power[0] = 1
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * np.cumprod(power)[:n], out=self.sums[1:])
        back = np.full(n + 1, ODD_INVERSE, np.uint64)
        back[0] = 1
        self.back = np.cumprod(back)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.back[start])


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x).view(np.int64)


def mark(text: Column) -> Column:
    """64 bits of a text: tells rows with the same id and another text apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))
