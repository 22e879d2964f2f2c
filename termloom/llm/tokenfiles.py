"""Token ids in binary files with Elias-Fano document boundaries.

All documents in ascending id order make one array of token ids, each document closed by an
end id. The array is cut into segments of about ``SEGMENT`` ids, whole documents each; a segment
is one row of a parquet table, so Spark's writer commits it as a whole or not at all, and any
store that Spark reaches can hold it:

``part, seq``     order of the segments: task of the range sort, place in it
``docs, tokens``  how many documents and ids it holds
``ids``           the ids, little-endian, 2 bytes each if the vocabulary fits, else 4
``width, lower, upper, samples``  Elias-Fano code of the documents' end offsets
``doc_ids``       ids of the documents

An end offset is split into ``width`` low bits, packed in ``lower``, and a high part, written in
``upper`` as one set bit at high + rank. That takes about width + 2 bits a document. The
place of every ``SAMPLE``-th set bit is kept in ``samples``; ``select`` starts there. Offsets count
from the start of the segment, so nothing in a segment needs 64 bits; what stands
before a segment is the sum of the ``tokens`` of earlier ones.

Texts are shuffled once, by range of (id, text hash, row), so that a third of all rows
without an id spreads over many tasks.
"""

from __future__ import annotations

import itertools
import json
import os
import pathlib
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termloom.llm.common import kept, mark, slices

SEGMENT = 1 << 19
SAMPLE = 512
END = 0
#: Bytes of text that are encoded at once, pieces whose ids are remembered, characters of the
#: longest of them, and pieces that are encoded in one call.
BYTES = 1 << 21
MOST = 700_000
LONGEST = 64
PIECES = 500


# --- Elias-Fano code of an ascending list of offsets


def packed(ends: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """``width, lower, upper, samples`` of ascending offsets (at least one)."""
    ends = np.asarray(ends, np.uint64)
    width = max(0, (int(ends[-1]) // len(ends)).bit_length() - 1)
    bits = ends[:, None] >> np.arange(width, dtype=np.uint64) & np.uint64(1)
    lower = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    places = (ends >> np.uint64(width)).astype(np.int64) + np.arange(len(ends))
    unary = np.zeros(int(places[-1]) + 1, np.uint8)
    unary[places] = 1
    upper = np.packbits(unary, bitorder="little").tobytes()
    return width, lower, upper, places[::SAMPLE].astype("<u4").tobytes()


class Offsets:
    """Reads single end offsets out of their Elias-Fano code."""

    def __init__(self, count: int, width: int, lower: bytes, upper: bytes, samples: bytes):
        self.count, self.width = count, width
        self.lower = np.frombuffer(lower + bytes(8), np.uint8)
        self.upper = np.frombuffer(upper, np.uint8)
        self.samples = np.frombuffer(samples, "<u4").astype(np.int64)

    def _high(self, block: int) -> np.ndarray:
        """High parts of the offsets of one sample block, from its bits alone."""
        start = int(self.samples[block])
        last = block + 1 == len(self.samples)
        end = 8 * len(self.upper) if last else int(self.samples[block + 1])
        byte = start // 8
        bits = np.unpackbits(self.upper[byte : -(-end // 8)], bitorder="little")
        places = np.flatnonzero(bits[start - 8 * byte : end - 8 * byte]) + start
        return places - block * SAMPLE - np.arange(len(places))

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """End offsets of the documents with these ranks (0 to count - 1)."""
        ranks = np.asarray(ranks, np.int64)
        high = np.zeros(len(ranks), np.int64)
        blocks = ranks // SAMPLE
        for block in np.unique(blocks).tolist():
            here = blocks == block
            high[here] = self._high(block)[ranks[here] % SAMPLE]
        at = ranks * self.width
        eight = self.lower[(at >> 3)[:, None] + np.arange(8)]
        word = np.ascontiguousarray(eight).view("<u8")[:, 0]
        low = word >> (at & 7).astype(np.uint64) & np.uint64((1 << self.width) - 1)
        return (high << self.width) + low.astype(np.int64)

    def spans(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-but-one offset of the documents with these ranks."""
        ranks = np.asarray(ranks, np.int64)
        before = np.where(ranks > 0, self.select(np.maximum(ranks - 1, 0)), 0)
        return before, self.select(ranks)


# --- Encoding


def separable(settings: dict) -> bool:
    """Whether no token of this tokenizer spans a blank that follows a character which is no space.

    So it is for byte-level pre-tokenization by the usual pattern with nothing before
    or after it.
    """
    first = settings.get("pre_tokenizer") or {}
    plain = settings.get("normalizer") is None and settings.get("post_processor") is None
    tokens = settings.get("added_tokens") or ()
    whole = all(not (t["lstrip"] or t["rstrip"] or " " in t["content"]) for t in tokens)
    usual = first.get("type") == "ByteLevel" and first.get("use_regex") and not first.get("add_prefix_space")
    return bool(plain and whole and usual)


_CUT = re.compile(r"(?<=\S)(?= )")
_BLANKS = re.compile(r"\s ")


def pieces(text: str) -> tuple[str, list[str]]:
    """The text cut before every blank that follows a character which is no space: what stands
    before the first cut or blank, and what follows the blank of each later piece."""
    if not _BLANKS.search(text):
        head, *rest = text.split(" ")
        return head, rest
    head, *rest = _CUT.split(text)
    if head.startswith(" "):
        return "", [head[1:], *(r[1:] for r in rest)]
    return head, [r[1:] for r in rest]


#: What the usual pattern takes as a whole wherever it stands: a run of letters, of digits or of other
#: signs with a blank before it, and a line end between two of them. Letters are those that no version of
#: Unicode has as anything else, signs those of ASCII but for the apostrophe, which may go with letters.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481"
_RUNS = re.compile(rf" ?(?:[{_LETTERS}]+|[0-9]+|[!-&(-/:-@\[-`{{-~]+)|(?<=\S)\n(?=\S)")


def plain_runs(pieces: Sequence[str]) -> list[str] | None:
    """The runs of pieces, the first of each with the blank before it; None if any has something else."""
    text = "".join([" " + w for w in pieces])
    runs = _RUNS.findall(text)
    return runs if sum(map(len, runs)) == len(text) else None


#: Byte-level tokenizers write a byte as a character: one that can be seen as itself, others in
#: order from 256.
_SEEN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _SEEN]
_ALPHABET = "".join(chr(b if b in _SEEN else 256 + _HIDDEN.index(b)) for b in range(256))


def spelled(runs: list[str]) -> list[str]:
    """Runs, of which none has the byte 1, in these characters."""
    return "\1".join(runs).encode().decode("latin-1").translate(_ALPHABET).split(_ALPHABET[1])


class Encoder:
    """Texts to the bytes of their ids. Remembers the ids of up to ``MOST`` pieces of each kind."""

    def __init__(self, settings: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(settings)
        # The strings of special tokens are ordinary text where they stand in a document.
        self.tokenizer.encode_special_tokens = True
        self.separable = separable(json.loads(settings))
        self.kind = id_type(self.tokenizer.get_vocab_size())
        # The same model for runs, which the usual pattern need not find again. Special tokens are
        # ordinary text; any other added token may span runs.
        self.runs = Tokenizer(self.tokenizer.model)
        numbers, special = self.tokenizer.get_vocab(), [t["special"] for t in json.loads(settings)["added_tokens"]]
        self.plain = self.separable and all(special) and numbers.keys() >= {*_ALPHABET}
        self.blank = np.zeros(max(numbers.values()) + 1, bool)
        self.blank[[i for t, i in numbers.items() if t.startswith(_ALPHABET[32])]] = True
        self.heads: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}

    def _encoded(self, texts: Iterable[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _begin(self, new: list[str]) -> None:
        """Remember the ids of pieces that follow nothing."""
        self.heads.update(zip(new, self._encoded(new), strict=True))

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of pieces that follow a blank: of mere runs, those of each run in turn."""
        for part in itertools.batched(new, PIECES):
            runs = plain_runs(part) if self.plain else None
            if runs is None:
                odd = [w for w in part if not self.plain or plain_runs([w]) is None]
                self.rest.update(zip(odd, self._encoded(" " + w for w in odd), strict=True))
                part = [w for w in part if w not in self.rest]
                runs = plain_runs(part) or []
            self._learn_runs({r for r in runs if r[0] == " "})
            self._begin(list({r for r in runs if r[0] != " "}.difference(self.heads)))
            found: list[bytes] = []
            for r in runs:
                if r[0] == " ":
                    found.append(self.rest[r[1:]])
                else:
                    found[-1] += self.heads[r]
            self.rest.update(zip(part, found, strict=True))

    def _learn_runs(self, runs: set[str]) -> None:
        """Remember the ids of runs that follow a blank, all in one call; the tokens that begin with a
        blank part them."""
        new = [r for r in runs if r[1:] not in self.rest]
        if new:
            found = self.runs.encode_batch_fast([spelled(new)], is_pretokenized=True, add_special_tokens=False)
            ids, size = np.array(found[0].ids, self.kind), np.dtype(self.kind).itemsize
            cut, raw = [*(np.flatnonzero(self.blank[ids]) * size).tolist(), len(ids) * size], ids.tobytes()
            parts = [raw[a:b] for a, b in itertools.pairwise(cut)]
            self.rest.update(zip([r[1:] for r in new], parts, strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as bytes, in the order of the texts."""
        if not (self.separable and texts):
            return self._encoded(texts)
        self.heads, self.rest = _trimmed(self.heads), _trimmed(self.rest)
        if any(map(_BLANKS.search, texts)):
            cut = pa.array([[head, *rest] for head, rest in map(pieces, texts)], pa.list_(pa.string()))
        else:
            cut = pc.split_pattern(pa.array(texts, pa.string()), " ")
        starts, ends, every = cut.offsets.to_numpy()[:-1], cut.offsets.to_numpy()[1:], cut.flatten()
        first = np.zeros(len(every), bool)
        first[starts] = True
        heads = every.filter(pa.array(first)).to_numpy(zero_copy_only=False).tolist()
        # What follows blanks is looked up once in a part.
        coded = every.filter(pa.array(~first)).dictionary_encode()
        rest = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = self._known(self.rest, rest, self._learn)
        ids += self._known(self.heads, heads, self._begin)
        number = np.empty(len(every), np.int32)
        number[~first], number[first] = coded.indices.to_numpy(), len(rest) + np.arange(len(heads))
        return _joined(ids, number, ends, self.kind)

    def _known(self, held: dict[str, bytes], words: list[str], learn: Callable[[list[str]], None]) -> list[bytes]:
        """Ids of pieces; those that are not held are learned."""
        ids = list(map(held.get, words))
        places = [i for i, x in enumerate(ids) if x is None]
        new = list(dict.fromkeys([words[i] for i in places]))
        learn(new)
        for i in places:
            ids[i] = held[words[i]]
        # A text without a blank is one piece; long ones would fill the memory.
        for w in new:
            if len(w) > LONGEST:
                del held[w]
        return ids


def _joined(ids: list[bytes], number: np.ndarray, ends: np.ndarray, kind: str) -> list[bytes]:
    """``ids`` of these numbers one after the other, cut after so many numbers.

    A part has fewer ids than bytes, and Arrow's strings less than 2**31 of those.
    """
    held, size = np.frombuffer(b"".join(ids), kind), np.dtype(kind).itemsize
    lengths = np.fromiter(map(len, ids), np.int32, len(ids)) // np.int32(size)
    starts, lengths = (np.cumsum(lengths, dtype=np.int32) - lengths)[number], lengths[number]
    upto = np.cumsum(lengths, dtype=np.int32)
    places = np.repeat(starts - upto + lengths, lengths)
    places += np.arange(len(places), dtype=np.int32)
    raw, stops = held[places].tobytes(), (upto[ends - 1].astype(np.int64) * size).tolist()
    return [raw[a:b] for a, b in zip([0, *stops], stops, strict=False)]


def _trimmed(held: dict[str, bytes]) -> dict[str, bytes]:
    """The older half of more than ``MOST`` pieces: frequent ones are met first."""
    return held if len(held) <= MOST else dict(itertools.islice(held.items(), MOST // 2))


def encoder(settings: str) -> Encoder:
    """The encoder of this Python worker: kept with the imported library, so that later tasks of
    the worker find what it remembers."""
    import tokenizers

    held = tokenizers.__dict__.setdefault("_encoders_of_this_worker", {})
    if settings not in held:
        held.clear()
        held[settings] = Encoder(settings)
    return held[settings]


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


SEGMENTS = """part int, seq int, docs int, tokens long, width int, ids binary, lower binary,
upper binary, samples binary, doc_ids array<long>"""


class Segment:
    """Documents that go to one row of the table."""

    def __init__(self):
        self.doc_ids, self.ids, self.ends, self.tokens = [], [], [], 0

    def add(self, doc_id: int | None, ids: bytes, size: int) -> None:
        self.doc_ids.append(doc_id)
        self.ids.append(ids)
        self.tokens += len(ids) // size
        self.ends.append(self.tokens)

    def batch(self, part: int, seq: int) -> pa.RecordBatch:
        width, lower, upper, samples = packed(np.array(self.ends))
        columns = [
            pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(self.ends)], pa.int32()),
            pa.array([self.tokens], pa.int64()), pa.array([width], pa.int32()),
            *[pa.array([x], pa.binary()) for x in (b"".join(self.ids), lower, upper, samples)],
            pa.array([self.doc_ids], pa.list_(pa.int64())),
        ]
        names = ["part", "seq", "docs", "tokens", "width", "ids", "lower", "upper", "samples", "doc_ids"]
        return pa.RecordBatch.from_arrays(columns, names)


def segments(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The table of segments (not written yet); ``tokenizer`` is the path of a tokenizers file.

    Documents come in ascending order of ``doc_id``, those without an id last; equal ids
    are ordered by the hash of their texts. Null and empty texts are the end id alone. An
    empty table has no segments; further columns are not read.
    """
    settings = pathlib.Path(tokenizer).read_text()
    sent = docs.sparkSession.sparkContext.broadcast(settings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, segment, seq, part = None, Segment(), 0, 0
        for batch in batches:
            encode = encode or encoder(sent.value)
            size = np.dtype(encode.kind).itemsize
            end = np.array([END], encode.kind).tobytes()
            part = batch["part"][0].as_py() if batch.num_rows else part
            for rows in slices(batch, BYTES):
                texts = rows["text"].fill_null("").to_pylist()
                for number, ids in zip(rows["doc_id"].to_pylist(), encode(texts), strict=True):
                    segment.add(number, ids + end, size)
                    if segment.tokens >= SEGMENT:
                        yield segment.batch(part, seq)
                        segment, seq = Segment(), seq + 1
        if segment.ends:
            yield segment.batch(part, seq)

    text = F.col("text").cast("string")
    number = F.col("doc_id").cast("long")
    order = ["_none", "doc_id", "_mark", "_row"]
    slim = docs.select(
        number.alias("doc_id"), text.alias("text"), number.isNull().alias("_none"), mark(text).alias("_mark"),
        F.monotonically_increasing_id().alias("_row"),
    )
    placed = slim.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(run, SEGMENTS)


def written(docs: DataFrame, tokenizer: str, path: str | None = None) -> DataFrame:
    """Write the segments and read them back, from ``path`` or the shared folder."""
    table = segments(docs, tokenizer)
    if path is None:
        return kept(table, "tokens")
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


# --- Reading


def starts(files: DataFrame) -> DataFrame:
    """``part, seq, base``: the ids before each segment.

    Two running sums: over the segments of a task, and over the tasks (one row for each).
    """
    sizes = files.select("part", "seq", "tokens")
    whole = sizes.groupBy("part").agg(F.sum("tokens").alias("sum"))
    earlier = F.sum("sum").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    whole = whole.select("part", F.coalesce(earlier, F.lit(0)).alias("before"))
    inside = F.sum("tokens").over(W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1))
    placed = sizes.select("part", "seq", F.coalesce(inside, F.lit(0)).alias("inside")).join(whole, "part")
    return placed.select("part", "seq", (F.col("before") + F.col("inside")).alias("base"))


DOCUMENTS = "part int, seq int, rank int, doc_id long, begin long, ids binary"


def documents(files: DataFrame) -> DataFrame:
    """``part, seq, rank, doc_id, begin, ids``: every document by ``select`` on its segment.

    ``begin`` counts from the start of the segment, ``ids`` are little-endian 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                held = {c: batch[c][row].as_py() for c in ("part", "seq", "docs", "tokens", "width")}
                code = [batch[c][row].as_py() for c in ("lower", "upper", "samples")]
                count = held["docs"]
                raw = batch["ids"][row].as_py()
                ids = np.frombuffer(raw, f"<u{len(raw) // held['tokens']}")
                ranks = np.arange(count)
                begin, end = Offsets(count, held["width"], *code).spans(ranks)
                wide = ids.astype("<u4").tobytes()
                cut = [wide[4 * a : 4 * b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                columns = [
                    *[pa.array(np.full(count, held[c], np.int32)) for c in ("part", "seq")],
                    pa.array(ranks.astype(np.int32)), batch["doc_ids"][row].values,
                    pa.array(begin), pa.array(cut, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["part", "seq", "rank", "doc_id", "begin", "ids"])

    slim = files.select("part", "seq", "docs", "tokens", "width", "lower", "upper", "samples", "ids", "doc_ids")
    return slim.mapInArrow(run, DOCUMENTS)


def located(files: DataFrame, *digests: Column) -> DataFrame:
    """``doc_id, start, n_tokens`` and ``digests`` (columns over ``ids``) of every document.

    Digests are taken before the offsets of the segments are joined, so that ids are
    never shuffled.
    """
    size = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    found = documents(files).select("part", "seq", "doc_id", "begin", size, *digests)
    rest = [c for c in found.columns if c not in ("part", "seq", "doc_id", "begin")]
    joined = found.join(starts(files), ["part", "seq"])
    return joined.select("doc_id", (F.col("base") + F.col("begin")).alias("start"), *rest)
