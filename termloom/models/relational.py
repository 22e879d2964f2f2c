"""Multinomial logistic regression whose coefficients never leave the cluster.

Features are the long table ``(row_id, term, weight)``. Every slope, and so every vector of L-BFGS, is a
sum of documents: the transposed features times a number per document and class. These
shares are kept instead of the vectors, in a table with a row per document, beside the margins that the
vector gives the documents. Products of two vectors are sums over documents then, a direction
and its margins are sums of stored columns, and coefficients are made once, at the end.
The driver holds no vocabulary and no vector: L-BFGS needs the vectors of its memory only
through their dot products, and all but those with the new slope follow from the last iteration.
Margins are linear in the step, so all step sizes of a line search are tried in one
aggregate over two numbers per document and class.

An iteration reads the features once: the shares of the new slope become its values by term and, in the
same task, its margins. Up to ``BROADCAST_ROWS`` documents the shares are broadcast to blocks of
terms, and only partial sums by document are shuffled; beyond, joins by document and by term
do the same.
"""

from __future__ import annotations

import dataclasses
import sys
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions.labels import SENTIMENTS
from termloom.operators.scale import BROADCAST_ROWS, number_rows, rewritten

# The functions below run on workers, which need no copy of this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries of a block of terms.
ENTRIES = 1 << 18
#: Pairs of the memory, and step sizes that a line search tries.
MEMORY = 5
STEPS = [1.0, 0.5, 0.25, 0.125, 2.0**-5, 2.0**-8, 2.0**-12]


@dataclasses.dataclass
class Trained:
    """``weights``: ``term`` and a column per class; intercepts by class; the objective, its
    weighted mean loss and the iterations."""

    weights: DataFrame
    intercepts: dict[str, float]
    objective: float
    log_loss: float
    iterations: int


def _losses(margins: np.ndarray, y: np.ndarray, v: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted loss of rows (class ``y``, weight ``v``) and its slopes by margin."""
    high = margins.max(axis=1, keepdims=True)
    odds = np.exp(margins - high)
    total, every = odds.sum(axis=1), np.arange(len(y))
    loss = v * (np.log(total) + high[:, 0] - margins[every, y])
    slope = odds / total[:, None]
    slope[every, y] -= 1.0
    return float(loss.sum()), slope * v[:, None]


def _lists(numbers: np.ndarray) -> pa.Array:
    """A list of numbers for each row of an array."""
    width = numbers[0].size
    return pa.ListArray.from_arrays(np.arange(len(numbers) + 1, dtype=np.int32) * width, numbers.ravel())


def _rows(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple]:
    """Batches with their classes, weights and numbers (rows, 1 + 2 * vectors, classes).

    First come the margins of a row, then for each vector its share and the margins it gives.
    """
    for batch in batches:
        if batch.num_rows:
            held = batch["held"].flatten().to_numpy().reshape(batch.num_rows, -1, k)
            yield batch, batch["y"].to_numpy(), batch["v"].to_numpy(), held


def _sums(rows: DataFrame, k: int, of: Callable[..., list[float]]) -> np.ndarray:
    """``of`` (numbers, classes, weights, batch) for every batch: one short list each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, y, v, held in _rows(batches, k):
            yield pa.RecordBatch.from_arrays([_lists(np.array([of(held, y, v, batch)], float))], ["held"])

    return np.array(rows.mapInArrow(run, "held array<double>").toArrow()["held"].to_pylist())


def _direction(gram: np.ndarray, pairs: int) -> np.ndarray:
    """Factors of (s.., y.., slope) in the L-BFGS direction, from their dot products alone."""
    last = 2 * pairs
    factors = np.zeros(last + 1)
    factors[last] = -1.0
    shares = np.zeros(pairs)
    for i in reversed(range(pairs)):
        shares[i] = factors @ gram[:, i] / gram[i, pairs + i]
        factors[pairs + i] -= shares[i]
    if pairs:
        factors *= gram[pairs - 1, last - 1] / gram[last - 1, last - 1]
    for i in range(pairs):
        factors[i] += shares[i] - factors @ gram[:, pairs + i] / gram[i, pairs + i]
    return factors


def _blocks(entries: DataFrame) -> DataFrame:
    """Entries ``row, term, weight`` as blocks of about ``ENTRIES``, whole terms each.

    ``lengths`` has the entries of every term, ``rows`` and ``weights`` follow term by term, as bytes.
    """
    lists = entries.groupBy("term").agg(F.collect_list(F.struct("row", "weight")).alias("held"))
    names = ["lengths", "rows", "weights"]

    def pack(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        bytes_ = [pa.array([np.concatenate(p).tobytes()], pa.binary()) for p in zip(*parts, strict=True)]
        return pa.RecordBatch.from_arrays(bytes_, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            every = batch["held"].value_lengths().to_numpy().astype(np.int32)
            held = batch["held"].flatten()
            rows = held.field("row").to_numpy().astype(np.int32)
            weights = held.field("weight").to_numpy()
            ends = np.cumsum(every, dtype=np.int64)
            cuts = [0, *(np.flatnonzero(np.diff(ends // ENTRIES)) + 1).tolist(), len(every)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                start, stop = (ends[a - 1] if a else 0), ends[b - 1]
                parts.append((every[a:b], rows[start:stop], weights[start:stop]))
                size += stop - start
                if size >= ENTRIES:
                    yield pack(parts)
                    parts, size = [], 0
        if parts:
            yield pack(parts)

    return lists.select("held").mapInArrow(run, ", ".join(f"{n} binary" for n in names))


def _by_blocks(entries: DataFrame, n: int, k: int) -> Callable[[DataFrame], DataFrame]:
    """The pass for few documents: their shares are broadcast, every task adds up its margins."""
    blocks = rewritten(_blocks(entries), "blocks")
    context = entries.sparkSession.sparkContext
    schema = ", ".join(["row long", *[f"q{c} double" for c in range(k)], "top double"])
    before: list = []

    def margins(shares: DataFrame) -> DataFrame:
        held = shares.toArrow()
        given = np.empty((n, k))
        given[held["row"].to_numpy()] = np.column_stack([held[f"g{c}"].to_numpy() for c in range(k)])
        while before:
            before.pop().destroy()
        before.append(sent := context.broadcast(given))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shares, top = sent.value, 0.0
            found = np.zeros((k, n))
            for batch in batches:
                for lengths, rows, weights in zip(*(batch[i].to_pylist() for i in range(3)), strict=True):
                    lengths, rows = np.frombuffer(lengths, np.int32), np.frombuffer(rows, np.int32)
                    weights = np.frombuffer(weights)
                    starts = np.cumsum(lengths, dtype=np.int64) - lengths
                    slope = np.add.reduceat(shares[rows] * weights[:, None], starts, axis=0)
                    top = max(top, float(np.abs(slope).max()))
                    for c in range(k):
                        found[c] += np.bincount(rows, np.repeat(slope[:, c], lengths) * weights, n)
            at = np.flatnonzero(found.any(axis=0))
            columns = [pa.array(at, pa.int64()), *[pa.array(f[at]) for f in found], pa.array(np.full(len(at), top))]
            yield pa.RecordBatch.from_arrays(columns, ["row", *[f"q{c}" for c in range(k)], "top"])

        parts = blocks.mapInArrow(run, schema)
        return parts.groupBy("row").agg(*[F.sum(f"q{c}").alias(f"q{c}") for c in range(k)], F.max("top").alias("top"))

    return margins


def _by_joins(entries: DataFrame, k: int) -> Callable[[DataFrame], DataFrame]:
    """The pass for any number of documents: their terms are read in place, sums are shuffled."""
    packed = entries.groupBy("row").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))
    packed = rewritten(packed, "packed")

    def margins(shares: DataFrame) -> DataFrame:
        slope = _slope(packed.join(shares, "row").select(F.inline("terms"), *[f"g{c}" for c in range(k)]), k)
        slope = rewritten(slope, "slope")
        steepest = f"max(greatest({', '.join(f'abs(g{c})' for c in range(k))}))"
        top = slope.selectExpr(steepest).first()[0] or 0.0
        found = packed.select("row", F.inline("terms")).join(slope, "term").groupBy("row")
        return found.agg(*[F.expr(f"sum(weight * g{c}) AS q{c}") for c in range(k)], F.lit(top).alias("top"))

    return margins


def _slope(found: DataFrame, k: int) -> DataFrame:
    """Values by term of a vector with shares ``g``: ``term`` and a column per class."""
    return found.groupBy("term").agg(*[F.expr(f"sum(weight * g{c}) AS g{c}") for c in range(k)])


def train(
    features: DataFrame,
    labels: DataFrame,
    strength: float = 1.0,
    class_weights: dict[str, float] | None = None,
    classes: Sequence[str] = tuple(SENTIMENTS),
    max_iter: int = 200,
    tolerance: float = 1e-4,
    limit: int | None = None,
) -> Trained:
    """Minimise the mean weighted loss plus |w|**2 / (2 * strength * rows), intercepts free.

    ``features`` has ``row_id, term, weight``, ``labels`` a row ``row_id, label`` per document, those
    without terms included; rows with another label than ``classes`` are left out. Stops when
    no slope exceeds the tolerance. Up to ``limit`` documents (``BROADCAST_ROWS``) are broadcast.
    """
    k, given = len(classes), class_weights or {}
    limit = BROADCAST_ROWS if limit is None else limit
    listed = F.array(*[F.lit(c) for c in classes])
    weight = reduce(
        lambda rest, c: F.when(F.col("label") == c, F.lit(float(given[c]))).otherwise(rest), given, F.lit(1.0)
    )

    rows = labels.where(F.col("label").isin(list(classes))).select(
        "row_id", (F.array_position(listed, F.col("label")) - 1).cast("int").alias("y"), weight.alias("v")
    )
    numbered = rewritten(number_rows(rows, "row"), "rows")
    n = numbered.count()
    ridge = 1.0 / (strength * n)
    entries = features.join(numbered.select("row_id", "row"), "row_id").select("row", "term", "weight")
    entries = entries.where("term IS NOT NULL AND weight IS NOT NULL")
    margins = _by_blocks(entries, n, k) if n <= limit else _by_joins(entries, k)
    columns = {x: [f"{x}{c}" for c in range(k)] for x in "gq"}

    def stepped(rows: DataFrame, way: np.ndarray, free: np.ndarray, size: float, made: np.ndarray) -> DataFrame:
        """Rows after a step: ``made`` of the stored vectors, then the new slope ``h``.

        The last of several vectors is the change of the slope: ``h`` is added to it too.
        """

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, y, v, held in _rows(batches, k):
                out = np.empty((len(held), 1 + 2 * len(made), k))
                out[:, 0] = held[:, 0] + size * (np.einsum("n,rnk->rk", way, held[:, 2::2]) + free)
                for x in (1, 2):
                    out[:, x::2] = np.einsum("mn,rnk->rmk", made, held[:, x::2])
                share = _losses(out[:, 0], y, v)[1] / n + ridge * out[:, 1]
                named = dict(zip(columns["g"], map(pa.array, share.T), strict=True))
                same = {x: batch[x] for x in ("row", "y", "v")}
                yield pa.RecordBatch.from_pydict({**same, "held": _lists(out), **named})

        def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, _, _, held in _rows(batches, k):
                fresh = np.stack(
                    [np.column_stack([batch[c].fill_null(0.0).to_numpy() for c in columns[x]]) for x in "gq"], axis=1
                )
                out = np.concatenate([held, fresh], axis=1)
                if len(made) > 1:
                    out[:, -4:-2] += fresh
                same = {x: batch[x] for x in ("row", "y", "v")}
                yield pa.RecordBatch.from_pydict({**same, "held": _lists(out), "top": batch["top"].fill_null(0.0)})

        kept = "row long, y int, v double, held array<double>"
        moved = rows.mapInArrow(move, ", ".join([kept, *[f"{g} double" for g in columns["g"]]]))
        found = moved.join(margins(moved.select("row", *columns["g"])), "row", "left")
        return rewritten(found.mapInArrow(finish, f"{kept}, top double"), "rows")

    def measured(rows: DataFrame) -> tuple[float, np.ndarray, float, np.ndarray]:
        """Loss, its slopes by intercept, steepest slope, and the products of ``h`` with all vectors."""

        def of(held: np.ndarray, y: np.ndarray, v: np.ndarray, batch: pa.RecordBatch) -> list[float]:
            loss, parts = _losses(held[:, 0], y, v)
            products = np.einsum("rk,rnk->n", held[:, -2], held[:, 2::2])
            return [batch["top"].to_numpy().max(), loss, *parts.sum(axis=0), *products]

        found = _sums(rows, k, of)
        total = found.sum(axis=0)
        return total[1] / n, total[2 : k + 2] / n, float(found[:, 0].max()), total[k + 2 :]

    none = F.array_repeat(F.lit(0.0), 3 * k).alias("held")
    rows = stepped(numbered.select("row", "y", "v", none), np.zeros(1), np.zeros(k), 0.0, np.eye(1))
    # Stored vectors: pairs (s, y) of the memory, the weights w, and the newest slope h. ``gram``
    # holds their products, the intercepts apart: those are in ``own``, in the same order.
    names, intercepts = ["w"], np.zeros(k)
    loss, free, steepest, new = measured(rows)
    objective, own = loss, np.zeros((1, k))
    gram, iteration = np.zeros((1, 1)), 0
    while iteration < max_iter and max(steepest, np.abs(free).max()) > tolerance:
        iteration += 1
        names.append("h")
        gram = np.block([[gram, new[:-1, None]], [new[None, :-1], new[-1:, None]]])
        own = np.vstack([own, free])
        pairs = (len(names) - 2) // 2
        every = gram + own @ own.T
        # In the order of ``_direction``: s.., y.., slope. The weights are no part of it.
        order = [names.index(f"{x}{i}_") for x in "sy" for i in range(pairs)] + [len(names) - 1]
        factors = np.zeros(len(names))
        factors[order] = _direction(every[np.ix_(order, order)], pairs)
        down = float(factors @ every[:, -1])
        w = names.index("w")
        w_w, w_d, d_d = gram[w, w], float(gram[w] @ factors), float(factors @ gram @ factors)
        free_d = factors @ own

        first = 1.0 if pairs else min(1.0, 1.0 / max(float(np.sqrt(every[-1, -1])), 1e-12))
        sizes = [first * s for s in STEPS]

        def tries(held: np.ndarray, y: np.ndarray, v: np.ndarray, _: pa.RecordBatch) -> list[float]:
            along = np.einsum("n,rnk->rk", factors, held[:, 2::2]) + free_d
            return [_losses(held[:, 0] + s * along, y, v)[0] for s in sizes]

        tried = _sums(rows, k, tries).sum(axis=0)
        values = [
            x / n + ridge * (w_w + 2 * s * w_d + s * s * d_d) / 2 for x, s in zip(tried, sizes, strict=True)
        ]
        good = [i for i, (x, s) in enumerate(zip(values, sizes, strict=True)) if x <= objective + 1e-4 * s * down]
        if not good:
            break
        size, objective = sizes[good[0]], values[good[0]]
        intercepts = intercepts + size * free_d
        # The new vectors as sums of the stored ones and the slope to come.
        keep = range(max(0, pairs + 1 - MEMORY), pairs)
        stays = [(f"{x}{j}_", names.index(f"{x}{i}_")) for j, i in enumerate(keep) for x in "sy"]
        unit, moved_by = np.eye(len(names)), size * factors
        made = [unit[w] + moved_by, *[unit[i] for _, i in stays], moved_by, -unit[-1]]
        new_names = ["w", *[name for name, _ in stays], f"s{len(keep)}_", f"y{len(keep)}_"]
        change = np.array(made)
        # One pass over the features; the last vector is y = h - g.
        rows = stepped(rows, factors, free_d, size, change)
        loss, new_free, steepest, new = measured(rows)
        # Products of the new vectors: all but those with the new slope follow from the old ones.
        gram, own = change @ gram @ change.T, change @ own
        own[-1] += new_free
        # The last vector is y = h - g: what is known of it so far is the part of -g.
        g_h = new[-1] - new[-2]
        gram[-1, -1] += new[-1] - 2 * g_h
        gram[-1, :-1] += new[:-2]
        gram[:-1, -1] += new[:-2]
        names, free = new_names, new_free
    # The weights are the first vector.
    shares = rows.select("row", *[F.element_at("held", k + c + 1).alias(f"g{c}") for c in range(k)])
    found = _slope(entries.join(shares, "row"), k)
    weights = found.select("term", *[F.col(f"g{c}").alias(name) for c, name in enumerate(classes)])
    named = dict(zip(classes, map(float, intercepts), strict=True))
    return Trained(rewritten(weights, "coefficients"), named, objective, loss, iteration)
