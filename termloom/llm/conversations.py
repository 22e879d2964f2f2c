"""Repair of conversation structure as a shortest path with big-integer weights.

A conversation is repaired by edits of its rows in order: keep, give another role, delete, or
insert an empty turn. The roles that are left must read: nothing, or an optional system
turn and one or more pairs of user and assistant. States of the path are what was said last
(nothing, system, user, assistant); its steps are the edits.

A weight is one integer. Its high digits are the cost; below them stand, in a fixed width of
three bits a place, the letters of the edits from the left, with zeros after the last one. The
smaller integer is the cheaper repair and, among equals, the one whose letters come
first (a shorter one before its continuations), so the path is found by ``min`` alone.
Weights are made from the end of the conversation: a step puts its cost on the high digits,
moves the letters one place down and puts its own letter in the first place.

Rows are sorted by range of (conversation, turn, role, text hash), which splits a conversation of any
size over tasks. A task repairs the conversations that it holds whole and short. Of others it
emits chunks of at most ``CHUNK`` rows. A chunk has, for each pair of states before and after it,
one weight; chunks are put together from the last to the first, again by ``min``,
and each is then repaired on its own by its part of the letters. Joining the best weights of
chunks is exact: of two equally dear edits of the same rows with the same states, neither
list of letters can begin with the other, since what would be left are insertions, which cost.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import kept

CHUNK = 1_000
#: Characters of text after which a chunk is closed, too.
CHARACTERS = 1 << 22

#: Letters of the edits as digits of a weight, in the order of ASCII; 0 is the padding.
LETTERS = "DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
COST = {DELETE: 3, INSERT: 2, KEEP: 0, REROLE: 2}
BITS = 3
#: States: nothing yet, system, user, assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
COMPLETE = (NOTHING, ASSISTANT)
#: The state after a turn that is inserted or gets another role.
NEXT = [USER, USER, ASSISTANT, USER]
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
SPACES = " \t\n\v\f\r"

#: Faults of a row.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)


def fault(text: str, seen: bool) -> int:
    """First fault of a row; ``seen``: whether an earlier row has its role and text."""
    said = text.strip(SPACES)
    if not said:
        return BLANK
    return DUPLICATE if seen else FINE if said[-1] in ".!?" else TRUNCATED


def kept_state(state: int, role: str) -> int | None:
    """State after a row that keeps its role; None where it may not stand."""
    initial = role[:1]
    if initial == "s":
        return SYSTEM if state == NOTHING else None
    if initial == "u":
        return None if state == USER else USER
    return ASSISTANT if initial == "a" and state == USER else None


class Weights:
    """Weights with room for ``places`` letters."""

    def __init__(self, places: int):
        self.low = BITS * places
        self.mask = (1 << self.low) - 1
        #: More than any weight of a path.
        self.never = 1 << (self.low + 64)

    def step(self, letter: int, cost: int, rest: int) -> int:
        """A step before the path ``rest``."""
        moved = (rest & ~self.mask) | ((rest & self.mask) >> BITS)
        return moved + (cost << self.low) + (letter << (self.low - BITS))

    def joined(self, cost: int, letters: str, rest: int) -> int:
        """Several steps, given by their cost and letters, before ``rest``."""
        digits = 0
        for letter in letters:
            digits = digits << BITS | LETTERS.index(letter) + 1
        used = BITS * len(letters)
        moved = (rest & ~self.mask) | ((rest & self.mask) >> used)
        return moved + (cost << self.low) + (digits << (self.low - used))

    def read(self, weight: int) -> tuple[int, str]:
        """Cost and letters of a weight."""
        letters, rest, at = [], weight & self.mask, self.low
        while at and (digit := rest >> (at - BITS) & 7):
            letters.append(LETTERS[digit - 1])
            at -= BITS
        return weight >> self.low, "".join(letters)

    def before(self, after: list[int]) -> list[int]:
        """Best weights by state before a place where turns may be inserted.

        Two insertions are as many as can pay: a third comes back to a state left before.
        """
        found = after
        for _ in range(2):
            found = [
                min(after[s], self.step(INSERT, COST[INSERT], found[NEXT[s]])) for s in STATES
            ]
        return found

    def row(self, role: str, flaw: int, after: list[int]) -> list[int]:
        """Best weights by state before a row."""
        found = [self.step(DELETE, COST[DELETE], after[s]) for s in STATES]
        if flaw in (BLANK, DUPLICATE):
            return found
        extra = int(flaw == TRUNCATED)
        for s in STATES:
            found[s] = min(found[s], self.step(REROLE, COST[REROLE] + extra, after[NEXT[s]]))
            stays = kept_state(s, role)
            if stays is not None:
                found[s] = min(found[s], self.step(KEEP, COST[KEEP] + extra, after[stays]))
        return found


def places(rows: int) -> int:
    """Letters that a repair of so many rows can have."""
    return 3 * rows + 2


def last(weights: Weights) -> list[int]:
    """Best weights by state at the end of a conversation."""
    return weights.before([0 if s in COMPLETE else weights.never for s in STATES])


def best_repair(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and letters for the (role, fault) rows of a whole conversation."""
    weights = Weights(places(len(rows)))
    found = last(weights)
    for role, flaw in reversed(rows):
        found = weights.before(weights.row(role, flaw, found))
    return weights.read(found[NOTHING])


def chunk_weights(rows: list[tuple[str, int]]) -> list[tuple[int, str] | None]:
    """Cost and letters of the best edits of a chunk for each (state before, state after)."""
    weights = Weights(places(len(rows)))
    table = []
    for end in STATES:
        found = [0 if s == end else weights.never for s in STATES]
        for role, flaw in reversed(rows):
            found = weights.before(weights.row(role, flaw, found))
        table.append([weights.read(x) if x < weights.never else None for x in found])
    return [table[end][start] for start in STATES for end in STATES]


def put_together(chunks: list[tuple[int, list]]) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost and letters of a conversation of chunks (rows, weights), and for each chunk the state
    before it and its letters; the last one's include those of the end."""
    weights = Weights(places(sum(rows for rows, _ in chunks)))
    found, ways = last(weights), []
    for _, table in reversed(chunks):
        options = [
            [
                (weights.joined(*entry, found[end]), end)
                for end in STATES
                if (entry := table[4 * start + end]) is not None and found[end] < weights.never
            ]
            for start in STATES
        ]
        best = [min(o, default=(weights.never, NOTHING)) for o in options]
        ways.append([end for _, end in best])
        found = [x for x, _ in best]
    cost, letters = weights.read(found[NOTHING])
    state, parts, used = NOTHING, [], 0
    for (_, table), way in zip(chunks, reversed(ways), strict=True):
        own = table[4 * state + way[state]][1]
        parts.append((state, own))
        used += len(own)
        state = way[state]
    start, own = parts[-1]
    parts[-1] = (start, own + letters[used:])
    return cost, letters, parts


def edited(rows: list[tuple[str, str]], letters: str, state: int = NOTHING) -> list[str]:
    """``role:text`` of what the edits leave of (role, text) rows."""
    out, at = [], iter(rows)
    for letter in letters:
        role, text = ("", "") if letter == "I" else next(at)
        if letter == "D":
            continue
        if letter == "K":
            state = kept_state(state, role)
        else:
            state = NEXT[state]
            role = ROLES[state]
        out.append(f"{role}:{text}")
    return out


# --- Spark


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with the faults that the checksum of a row's key plants.

    Nulls of role, text and in the key are one space; ids and turns stay null.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    kind = F.crc32(key) % 20
    text = F.coalesce(F.col("text").cast("string"), space)
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role").cast("string"), space))
    times = F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1)))
    times = times.otherwise(F.array(F.lit(0)))
    return conversations.select(
        F.col("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
        F.explode(times).alias("_copy"),
    ).drop("_copy")


def _schema(conversations: DataFrame) -> str:
    return f"conv_id {conversations.schema['conv_id'].dataType.simpleString()}"


RESULT = """gaps long, blank long, duplicate long, truncated long, illegal long, cost long,
audit string, repaired string"""
RESULT_NAMES = [c.split()[0] for c in RESULT.replace("\n", " ").split(",")]
ROWS = "array<struct<turn:long,role:string,text:string>>"
COUNTED = """part int, seq int, size long, blank long, duplicate long, truncated long, illegal long,
initials string, low long, high long, first_turn long, turns long,
weights array<struct<cost:long,letters:string>>"""


def _counts(rows: list[tuple[int | None, str, str]], repeated: set[int] | None) -> tuple[list[int], list[int]]:
    """Fault of every (turn, role, text) row, and the number of blank, duplicate, truncated and
    illegal ones. ``repeated``: places of duplicates; None: rows are all there are."""
    seen, flaws = set(), []
    for i, (_, role, text) in enumerate(rows):
        known = (role, text) in seen if repeated is None else i in repeated
        flaws.append(fault(text, known))
        if repeated is None:
            seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
    return flaws, [flaws.count(k) for k in (BLANK, DUPLICATE, TRUNCATED)] + [illegal]


def _whole(rows: list[tuple[int | None, str, str]]) -> tuple:
    """The result for a conversation whose rows are all here."""
    flaws, counts = _counts(rows, None)
    cost, audit = best_repair([(r[1], f) for r, f in zip(rows, flaws, strict=True)])
    turns = {r[0] for r in rows} - {None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, *counts, cost, audit, "\n".join(edited([r[1:] for r in rows], audit))


def _sorted(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation that a task holds whole, and chunks of the others.

    ``conv_id, part, seq, rows`` and the result; ``rows`` is null for what is done.
    """
    result_types = [*[pa.int64()] * 6, pa.string(), pa.string()]
    row_type = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, kind, part, seq = [], None, 0, 0
        held, size, now, several, edge = [], 0, None, False, True

        def close(at_edge: bool) -> None:
            nonlocal held, size, seq
            if not held:
                return
            if several or at_edge:
                made = [dict(zip(("turn", "role", "text"), r, strict=True)) for r in held]
                out.append((now, part, seq, made, *[None] * len(RESULT_NAMES)))
                seq += 1
            else:
                out.append((now, part, seq, None, *_whole(held)))
            held, size = [], 0

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            types = [kind, pa.int32(), pa.int32(), pa.list_(row_type), *result_types]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(arrays, ["conv_id", "part", "seq", "rows", *RESULT_NAMES])

        started = False
        for batch in batches:
            kind = batch["conv_id"].type
            columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text")]
            part = batch["part"][0].as_py() if batch.num_rows else part
            for conv, turn, role, text in zip(*columns, strict=True):
                if not started:
                    now, started = conv, True
                elif conv != now:
                    close(edge)  # the first one may have begun in the task before
                    now, several, edge = conv, False, False
                elif len(held) >= CHUNK or size >= CHARACTERS:
                    several = True
                    close(edge)
                held.append((turn, role, text))
                size += len(text)
            if len(out) >= 1000:
                yield flushed()
        close(True)  # the last one may go on in the next task
        if out:
            yield flushed()

    hashed = rows.select(
        "*", F.col("conv_id").isNotNull().alias("_c"), F.col("turn").isNotNull().alias("_t"),
        F.xxhash64("text").alias("_h"), F.monotonically_increasing_id().alias("_row"),
    )
    order = ["_c", "conv_id", "_t", "turn", "role", "_h", "_row"]
    placed = hashed.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("conv_id", "turn", "role", "text", F.spark_partition_id().alias("part"))
    schema = f"{_schema(conversations)}, part int, seq int, rows {ROWS}, {RESULT}"
    return placed.mapInArrow(run, schema)


def _counted(chunks: DataFrame) -> DataFrame:
    """``conv_id`` and COUNTED: what the rest needs of each chunk, without its texts."""
    # Duplicates of earlier rows of the conversation, wherever those are.
    rows = chunks.select("conv_id", "part", "seq", F.posexplode("rows").alias("at", "r"))
    digest = F.sha2(F.concat(F.length("r.role").cast("string"), F.lit(":"), F.col("r.role"), F.col("r.text")), 256)
    rows = rows.select("conv_id", digest.alias("said"), F.struct("part", "seq", "at").alias("place"))
    said = rows.groupBy("conv_id", "said").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    said = kept(said.where("n > 1").drop("n").withColumnRenamed("conv_id", "_conv"), "said")
    same = rows["conv_id"].eqNullSafe(said["_conv"]) & (rows["said"] == said["said"])
    again = rows.join(said, same).where("place > first")
    again = again.groupBy("place.part", "place.seq").agg(F.collect_list("place.at").alias("again"))
    type_ = chunks.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = pa.struct([("cost", pa.int64()), ("letters", pa.string())])
        types = [pa.int64()] * 5 + [pa.string()] + [pa.int64()] * 4 + [pa.list_(weight)]
        names = [c.split()[0] for c in COUNTED.replace("\n", " ").split(", ")][2:]
        for batch in batches:
            out = []
            for made, repeated in zip(batch["rows"].to_pylist(), batch["again"].to_pylist(), strict=True):
                rows = [(r["turn"], r["role"], r["text"]) for r in made]
                flaws, counts = _counts(rows, set(repeated or ()))
                turns = sorted({r[0] for r in rows} - {None})
                table = chunk_weights([(r[1], f) for r, f in zip(rows, flaws, strict=True)])
                entries = [e and dict(zip(("cost", "letters"), e, strict=True)) for e in table]
                initials = (rows[0][1][:1] or "-") + (rows[-1][1][:1] or "-")
                ends = (turns[0], turns[-1], turns[0]) if turns else (None, None, None)
                out.append((len(rows), *counts, initials, *ends, len(turns), entries))
            columns = list(zip(*out, strict=True)) or [[]] * len(types)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], batch["part"], batch["seq"], *arrays], ["conv_id", "part", "seq", *names]
            )

    return chunks.join(again, ["part", "seq"], "left").select("conv_id", "part", "seq", "rows", "again").mapInArrow(
        run, f"conv_id {type_}, {COUNTED}"
    )


def _combined(counted: DataFrame) -> DataFrame:
    """``conv_id``, the result without texts, and ``parts`` (part, seq, state, letters)."""
    type_ = counted.schema["conv_id"].dataType.simpleString()
    part_type = pa.struct([("part", pa.int32()), ("seq", pa.int32()), ("state", pa.int32()), ("letters", pa.string())])

    def one(chunks: list[dict]) -> tuple:
        chunks = sorted(chunks, key=lambda c: (c["part"], c["seq"]))
        tables = [(c["size"], [e and (e["cost"], e["letters"]) for e in c["weights"]]) for c in chunks]
        cost, audit, parts = put_together(tables)
        counts = [sum(c[k] for c in chunks) for k in ("blank", "duplicate", "truncated", "illegal")]
        counts[3] += sum(
            a["initials"][1] + b["initials"][0] not in LEGAL for a, b in zip(chunks, chunks[1:], strict=False)
        )
        timed = [c for c in chunks if c["low"] is not None]
        turns = sum(c["turns"] for c in timed)
        # Rows are in the order of their turns: only the turn at a border can be counted twice.
        turns -= sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:], strict=False))
        gaps = timed[-1]["high"] - timed[0]["low"] + 1 - turns if timed else 0
        names = [
            {"part": c["part"], "seq": c["seq"], "state": state, "letters": letters}
            for c, (state, letters) in zip(chunks, parts, strict=True)
        ]
        return gaps, *counts, cost, audit, names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64()] * 6 + [pa.string(), pa.list_(part_type)]
        for batch in batches:
            made = [one(chunks) for chunks in batch["chunks"].to_pylist()]
            columns = list(zip(*made, strict=True)) or [[]] * len(types)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["conv_id"], *arrays], ["conv_id", *RESULT_NAMES[:-1], "parts"]
            )

    names = [c for c in counted.columns if c != "conv_id"]
    grouped = counted.groupBy("conv_id").agg(F.collect_list(F.struct(*names)).alias("chunks"))
    schema = ", ".join(x for x in RESULT.replace("\n", " ").split(", ") if "repaired" not in x)
    parts = "array<struct<part:int,seq:int,state:int,letters:string>>"
    return grouped.mapInArrow(run, f"conv_id {type_}, {schema}, parts {parts}")


def _of_chunks(chunks: DataFrame) -> DataFrame:
    """The result for conversations that came in chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("rows", "state", "letters")]
            lines = [
                edited([(r["role"], r["text"]) for r in rows], letters, state)
                for rows, state, letters in zip(*columns, strict=True)
            ]
            texts = ["\n".join(x) if x else None for x in lines]
            yield pa.RecordBatch.from_arrays(
                [batch["part"], batch["seq"], pa.array(texts, pa.string())], ["part", "seq", "text"]
            )

    combined = kept(_combined(kept(_counted(chunks), "counted")), "combined")
    parts = combined.select("conv_id", F.explode("parts").alias("p"))
    asked = parts.select("p.part", "p.seq", "p.state", "p.letters")
    placed = chunks.select("part", "seq", "rows").join(asked, ["part", "seq"])
    texts = placed.mapInArrow(run, "part int, seq int, text string")
    lined = parts.select("conv_id", "p.part", "p.seq").join(texts, ["part", "seq"])
    piece = F.struct("part", "seq", "text")
    lined = lined.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("text").isNotNull(), piece))).alias("all")
    )
    lined = lined.select(
        F.col("conv_id").alias("_conv"), F.array_join(F.transform("all", lambda x: x["text"]), "\n").alias("repaired")
    )
    joined = combined.drop("parts").join(lined, combined["conv_id"].eqNullSafe(lined["_conv"]))
    return joined.select("conv_id", *RESULT_NAMES)


def repaired(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired``: one row per
    conversation of ``conversations``, repaired as it stands in ``rows``.

    ``rows`` has ``conv_id, turn, role, text`` without nulls in the last two. Rows come in the order
    of their turns, those without a turn first; equal turns by role, then by the XXH64 of
    the text. A null conversation id is a conversation. Conversations without rows have zeros, an empty
    audit and nothing left. An empty table gives an empty result, further columns are not read.
    """
    slim = rows.select("conv_id", "turn", "role", "text")
    found = kept(_sorted(conversations, slim), "conversations")
    done = found.where("rows IS NULL").select("conv_id", *RESULT_NAMES)
    chunks = found.where("rows IS NOT NULL").select("conv_id", "part", "seq", "rows")
    with_rows = rows.groupBy("conv_id").agg(F.lit(1).alias("_any")).withColumnRenamed("conv_id", "_conv")
    all_ids = conversations.select("conv_id").distinct()
    none = all_ids.join(with_rows, all_ids["conv_id"].eqNullSafe(with_rows["_conv"]), "left_anti")
    empty = [F.lit(0).cast("long").alias(c) for c in RESULT_NAMES[:-2]]
    empty += [F.lit("").alias(c) for c in RESULT_NAMES[-2:]]
    return done.unionByName(_of_chunks(chunks)).unionByName(none.select("conv_id", *empty))
