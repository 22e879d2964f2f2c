"""Conversation repair against all lists of edits, and its Spark job against one process."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
import xxhash

from termloom.llm import conversations as cv
from termloom.llm import queries

RULE = re.compile(r"(s?(ua)+)?")
TABLES = "/root/testdata/sf0.001"


def outcomes(rows):
    """(cost, letters, roles) of every list of edits with at most two insertions in a row."""
    choices = []
    for role, flaw in rows:
        own = [(3, "D", "")]
        if flaw in (cv.FINE, cv.TRUNCATED):
            extra = flaw == cv.TRUNCATED
            own += [(extra, "K", role[:1] or "-"), (2 + extra, "R", "u"), (2 + extra, "R", "a")]
        choices.append(own)
    inserted = [(2 * k, "I" * k, "".join(r)) for k in range(3) for r in itertools.product("ua", repeat=k)]
    gaps = [inserted] * (len(rows) + 1)
    mixed = [x for pair in itertools.zip_longest(gaps, choices) for x in pair if x]
    for way in itertools.product(*mixed):
        yield tuple("".join(x[k] for x in way) if k else sum(x[0] for x in way) for k in range(3))


def all_edits(rows):
    return min((c, letters) for c, letters, roles in outcomes(rows) if RULE.fullmatch(roles))


@pytest.mark.parametrize("seed", range(60))
def test_best_repair_equals_all_edits(seed):
    made = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", " ", "", "useless"]
    rows = [(made.choice(roles), made.randrange(4)) for _ in range(made.randint(0, 3))]
    assert cv.best_repair(rows) == all_edits(rows)


def test_no_rows_and_long_weights():
    assert cv.best_repair([]) == (0, "")
    rows = [("user", cv.FINE), ("assistant", cv.FINE)] * 400 + [("system", cv.FINE)]
    assert cv.best_repair(rows) == (3, "K" * 800 + "D")


@pytest.mark.parametrize("seed", range(20))
def test_chunks_put_together_equal_the_whole(seed):
    made = random.Random(seed)
    rows = [
        (made.choice(["system", "user", "assistant", "user", "assistant", "x"]), made.choice([0, 0, 0, 1, 2, 3]))
        for _ in range(made.randint(1, 40))
    ]
    cuts = sorted({0, len(rows), *(made.randrange(len(rows)) for _ in range(made.randint(0, 5)))})
    parts = [rows[a:b] for a, b in itertools.pairwise(cuts)]
    cost, letters, ways = cv.put_together([(len(p), cv.chunk_weights(p)) for p in parts])
    assert (cost, letters) == cv.best_repair(rows)
    assert "".join(own for _, own in ways) == letters
    lines = [x for p, (state, own) in zip(parts, ways, strict=True) for x in cv.edited([(r, "") for r, _ in p], own, state)]
    assert lines == cv.edited([(r, "") for r, _ in rows], letters)


# --- the whole job in one process


def signed(text):
    x = xxhash.xxh64_intdigest(text.encode(), 42)
    return x - 2**64 if x >= 2**63 else x


def brute(rows):
    """Result by conversation of (conv_id, turn, role, text) rows, damage included."""
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        group = held[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        group += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, group in held.items():
        group.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], signed(r[2])))
        seen, flaws = set(), []
        for _, role, text in group:
            said = re.findall(r"[^\x20\x09-\x0D]", text)
            flaws.append(1 if not said else 2 if (role, text) in seen else 3 if said[-1] not in ".!?" else 0)
            seen.add((role, text))
        turns = {r[0] for r in group} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(group)]
        cost, letters = cv.best_repair([(r[1], f) for r, f in zip(group, flaws, strict=True)])
        left = "\n".join(cv.edited([r[1:] for r in group], letters))
        out[conv] = (
            gaps, flaws.count(1), flaws.count(2), flaws.count(3), sum(p not in ("su", "ua", "au") for p in pairs),
            cost, letters, hashlib.sha256(left.encode()).hexdigest(),
        )
    return out


def found(given):
    rows = cv.repaired(given, cv.damaged(given)).collect()
    out = {
        r["conv_id"]: (*(r[c] for c in cv.RESULT_NAMES[:-1]), hashlib.sha256(r["repaired"].encode()).hexdigest())
        for r in rows
    }
    assert len(out) == len(rows)
    return out


def made_rows():
    made = random.Random(4)
    texts = ["Hello there.", "no end", "", " \n\t", "Why?", "wide　space。", "Yes!", None, "a.\n"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, ""]
    rows = [
        (conv, turn, made.choice(roles), made.choice(texts))
        for conv in range(150)
        for turn in range(made.randint(0, 9))
    ]
    rows += [(None, t, made.choice(roles), made.choice(texts)) for t in range(12)]
    rows += [(7, None, "user", "No turn."), (7, None, "user", "No turn."), (8, 3, "user", "Again."), (8, 3, "user", "Again.")]
    # One conversation with a third of all rows, with repeated rows and one turn for many of them.
    rows += [(500, t // 3, made.choice(roles), made.choice(texts)) for t in range(600)]
    rows += [(501, 1, "user", "Same."), *[(501, 1, "user", "Same.")] * 90]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("chunk", [cv.CHUNK, 7])
def test_repaired(spark, monkeypatch, chunk):
    monkeypatch.setattr(cv, "CHUNK", chunk)
    rows = made_rows()
    given = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(given) == brute(rows)
    extra = "part seq rows again state parts _c _t _h _row weights".split()
    clashing = spark.createDataFrame(
        [(*r, *("?" for _ in extra)) for r in rows], SCHEMA + "".join(f", {c} string" for c in extra)
    )
    assert found(clashing) == brute(rows)
    assert found(given.limit(0)) == {}


def test_query_equals_one_process(spark):
    given = spark.read.parquet(f"{TABLES}/conversations.parquet")
    want = brute([tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()])
    rows = queries.QUERIES["op13_integer_paths"](spark, TABLES).collect()
    assert {r["conv_id"]: tuple(r[c] for c in [*cv.RESULT_NAMES[:-1], "repaired_sha256"]) for r in rows} == want
    assert len(rows) == len(want)
