"""Suffix, substring and line deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from termloom.llm import lines, substrings, suffixes
from termloom.llm.gsaca import suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def key(row):
    return tuple(str(x) for x in row)


def test_suffix_array():
    for seed in range(800):
        made = random.Random(seed)
        text = [made.randrange(made.choice([1, 2, 26])) for _ in range(made.randrange(30))]
        text *= made.choice([1, 1, 3])
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def brute_bytes(rows, window):
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for r, t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((r[0], len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return sorted(out, key=key)


def found_bytes(docs):
    found = suffixes.deduplicated(docs).drop("kept").collect()
    return sorted(map(tuple, found), key=key)


def test_suffixes(docs, clashing, empty, rows):
    want = brute_bytes(rows, suffixes.WINDOW)
    assert sum(w[2] for w in want) > 3000
    assert found_bytes(docs) == want
    assert found_bytes(clashing) == want
    assert found_bytes(empty) == []


def test_suffixes_with_hot_cores(docs, rows, monkeypatch):
    """Cores that more slices share than a suffix array may hold are counted by window."""
    monkeypatch.setattr(suffixes, "MOST", 1)
    assert found_bytes(docs) == brute_bytes(rows, suffixes.WINDOW)


def brute_words(rows):
    last = 1 << 63
    ids = [last if r[0] is None else r[0] for r in rows]
    words = [WORD.findall(r[1] or "") for r in rows]
    first = defaultdict(lambda: last + 1)
    for number, w in zip(ids, words, strict=True):
        for i in range(len(w) - 12):
            run = tuple(w[i : i + 13])
            first[run] = min(first[run], number)
    out = []
    for r, number, w in zip(rows, ids, words, strict=True):
        gone = {i + j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < number for j in range(13)}
        out.append((r[0], len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=key)


def found_words(docs):
    found = substrings.deduplicated(docs).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], sha(r["text"])) for r in found), key=key)


def test_substrings(docs, clashing, empty, rows):
    want = brute_words(rows)
    assert sum(w[2] for w in want) > 500
    assert found_words(docs) == want
    assert found_words(clashing) == want
    assert found_words(empty) == []


def test_substrings_with_many_small_edits(spark):
    """Copies of one text, each with other words changed: every class has neighbours."""
    made = random.Random(5)
    base = [str(made.randrange(40)) for _ in range(120)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(made.randrange(5)):
            words[made.randrange(len(words))] = f"x{made.randrange(3)}"
        rows.append((i, " ".join(words), "en", "a", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert found_words(docs) == brute_words(rows)
    assert found_bytes(docs) == brute_bytes(rows, suffixes.WINDOW)


def brute_lines(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        text = rows[i][1]
        own = [] if text is None else text.split("\n")
        gone = set()
        for k in range(len(own) - 2):
            run = tuple(own[k : k + 3])
            if run in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(run)
        kept = None if text is None else "\n".join(x for k, x in enumerate(own) if k not in gone)
        out.append((rows[i][0], kept, len(own), len(gone)))
    return sorted(out, key=key)


def test_lines(spark, docs, clashing, empty, rows):
    want = brute_lines(rows)
    assert sorted(map(tuple, lines.deduplicated(docs).collect()), key=key) == want
    assert sorted(map(tuple, lines.deduplicated(clashing).collect()), key=key) == want
    assert lines.deduplicated(empty).collect() == []
    block = "a\nb\nc\nd\ne"
    many = [(i, f"{i}\n{block}\n" + ("c\nd\ne\nf" if i % 2 else "b\nc\nd"), "en", "s", 0) for i in range(40)]
    made = spark.createDataFrame(many, docs.schema)
    assert sorted(map(tuple, lines.deduplicated(made).collect()), key=key) == brute_lines(many)


@pytest.mark.parametrize("copies", [2, 30])
def test_every_copy_is_removed(spark, docs, copies):
    text = "word " * 20 + "".join(chr(97 + i * i % 26) for i in range(600))
    made = spark.createDataFrame([(i, text, "en", "a", 0) for i in range(copies)], docs.schema)
    assert {r["n_removed"] for r in suffixes.deduplicated(made).collect()} == {len(text)}
