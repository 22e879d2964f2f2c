"""Periodic runs against a search of every period."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from termloom.llm import periods, queries
from termloom.llm.common import slices

TABLES = "/root/testdata/sf0.001"


def brute(words):
    """Runs by trying each period, without those whose stretch has a smaller one."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            i += 1
            if length < max(6, 4 * q):
                continue
            part = words[start : start + length]
            if not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_transform_is_a_cyclic_convolution():
    made = np.random.default_rng(0)
    x, y = (made.integers(0, periods.PRIME, (16, 3)).astype(np.uint64) for _ in range(2))
    product = periods.forward(x) * periods.forward(y) % np.uint64(periods.PRIME)
    found = periods.backward(product)
    for k in range(16):
        for c in range(3):
            want = sum(int(x[i, c]) * int(y[(k - i) % 16, c]) for i in range(16)) * 16 % periods.PRIME
            assert found[k, c] == want


def test_digits_keep_sums_below_the_prime():
    values = np.arange(100_000, dtype=np.uint64)
    for size in (1, 64, 4096, 1 << 18):
        parts = periods.digits(values, size, 100_000)
        most = size * sum(int(p.max()) ** 2 for p in parts)
        assert most < periods.PRIME
        assert len({tuple(x) for x in zip(*(p.tolist() for p in parts), strict=True)}) == 100_000


@pytest.mark.parametrize("entries", [periods.ENTRIES, 64])
def test_runs_equal_a_search_of_every_period(monkeypatch, entries):
    monkeypatch.setattr(periods, "ENTRIES", entries)
    made, texts = random.Random(1), [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a", b"b"] * 3, [b"a", b"b"] * 4]
    for _ in range(400):
        n, kinds = made.randint(0, 130), made.choice([1, 2, 3, 50])
        words = [b"%d" % made.randrange(kinds) for _ in range(n)]
        for _ in range(made.randint(0, 3)):
            if n > 10:
                a, p = made.randrange(n), made.randint(1, n // 5)
                for i in range(a, min(n, a + p * made.randint(2, 9))):
                    words[i] = words[a + (i - a) % p]
        texts.append(words)
    found = periods.batch_runs(texts)
    assert found == [brute(t) for t in texts]
    assert sum(map(len, found)) > 300
    for words, runs in zip(texts, found, strict=True):
        assert periods.collapsed(words, runs) == collapsed(words, runs)


def test_slices_of_a_batch_hold_every_row():
    texts = ["", None, "a" * 25, "b", "cc", None, "d" * 9, "e"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    found = [part["text"].to_pylist() for part in slices(batch, 10)]
    assert [t for part in found for t in part] == texts and len(found) > 2
    assert list(slices(batch.slice(0, 0), 10)) == []


def test_long_texts():
    unit = [b"%d" % i for i in range(5000)]
    noise = [b"n%d" % i for i in range(777)]
    assert periods.batch_runs([[*noise, *unit * 4, *unit[:123]]]) == [[(777, 20123, 5000)]]
    assert periods.batch_runs([[b"a"] * 50_000, unit]) == [[(0, 50_000, 1)], []]


def test_periodic_runs(docs, clashing, empty, rows):
    def key(x):
        return str(x)

    want = []
    for r in rows:
        words = (r[1] or "").encode().split()
        runs = brute(words) if len(words) < 1000 else periods.batch_runs([words])[0]
        want.append((r[0], len(words), runs, collapsed(words, runs).decode()))
    for frame in (docs, clashing):
        found = [
            (r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["text"])
            for r in periods.periodic_runs(frame).collect()
        ]
        assert sorted(found, key=key) == sorted(want, key=key)
        assert periods.planted(frame).count() == len(rows)
    assert periods.periodic_runs(empty).count() == periods.planted(empty).count() == 0


def planted(doc_id, text):
    words = (text or "").encode().split()
    h, n = 1 if doc_id is None else zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_equals_brute_force(spark):
    given = spark.read.parquet(f"{TABLES}/documents.parquet").collect()
    want = []
    for r in given:
        words = planted(r["doc_id"], r["text"])
        runs = brute(words) if len(words) < 800 else periods.batch_runs([words])[0]
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((
            r["doc_id"], len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest(),
        ))
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    found = queries.QUERIES["op11_block_convolution"](spark, TABLES).select(names).collect()
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert sum(r["n_runs"] for r in found) > 10
