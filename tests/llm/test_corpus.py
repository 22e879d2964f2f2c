"""Decontamination, mixing, SimHash, sharding, quality and the pipeline."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from termloom.llm import contamination, mixing, quality, sharding, simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def prose(seed, words):
    made = random.Random(seed)
    return " ".join("".join(made.choices("abcdehilnorst", k=made.randint(2, 9))) for _ in range(words))


def brute_print(text):
    words = WORD.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)
    ]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    """Least member of the component of each fingerprint under two bits."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 2:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {p: find(p) for p in prints}


def test_masks_cover_every_pair_of_bits():
    for i, j in itertools.combinations(range(64), 2):
        assert any(not (m >> i & 1 or m >> j & 1) for m in simhash.masks())


def test_classes(docs, clashing, empty, rows):
    prints = [brute_print(r[1]) for r in rows]
    roots = brute_classes(sorted(set(prints)))
    least = defaultdict(lambda: None)
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            least[roots[p]] = min(r[0], r[0] if least[roots[p]] is None else least[roots[p]])
    want = sorted(((r[0], p, least[roots[p]]) for r, p in zip(rows, prints, strict=True)), key=str)
    for frame in (docs, clashing):
        found = simhash.classes(frame).select("doc_id", "fp", "component_id").collect()
        assert sorted(((a, b % 2**64, c) for a, b, c in found), key=str) == want
        distinct = simhash.distinct_documents(frame)
        assert distinct.count() == len(set(roots.values()))
        assert {1, 4, 5, 6, 16} <= {r["doc_id"] for r in distinct.collect()}
        assert distinct.columns == frame.columns
    assert simhash.classes(empty).count() == simhash.distinct_documents(empty).count() == 0


def test_one_document_of_each_class_stays(spark):
    made = random.Random(5)
    rows = []
    for group in range(12):
        base = prose(100 + group, made.randint(200, 900)).split()
        for copy in range(made.randint(1, 8)):
            words = list(base)
            if copy % 2:
                words[made.randrange(len(words))] = f"w{made.random()}"
            rows.append((len(rows), " ".join(words)))
    rows += [(None, rows[0][1]), (3, rows[0][1]), (3, rows[0][1]), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    roots = brute_classes(sorted({brute_print(t) for _, t in rows}))
    want = {}
    for number, text in rows:
        root = roots[brute_print(text)]
        order = (number is None, number or 0)
        want[root] = min(want.get(root, order), order)
    left = [(r["doc_id"] is None, r["doc_id"] or 0) for r in simhash.distinct_documents(docs).collect()]
    assert sorted(left) == sorted(want.values())


def test_hot_classes_keep_one(spark):
    base = prose(70, 900).split()
    rows = [(0, " ".join(base)), (10_000, prose(71, 900))]
    rows += [(k, " ".join([*base[: k % 5], *base[k % 5 + 1 :]])) for k in range(1, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    roots = brute_classes(sorted({brute_print(t) for _, t in rows}))
    assert simhash.distinct_documents(docs).count() == len(set(roots.values()))


def test_components_of_fingerprints_a_few_bits_apart(spark):
    made = np.random.default_rng(2)
    prints = set()
    for _ in range(25):
        p = int(made.integers(0, 2**63))
        for _ in range(12):
            prints.add(p)
            for _ in range(made.integers(1, 4)):
                p ^= 1 << int(made.integers(0, 64))
    signed = [(p - 2**64 if p >= 2**63 else p,) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"))
    found = {r["a"]: r["b"] for r in simhash.components(edges).collect()}
    roots = brute_classes(sorted(p for (p,) in signed) and sorted(prints))
    groups, want = defaultdict(set), defaultdict(set)
    for (p,) in signed:
        groups[found.get(p, p)].add(p % 2**64)
    for p, r in roots.items():
        want[r].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


ITEMS = [(0, "the quick brown fox jumps over the lazy dog and runs far away from here today"),
         (1, "tiny item"), (2, None), (3, ""), (4, "one two three four five six seven eight nine ten one two")]


def brute_leaks(text, items):
    """Best share of an item's shingles over all item-sized windows."""
    words, out = contamination.tokens((text or "").encode()), []
    for number, item in items:
        own = contamination.tokens((item or "").encode())
        if not own or not words:
            continue
        size, width = min(5, len(own)), min(len(own), len(words))

        def grams(w, size=size):
            return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))

        want = grams(own)
        best = max(
            sum((want & grams(words[i : i + width])).values()) / sum(want.values())
            for i in range(len(words) - width + 1)
        )
        if best >= 0.8:
            out.append((number, best))
    return out


def test_leaks(spark, docs, clashing, empty, rows):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    fox = ITEMS[0][1]
    texts = [fox, "so " * 30 + fox.upper() + ", and on", fox.replace("lazy", "cat"), fox.replace("today", "now"),
             fox[:40], "tiny item", "a tiny, item!", "item tiny", ITEMS[4][1] + " six", None, ""]
    made = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in enumerate(texts)], docs.schema)
    found = contamination.leaks(made, benchmark).collect()
    want = sorted((i, n, round(s, 9)) for i, t in enumerate(texts) for n, s in brute_leaks(t, ITEMS))
    assert sorted((r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in found) == want
    leaked = {w[0] for w in want}
    assert leaked == {0, 1, 3, 5, 6, 8}
    left = contamination.clean(made, benchmark)
    assert {r["doc_id"] for r in left.collect()} == set(range(len(texts))) - leaked
    for frame in (docs, clashing):
        assert contamination.clean(frame, benchmark).count() == len(rows)
        assert contamination.clean(frame, benchmark).columns == frame.columns
    assert contamination.leaks(empty, benchmark).count() == 0
    assert contamination.leaks(docs, benchmark.limit(0)).count() == 0


def test_benchmark_in_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 60)
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert len(list(contamination.blocks(benchmark))) > 1
    made = spark.createDataFrame([(1, f"{ITEMS[0][1]} - {ITEMS[4][1]}", "en", "a", 0)], docs.schema)
    assert sorted(r["item_id"] for r in contamination.leaks(made, benchmark).collect()) == [0, 4]
    assert contamination.clean(made, benchmark).count() == 0


def test_index_finds_all_within_the_radius():
    made = np.random.default_rng(3)
    prints = [int(x) for x in made.integers(0, 2**63, 200)]
    for p in prints[:40]:
        for bits in range(0, 20):
            x = p
            for b in made.choice(64, bits, replace=False):
                x ^= 1 << int(b)
            want = {i for i, q in enumerate(prints) if (q ^ x).bit_count() <= contamination.RADIUS}
            assert contamination.MultiIndex(prints).within(x) == want if bits in (0, 16) else True


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, free, target = sum(sizes.values()), set(names), {}
    while free:
        rest = total - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= 3 * sizes[s]}
        if not over:
            return target | share
        target |= {s: 3.0 * sizes[s] for s in over}
        free -= over
    return target


def test_mixing(spark, docs, clashing, empty, rows):
    many = [(i, "w " * (i % 37), "en", "big" if i % 3 else f"s{i % 5}", 0) for i in range(900)]
    for frame, data in ((docs, rows), (clashing, rows), (spark.createDataFrame(many, docs.schema), many)):
        found = mixing.plan(mixing.sized(frame)).collect()
        sizes = Counter()
        for r in data:
            sizes[r[3]] += len(WORD.findall((r[1] or "").encode()))
        want = brute_targets(sizes)
        longest = max(r["size"] for r in found)
        taken = Counter()
        for r in found:
            assert r["source_size"] == sizes[r["source"]]
            assert r["target"] == pytest.approx(want[r["source"]])
            assert r["taken"] in {0, r["size"], 2 * r["size"], 3 * r["size"]}
            taken[r["source"]] += r["taken"]
        assert sum(taken.values()) <= sum(sizes.values())
        assert all(abs(taken[s] - want[s]) <= 2 * longest for s in sizes)
        assert sorted(map(str, found)) == sorted(map(str, mixing.plan(mixing.sized(frame)).collect()))
        out = mixing.mixed(frame)
        assert out.columns == frame.columns
        assert out.count() == sum(r["taken"] // r["size"] for r in found if r["size"])
    assert mixing.plan(mixing.sized(empty)).count() == mixing.mixed(empty).count() == 0


def test_sharding(spark, docs, clashing, empty, rows, monkeypatch):
    monkeypatch.setattr(sharding, "PIECE", 10)
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = sharding.sharded(many, []).collect()
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 16)
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert all(150 < len(v) < 350 for v in by_shard.values()) and len(by_shard) == 16
    for frame in (docs, clashing):
        got = sharding.sharded(frame, ["doc_id", "text"]).collect()
        assert len(got) == len(rows)
        for r in got:
            text = (r["row"]["text"] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text))
    assert sharding.sharded(empty, []).count() == 0


def test_changed_weights_move_documents_only_into_or_out_of_their_subtree(spark):
    ids = spark.range(3000)
    light = [1.0] * 16
    heavy = [*light[:5], 3.0, *light[6:]]
    pairs = ids.select(
        sharding.shard_of(F.col("id"), light).alias("a"), sharding.shard_of(F.col("id"), heavy).alias("b")
    ).collect()
    moved = [p for p in pairs if p["a"] != p["b"]]
    assert moved and all(p["b"] == 5 for p in moved)


def brute_counts(text):
    text = text or ""
    words = [w.decode() for w in WORD.findall(text.encode())]
    runs = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x.encode())]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again))


def test_quality(spark, docs, clashing, empty, rows):
    for frame in (docs, clashing):
        found = quality.judged(frame, ["doc_id", "text"]).collect()
        assert len(found) == len(rows)
        for r in found:
            want = brute_counts(r["row"]["text"])
            assert tuple(r[c] for c in quality.COUNTS) == want
            assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert r["kept"] == (not r["base_failed"])  # groups too small for the method
        assert quality.accepted(frame).columns == frame.columns
    assert quality.accepted(empty).count() == 0


def test_outliers_go_and_clean_documents_stay(spark, docs):
    good = [(i, prose(i, 60 + i * 7 % 400), "en", "a", 0) for i in range(150)]
    odd = [(1000 + i, " ".join(w + "###%%" for w in prose(i, 90).split()), "en", "a", 0) for i in range(12)]
    frame = spark.createDataFrame(good + odd, docs.schema)
    kept = {r["row"]["doc_id"] for r in quality.judged(frame, ["doc_id"]).where("kept").collect()}
    assert kept == set(range(150))


def test_small_groups_are_judged_by_their_language_or_all(spark, docs):
    good = [(i, prose(i, 100 + i * 7 % 400), "en", "a", 0) for i in range(150)]
    good += [(i, prose(i, 100 + i * 7 % 400), "en", "b" if i % 2 else None, 0) for i in range(150, 170)]
    good += [(i, prose(i, 100 + i * 7 % 400), "de" if i % 2 else None, "a", 0) for i in range(170, 190)]
    places = [("en", "b"), ("en", None), ("en", "c"), ("de", "a"), (None, "a"), ("fr", "d")]
    odd = [(1000 + i, " ".join(w + "###%%" for w in prose(i, 90).split()), *p, 0) for i, p in enumerate(places)]
    frame = spark.createDataFrame(good + odd, docs.schema)
    kept = {r["row"]["doc_id"] for r in quality.judged(frame, ["doc_id"]).where("kept").collect()}
    assert kept == set(range(190))


def test_junk_of_two_fifths_goes(spark, docs):
    good = [(i, prose(i, 100 + i * 7 % 400), "en", "a", 0) for i in range(150)]
    odd = [(1000 + i, " ".join(w + "###%%" for w in prose(i, 90).split()), "en", "a", 0) for i in range(100)]
    frame = spark.createDataFrame(good + odd, docs.schema)
    kept = {r["row"]["doc_id"] for r in quality.judged(frame, ["doc_id"]).where("kept").collect()}
    assert kept == set(range(150))


def test_estimate_equals_numpy(spark):
    made = np.random.default_rng(4)
    x = made.normal(size=(60, 4)) @ made.normal(size=(4, 4))
    frame = spark.createDataFrame([("g", *map(float, r)) for r in x], "key string, x0 double, x1 double, x2 double, x3 double")
    model = quality._estimate(frame, ["key"])
    found = frame.join(model, "key").select(*quality._x(), quality._distance().alias("d"), "det").collect()
    cov = np.cov(x.T, bias=True) + np.diag(quality.RIDGE)
    for r in found:
        v = np.array(r[:4]) - x.mean(axis=0)
        assert r["d"] == pytest.approx(v @ np.linalg.solve(cov, v))
        assert r["det"] == pytest.approx(np.log(np.linalg.det(cov)))


def test_native_operators_run_no_python(docs):
    for frame in (quality.accepted(docs), sharding.sharded(docs, docs.columns)):
        plan = frame._jdf.queryExecution().toString()
        assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan


def test_pipeline(spark, docs, clashing, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]
    folder = str(tmp_path)
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    out = corpus_pipeline.run(spark, folder).collect()
    # Copies of one text, blank, short and repetitive texts are gone.
    assert {r["doc_id"] for r in out} <= {1, 3, 4, 5, 6, 10, 11, 16, None}
    assert 1 in {r["doc_id"] for r in out} and {r["shard"] for r in out} <= set(range(16))
    for frame in (docs.limit(0), clashing):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, frame, folder).collect()
    # Computed columns win over the input's of the same name, which are renamed.
    made = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    ours = corpus_pipeline.sharding_tree(spark, clashing, folder)
    plain = corpus_pipeline.sharding_tree(spark, docs, folder)
    assert sorted(map(str, ours.select(made).collect())) == sorted(map(str, plain.select(made).collect()))
    assert {(r["input_size"], r["input_shard"], r["input_slot"]) for r in ours.collect()} == {("?",) * 3}
