"""Token files: offsets by select, pieces, and the round trip through the files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from termloom.llm import queries, tokenfiles

TABLES = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


@pytest.mark.parametrize(("count", "most"), [(1, 1), (1, 900), (700, 1), (3000, 5), (2000, 400), (5, 70_000), (600, 3)])
def test_select_gives_every_offset(count, most):
    made = np.random.default_rng(count)
    ends = np.cumsum(made.integers(1, most + 1, count))
    width, lower, upper, samples = tokenfiles.packed(ends)
    code = tokenfiles.Offsets(count, width, lower, upper, samples)
    assert (code.select(np.arange(count)) == ends).all()
    ranks = made.integers(0, count, 50)
    begin, end = code.spans(ranks)
    assert (end == ends[ranks]).all() and (begin == np.concatenate(([0], ends))[ranks]).all()
    # Near-minimal: two bits and the low bits for each, and the samples.
    assert 8 * (len(lower) + len(upper)) <= count * (width + 3) + 64
    assert len(samples) == 4 * -(-count // tokenfiles.SAMPLE)


def test_pieces_encode_like_whole_texts(tokenizer):
    encode = tokenfiles.Encoder(open(PATH).read())
    assert encode.separable
    made, signs = random.Random(3), list(" \n\t\r\x1c\x85 　aAé中9٣.'s!,;​́") + ["<|endoftext|>"]
    texts = ["".join(made.choice(signs) for _ in range(made.randint(0, 25))) for _ in range(5000)]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encode(texts) == want == encode(texts)
    for text in texts:
        head, rest = tokenfiles.pieces(text)
        assert head + "".join(" " + r for r in rest) == text


def test_full_memory_keeps_its_older_half(tokenizer, monkeypatch):
    monkeypatch.setattr(tokenfiles, "MOST", 40)
    encode = tokenfiles.Encoder(open(PATH).read())
    known = []
    for k in range(12):
        texts = [f"start{k} the and word{k}x{i} the" for i in range(9)] + ["", "the", " the"]
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
        known.append("the" in encode.rest)
        assert encode(texts) == want
        assert len(encode.rest) <= 40 + 11 and len(encode.heads) <= 40 + 11
    # A frequent piece is learned once; it was forgotten with all others before.
    assert known == [False] + [True] * 11
    learned = []
    monkeypatch.setattr(encode, "_learn", learned.extend)
    encode(["start0 the and the"])
    assert not learned
    assert tokenfiles._trimmed(dict.fromkeys(range(41))) == dict.fromkeys(range(20))


def test_new_pieces_of_mere_runs_go_around_the_usual_pattern(tokenizer, monkeypatch):
    encode, given = tokenfiles.Encoder(open(PATH).read()), []
    whole = encode._encoded
    monkeypatch.setattr(encode, "_encoded", lambda texts: whole(given.extend(t := list(texts)) or t))
    texts = ["the word, and.\nMore 12ab été--x\n(y) Слово|z", "one \"two\" three_4", "the don't\x00 а\u0301 x\ny\n", ""]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encode(texts) == want == encode(texts)
    # Before, every piece that holds a line end went through the pattern alone.
    assert [t for t in given if t.startswith(" ")] == [" don't\x00", " а\u0301", " x\ny\n"]
    assert "More" in given and "--" in given and len(given) == len(set(given))
    made, signs = random.Random(5), ["ab", "é", "Я", "7", "!?", "_", "\n", "'s", " ", "\x01", "ſ", "ǅ", "ª"]
    texts = ["".join(made.choice(signs) for _ in range(made.randint(0, 30))) for _ in range(4000)]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encode(texts) == want


def test_texts_without_a_blank_do_not_fill_the_memory(tokenizer):
    encode = tokenfiles.Encoder(open(PATH).read())
    long = "中文" * 400
    texts = [long, "a " + long, "b", long]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert encode(texts) == want
    assert max(map(len, [*encode.heads, *encode.rest])) <= tokenfiles.LONGEST  # whole texts were kept before
    assert "b" in encode.heads


def test_other_tokenizers_are_given_whole_texts():
    encode = tokenfiles.Encoder(open(public_tokenizers.path("word_bpe_49k.json")).read())
    assert not encode.separable
    own = encode.tokenizer.encode("One  two Three", add_special_tokens=False).ids
    assert encode(["One  two Three"]) == [np.array(own, "<u2").tobytes()]


def brute(tokenizer, rows):
    """(doc_id, start, n_tokens, checksum) of (doc_id, text) rows in order."""
    out, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def found(frame):
    files = tokenfiles.written(frame, PATH)
    rows = tokenfiles.located(files, F.crc32("ids").cast("long").alias("ids_crc32")).collect()
    return sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows)


@pytest.mark.parametrize("segment", [tokenfiles.SEGMENT, 500])
def test_files(spark, docs, clashing, empty, rows, tokenizer, monkeypatch, segment):
    monkeypatch.setattr(tokenfiles, "SEGMENT", segment)
    for frame in (docs, clashing):
        files = tokenfiles.written(frame, PATH)
        made = tokenfiles.located(files, F.crc32("ids").cast("long").alias("ids_crc32")).orderBy("start").collect()
        # Equal ids may stand in either order; the files hold the same documents in order of ids.
        numbers = [r["doc_id"] for r in made]
        assert [n is None for n in numbers] == sorted(n is None for n in numbers)
        assert [n for n in numbers if n is not None] == sorted(n for n in numbers if n is not None)
        want = sorted((str(a), c, d) for a, _, c, d in brute(tokenizer, [(r[0], r[1]) for r in rows]))
        assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in made) == want
        upto = 0
        for r in made:
            assert r["start"] == upto
            upto += r["n_tokens"]
        assert files.agg(F.sum("tokens")).first()[0] == upto
        assert segment > 500 or files.count() > 3
    assert found(empty) == []


def test_hot_null_ids_are_split(spark, tokenizer):
    rows = [(None, f"text {i % 50}") for i in range(400)] + [(i, "x") for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    try:
        files = tokenfiles.written(frame, PATH)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["docs"] for r in files.collect()) < 400
    assert tokenfiles.located(files).count() == 500


def test_written_to_a_folder(spark, docs, tmp_path):
    path = str(tmp_path / "tokens")
    files = tokenfiles.written(docs, PATH, path)
    again = spark.read.parquet(path)
    one = tokenfiles.documents(again).select("doc_id", "ids").collect()
    assert len(one) == docs.count() == files.agg(F.sum("docs")).first()[0]


def test_query_equals_brute_force(spark, tokenizer):
    given = spark.read.parquet(f"{TABLES}/documents.parquet").orderBy("doc_id").collect()
    want = brute(tokenizer, [(r["doc_id"], r["text"]) for r in given])
    rows = queries.QUERIES["op12_elias_fano"](spark, TABLES)
    rows = rows.select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, rows)) == sorted(want)
