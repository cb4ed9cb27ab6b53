"""Token files, fill-in-the-middle samples and importance draws against brute force and on odd rows."""

import collections
import hashlib
import itertools
import math
import os
import random
import re
import struct
import sys
import time
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from lodgelens.llm import common, fill_middle, queries, resample, token_files
from lodgelens.session import scratch_path
from oracle_check import compare, duck

SF, SF10 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def odd_rows():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdé\U0001f600", k=3))
    rows = [(i, " ".join(word() for _ in range(rng.randint(0, 40)))) for i in range(200, 100, -1)]
    rows += [(7, "one text"), (7, "another text"), (7, "one text"), (None, "no id"), (None, None), (-5, ""), (9, None), (2 ** 62, " \t\n")]
    # columns that share names with the operators' own
    return [(*r, "x", 5, [1], "y", 3, "z") for r in rows]


SCHEMA = "doc_id long, text string, h string, at long, lines array<int>, _at string, words long, features string"


# --- token files ---

def expected_ids(rows):
    """(doc_id, start, ids) by the file order, with brute-force encoding."""
    t, at, out = Tokenizer.from_file(VOCABULARY), 0, []
    for d, x in rows:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        out.append((d, at, ids))
        at += len(ids)
    return out


def unpacked(rows):
    return [(r.doc_id, r.start, list(struct.unpack(f"<{r.n_tokens}I", r.ids))) for r in rows]


def test_token_files_match_brute_force(spark):
    got = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op11_seekable_token_files"](spark, SF10).collect()}
    rows = sorted((r.doc_id, r.text) for r in common.table(spark, SF10, "documents").collect())
    assert got == {d: (at, len(x), zlib.crc32(struct.pack(f"<{len(x)}I", *x))) for d, at, x in expected_ids(rows)}
    assert len(rows) == len(got)


@pytest.mark.parametrize("partitions", [1, 5])
def test_token_files_odd_rows(spark, monkeypatch, partitions):
    monkeypatch.setattr(token_files, "FRAME_IDS", 40)
    monkeypatch.setattr(token_files, "FILE_IDS", 300)
    folder, docs = scratch_path(spark, "ids"), spark.createDataFrame(odd_rows(), SCHEMA)
    files = token_files.write_ids(docs, folder, VOCABULARY, 1, partitions == 5, partitions)
    assert files.count() > 5
    got = unpacked(sorted(token_files.read_ids(spark, folder).collect(), key=lambda r: r.start))
    ids = [g[0] for g in got]
    assert ids == sorted(ids, key=lambda d: (d is None, d)) and len(ids) == len(odd_rows())
    t = Tokenizer.from_file(VOCABULARY)
    want = collections.Counter((r[0], tuple(t.encode(r[1] or "", add_special_tokens=False).ids) + (1,)) for r in odd_rows())
    assert collections.Counter((d, tuple(x)) for d, _, x in got) == want
    assert [at for _, at, _ in got] == list(itertools.accumulate((len(x) for _, _, x in got), initial=0))[:-1]
    # equal rows of an id follow each other
    seven = [tuple(x) for d, _, x in got if d == 7]
    assert len(set(seven)) == 2 and seven[1] in (seven[0], seven[2])
    some = token_files.fetch_ids(spark, folder, [7, -5, 150, 151, 999]).collect()
    assert sorted(unpacked(some)) == sorted(g for g in got if g[0] in (7, -5, 150, 151))
    assert token_files.fetch_ids(spark, folder, []).count() == 0


def test_token_files_without_rows(spark):
    folder = scratch_path(spark, "ids")
    assert token_files.write_ids(spark.createDataFrame([], "doc_id long, text string"), folder, VOCABULARY, 1).count() == 0
    assert token_files.read_ids(spark, folder).count() == 0 and token_files.fetch_ids(spark, folder, [1]).count() == 0


def test_frames_are_independent_and_checked(tmp_path):
    path = str(tmp_path / "a.zst")
    writer = token_files.FileWriter(path)
    for i in range(3000):
        writer.add(i, np.arange(i % 500, dtype=np.uint32))
    frames, docs, ids, size, first, last, nulls = writer.close()
    assert frames > 3 and (docs, first, last, nulls) == (3000, 0, 2999, False) and size == os.path.getsize(path)
    reader = token_files.FileReader(path)
    whole = b"".join(zstandard.ZstdDecompressor().decompress(open(path, "rb").read()[reader.offset[k]:reader.offset[k + 1]]) for k in range(frames))
    # any decoder reads the file from its start; the tail is skippable frames
    with open(path, "rb") as f:
        assert zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read() == whole
    bytes_ = bytearray(open(path, "rb").read())
    bytes_[int(reader.offset[2]) + 50] ^= 255
    open(path, "wb").write(bytes_)
    reader = token_files.FileReader(path)
    wanted = reader.frames_of(np.array([3, 2999]))
    assert wanted == [0, frames - 1]  # the damaged frame is not read for these
    assert [len(x) for k in wanted for d, _, x in reader.frame(k) if d in (3, 2999)] == [3, 2999 % 500]
    with pytest.raises(token_files.DamagedFrame):
        list(reader.frame(2))
    open(path, "wb").write(bytes_[:-4])
    with pytest.raises(token_files.DamagedFrame):
        token_files.FileReader(path)


def test_words_encode_as_their_text(monkeypatch):
    """Word by word is the same as whole, also where the memo is emptied, on odd characters and on added tokens."""
    monkeypatch.setattr(token_files, "MEMO", 50)
    t, rng = Tokenizer.from_file(VOCABULARY), random.Random(9)
    encode = token_files.WordEncoder(t)
    odd = [chr(c) for c in range(128)] + ["'"] * 5 + list("é\u0301\u0308\u0331\u00a0\u2028\u3000ß\u0130\u03a3\u03c2\u201c\u2014\u0663\u00bd\u4f60\uff46\U0001f600")
    bits = odd + ["don't", "'Tis", "H\u0331", "<|endoftext|>", "<|EndOfText|>", "<|startoftext|>", "x<|endoftext|>y", "word.", "WORD", "3rd", "a1b2", " ", " ", "\n", "x" * 70]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += [r[0] for r in duckdb.sql(f"select text from '{SF10}/documents.parquet'").fetchall()]
    assert [list(np.frombuffer(encode(x.encode()), "<u4")) for x in texts] == [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("by_words", [False, True])
def test_long_texts_are_encoded_whole(spark, by_words):
    rows = [(1, "word " * 200_000), (2, "x" * 100_000), (3, " \n" * 500_000)]
    folder = scratch_path(spark, "ids")
    token_files.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), folder, VOCABULARY, 1, by_words, 1)
    got = unpacked(sorted(token_files.read_ids(spark, folder).collect(), key=lambda r: r.start))
    assert got == expected_ids(rows)


# --- fill in the middle ---

def expected_sample(doc_id, text):
    text = text or ""
    units = [m[0] for m in re.finditer(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)]
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    form = "spm" if h4 % 100 < 80 else "psm"
    return doc_id, n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_fill_middle_matches_sql(spark):
    name = "op12_capture_fill_middle"
    res = compare(spark, duck(SF10), name, queries.QUERIES[name], queries.SQL[name], SF10)
    assert res["status"] == "ok", res


def test_fill_middle_odd_rows(spark):
    rng = random.Random(5)
    bits = [" ", "\n", "\t ", "a", "é\U0001f600", "<", "<S", "<P", ">", "word", "\u2028", "\x00"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 30)))) for i in range(400)]
    rows += [(i, f"a <{m}> b") for i, m in zip(range(400, 430), itertools.cycle("PSM"))]
    rows += [(1, "again other"), (1, "again other"), (None, "no id at all"), (None, None), (500, None), (501, "")]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, output string, n int")
    made = fill_middle.fill_middle(docs).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    got = [tuple(r) for r in made.collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(((*expected_sample(*r), r[1] or "") for r in rows), key=key)
    assert len({r[2] for r in got}) == 3
    assert fill_middle.fill_middle(docs.where("false")).count() == 0


def test_fill_middle_rates(spark):
    docs = spark.range(2000).selectExpr("id as doc_id", "'a b c' as text")
    count = collections.Counter(r.form for r in fill_middle.fill_middle(docs, seed=1, rate=100, spm=0).collect())
    assert count == {"psm": 2000}
    count = collections.Counter(r.form for r in fill_middle.fill_middle(docs, seed=1, rate=30, spm=50).collect())
    assert abs(count["plain"] - 1400) < 80 and abs(count["spm"] - 300) < 60


def test_fill_middle_long_texts(spark):
    rows = [(i, t) for i, t in enumerate(["a " * 1_000_000, " " * 2_000_000, "x" * 2_000_000, "a \n" * 300_000 + " " * 900_000] * 2)]
    began = time.time()
    got = [tuple(r) for r in fill_middle.fill_middle(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert time.time() - began < 60
    assert sorted(got) == [expected_sample(*r) for r in rows]


# --- importance draws ---

def expected_draw(rows, target, percent=10, least=20, seed=2024, buckets=10_000, most=1):
    """(doc_id, n_features, weight, score, rank) in row order, by counting every text's runs."""
    def runs(text):
        low = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) % buckets for k in range(1, most + 1) for i in range(len(w) - k + 1)]

    held = [runs(t) for _, t in rows]
    s = collections.Counter(b for _, f in held for b in f)
    t = collections.Counter(b for x in target for b in runs(x)[1])
    n, m = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n + buckets) / ((s[b] + 1) * (m + buckets)))) for b in range(buckets)]
    out = []
    for (d, _), (words, f) in zip(rows, held):
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([d, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, words >= least])
    fit = sorted((i for i, r in enumerate(out) if r[5]), key=lambda i: (-out[i][3], out[i][0] is None, out[i][0] or 0, i))
    for place, i in enumerate(fit[:percent * len(fit) // 100], 1):
        out[i][4] = place
    return [tuple(r[:5]) for r in out]


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_draw_matches_brute_force(spark):
    got = queries.QUERIES["op13_line_importance_draw"](spark, SF10).collect()
    rows = [(r.doc_id, r.text) for r in common.table(spark, SF10, "documents").collect()]
    assert by_id(got) == by_id(expected_draw(rows, [r.text for r in common.table(spark, SF10, "benchmark").collect()]))
    assert sum(r["rank"] is not None for r in got) > 50


@pytest.mark.parametrize("most", [1, 3])
@pytest.mark.parametrize("hot", [2, 10 ** 9])
def test_draw_across_lines(spark, monkeypatch, most, hot):
    """Lines that most texts share, blank and one-word lines, runs over several newlines, repeated and null ids."""
    monkeypatch.setattr(resample, "HOT", hot)
    rng = random.Random(most)
    lines = [" ".join(rng.choices(["Ab", "cd", "é9", "x-y", "--", "B2"], k=rng.randint(0, 6))) for _ in range(30)] + ["", "", "one", "the same line"]
    text = lambda: "\n".join(rng.choices(lines, k=rng.randint(0, 12)))
    rows = [(i, text()) for i in range(150)] + [(None, text()), (None, None), (3, "the same line"), (3, text()), (8, "")]
    rows += [(1000 + i, "the same line\none\nthe same line") for i in range(100)]
    target = [text() for _ in range(10)] + [None, ""]
    docs = spark.createDataFrame([(*r, 1, "x", 2, [3]) for r in rows], "doc_id long, text string, row long, line string, n int, features array<int>")
    bench = spark.createDataFrame([(t, 1) for t in target], "text string, n int")
    got = resample.resample(docs, bench, percent=37, least_words=4, seed=7, buckets=97, most=most).collect()
    want = expected_draw(rows, target, 37, 4, 7, 97, most)
    assert by_id(r[:4] for r in got) == by_id(r[:4] for r in want)
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, sum(r[4] is not None for r in want) + 1))
    assert by_id((r.doc_id, r["rank"]) for r in got if r.doc_id not in (None, 3)) == by_id((r[0], r[4]) for r in want if r[0] not in (None, 3))


def test_draw_without_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert resample.resample(none, some).count() == 0
    assert [r.n_features for r in resample.resample(some, none).orderBy("doc_id").collect()] == [2, 0]


def test_draw_long_texts(spark):
    rows = [(1, "ab " * 400_000), (2, "\n" * 1_000_000), (3, "x" * 1_000_000), (4, "a\n" * 300_000), (5, "a b")]
    got = resample.resample(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([("ab a",)], "text string")).collect()
    assert by_id(got) == by_id(expected_draw(rows, ["ab a"]))
