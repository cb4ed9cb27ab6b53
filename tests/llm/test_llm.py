"""Each operator against brute force or planted cases, and on nulls, empties, ties, repeats and odd columns."""

import collections
import hashlib
import itertools
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgelens.llm import (common, decontaminate, html_text, language, line_dedup, mixing, near_dup, pii, queries,
                           secrets, top_k, toxicity, trees)

SF = "/root/testdata/sf0.001"


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*[w[k:] for k in range(size)])) if len(w) >= size else frozenset([tuple(w)]) if w else frozenset()


def reachable(sets, percent):
    label = {d: d for d in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while True:
        was = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if was == label:
            return label


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(n))


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def copies():
    """Exact copies, a group of near copies with all rates of edits, and loners."""
    rng = random.Random(1)
    base = words(rng, 120).split()
    docs = [(1000 + i, words(rng, rng.randint(1, 150))) for i in range(60)]
    for i in range(80):
        w = list(base)
        for k in rng.sample(range(120), rng.randint(0, 9)):
            w[k] = words(rng, 1)
        docs.append((i, " ".join(w)))
    docs += [(500 + i, "One TWO three four  five six seven") for i in range(30)]
    return docs + [(700, None), (701, ""), (702, " \t\n"), (703, "a b"), (704, "A B"), (705, "a b c")]


def test_near_duplicates_match_brute_force(spark, copies):
    got = {r.doc_id: r for r in near_dup.near_duplicates(spark, frame(spark, copies, "doc_id long, text string"), 85).collect()}
    sets = {d: shingles(t) for d, t in copies}
    label = reachable(sets, 85)
    assert {d: r.component_id for d, r in got.items()} == label
    assert all(got[d].n_shingles == len(sets[d]) and got[d].kept == (label[d] == d) for d in sets)


def test_near_duplicates_large_buckets(spark, copies, monkeypatch):
    monkeypatch.setattr(near_dup, "SMALL", 4)
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark, frame(spark, copies, "doc_id long, text string"), 85).collect()}
    assert got == reachable({d: shingles(t) for d, t in copies}, 85)


def test_near_duplicates_odd_rows(spark):
    rows = [(None, "a b c d e f", 1), (1, "a b c d e f", 2), (1, "a b c d e f", 3), (2, "A b c d e f", 4)]
    got = near_dup.near_duplicates(spark, frame(spark, rows, "doc_id long, text string, n long")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1, r.kept) for r in got) == [(-1, 1, False), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert near_dup.near_duplicates(spark, frame(spark, [], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("broadcast", [None, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_repeated_ids(spark, copies, monkeypatch, seed, broadcast):
    """Different texts under one id are one document, in any order of rows; nothing depends on what is broadcast."""
    if broadcast is not None:
        monkeypatch.setattr(common, "BROADCAST_BYTES", broadcast)
    rng = random.Random(seed)
    near = lambda t: " ".join([*t.split()[:-1], words(rng, 1)])
    one, two, far = words(rng, 90), words(rng, 90), words(rng, 90)
    rows = [(7, one), (7, two), (3, near(one)), (9, near(two)), (7, far), (20, "only a few"), (21, "only a few"), (8, ""), (8, one), (2, near(far)), (None, far), (None, words(rng, 40))]
    rows += [(5000, words(rng, 30)) for _ in range(40)] + [(4999, None), (6000, words(rng, 5))]
    rng.shuffle(rows)
    sets = [(d, shingles(t)) for d, t in rows]
    label = {d: d for d, _ in sets if d is not None}
    while True:
        was = dict(label)
        for (a, x), (b, y) in itertools.combinations([r for r in sets if r[0] is not None and r[1]], 2):
            if a == b or 100 * len(x & y) >= 85 * len(x | y):
                label[a] = label[b] = min(label[a], label[b])
        if was == label:
            break
    docs = frame(spark, [(*r, "x", 1) for r in rows], "doc_id long, text string, component_id string, node int").repartition(3)
    got = near_dup.near_duplicates(spark, docs, 85).collect()
    assert len(got) == len(rows)
    assert all(r.component_id == (label[r.doc_id] if r.n_shingles else r.doc_id) for r in got if r.doc_id is not None)
    assert sorted((str(r.component_id) for r in got if r.doc_id is None)) == sorted(["None", str(label[7])])


@pytest.mark.parametrize("broadcast_bytes", [None, 0])
def test_equal_rows_are_scored_in_linear_time(spark, broadcast_bytes):
    """10,000 rows of one text without an id, and as many of one id, beside others; both ways give the same."""
    rng = random.Random(3)
    same, mine = words(rng, 24), [words(rng, 24) for _ in range(40)]
    docs = spark.range(10_000).selectExpr("cast(null as long) doc_id", f"'{same}' text").union(
        spark.range(10_000).selectExpr("5 as doc_id", f"'{mine[0]}' text")).union(frame(spark, [(i, t) for i, t in enumerate(mine)] + [(None, None), (3, "")], "doc_id long, text string"))
    train = frame(spark, [(t, "en" if i % 2 else "fr") for i, t in enumerate([same, *mine])], "text string, lang string")
    began = time.time()
    got = collections.Counter((r.doc_id, r.lang_pred) for r in language.identify(spark, docs, train, broadcast_bytes).collect())
    assert time.time() - began < 60
    assert got[None, "fr"] == 10_000 and got[5, "en"] == 10_000 and got[None, "und"] == 1 and sum(got.values()) == 20_042


def test_personal_data_in_a_megabyte_of_digits():
    """Runs that a scanner from each digit would read a million times; matches as the plain pattern finds them."""
    for text in ("1" * 1_000_000, "1." * 500_000, "12 " * 330_000, "+1" + "(" * 1_000_000, "1.2.3." + "9" * 999_000):
        began = time.time()
        pii.base_candidates(text), pii.more_candidates(text)
        assert time.time() - began < 20, text[:9]
    rng, plain = random.Random(8), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    for _ in range(3000):
        text = "".join(rng.choices("11.. 92a", k=rng.randint(0, 40)))
        assert [m.span() for m in pii._IP.finditer(text)] == [m.span() for m in plain.finditer(text)]


def test_met_equals_a_join(spark, monkeypatch):
    """A key with a third of the rows and many small ones, at both sides of the broadcast bound."""
    rows = spark.range(9000).selectExpr("case when id % 3 = 0 then -1 else id div 4 end as key", "id as v")
    table = common.stored(rows.groupBy("key").count().withColumnRenamed("count", "size").where("key % 5 <> 0"), "sizes")
    want = sorted(map(tuple, rows.join(table, "key").select("key", "v", "size").collect()))
    for limit in (1 << 25, 0):
        monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
        assert sorted(map(tuple, common.met(rows, table, "key", 16).select("key", "v", "size").collect())) == want


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    a, b, both = x[:300], x[60:], x
    regs = [near_dup.registers(np.zeros(len(s), np.int64), s, 1)[0] for s in (a, b, both)]
    assert (np.maximum(regs[0], regs[1]) == regs[2]).all()
    assert abs((regs[0] == regs[1]).mean() - 240 / 400) < 0.12


def test_top_k_matches_sql(spark):
    got = queries.QUERIES["op4_branch_bound_top_k"](spark, "/root/testdata/sf0.01").toPandas()
    con = duckdb.connect()
    con.execute("create view embeddings as select * from '/root/testdata/sf0.01/embeddings.parquet'")
    want = con.execute(queries.SQL["op4_branch_bound_top_k"]).df()
    key = ["query_id", "rank", "vec_id", "score"]
    assert got[key].sort_values(key).values.tolist() == want[key].sort_values(key).values.tolist()


def test_top_k_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 5.0]), (2, [1.0, -2.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]), (7, [1.0]), (None, [9.0, 9.0]), (0, [1.0, 0.0])]
    v = frame(spark, rows, "vec_id long, embedding array<float>")
    got = [(r.query_id, r["rank"], r.vec_id, r.score) for r in top_k.exact_top_k(spark, v, v.where("vec_id = 0"), step=1).orderBy("query_id", "rank").collect()]
    assert [g[2] for g in got] in ([1, 2], [1, 1, 2, 2])
    assert all(g[3] == 1024 * 1024 for g in got)
    empty = frame(spark, [], "vec_id long, embedding array<float>")
    assert top_k.exact_top_k(spark, empty, empty).count() == 0


@pytest.mark.parametrize("size", [1.0, 1e4, 3e5, 1e9, 1e11])
@pytest.mark.parametrize("step", [1, 4])
def test_top_k_is_exact_at_every_magnitude(spark, size, step):
    """Near ties of scores on both sides of 2^53 and with products beyond 2^62, against Python's integers."""
    rng = random.Random(int(size))
    base = [rng.uniform(-size, size) for _ in range(12)]
    rows = [(i, [x + rng.choice([0, 0, 1 / 1024, -1 / 1024, 3 / 1024]) for x in base]) for i in range(60)]
    rows += [(60 + i, [rng.uniform(-size, size) / 100 for _ in range(12)]) for i in range(60)] + [(200, [0.0] * 12), (201, base)]
    queries_ = [0, 20, 61]
    if size >= 1e9:  # sums that a long holds, of products that none does
        rows = [(i, [size, size, *[x / size for x in v[2:]]] if not i else [v[0], -v[0] + (i % 7) / 1024, *[x / size for x in v[2:]]]) for i, v in rows]
        queries_ = [0]
    ints = {i: [int(np.floor(1024 * x)) for x in v] for i, v in rows}
    want = []
    for q in queries_:
        order = sorted((-sum(a * b for a, b in zip(ints[q], ints[i])), i) for i in ints if i != q)[:5]
        want += [(q, k, i, -x) for k, (x, i) in enumerate(order, 1)]
    assert all(abs(w[3]) < 2 ** 63 for w in want)
    v = frame(spark, rows, "vec_id long, embedding array<double>").repartition(3)
    got = top_k.exact_top_k(spark, v, v.where(F.col("vec_id").isin(queries_)), k=5, step=step).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_top_k_large_components_rank_right(spark):
    v = frame(spark, [(0, [1e5]), (1, [1e5]), (2, [2e5]), (3, [3e5])], "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in top_k.exact_top_k(spark, v, v.where("vec_id = 0")).orderBy("rank").collect()]
    assert got == [(i, 102_400_000 * 102_400_000 * i) for i in (3, 2, 1)]
    w = frame(spark, [(0, [1e300]), (1, [1e300])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond a long"):
        top_k.exact_top_k(spark, w, w.where("vec_id = 0")).collect()
    w = frame(spark, [(0, [1e307]), (1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond a double"):
        top_k.exact_top_k(spark, w, w.where("vec_id = 0")).collect()


def test_top_k_query_blocks_are_bounded_by_bytes(spark, monkeypatch):
    v = common.table(spark, "/root/testdata/sf0.01", "embeddings")
    q = v.where("vec_id % 100 = 0").union(v.where("vec_id = 0"))
    one = sorted(map(tuple, top_k.exact_top_k(spark, v, q, k=3).collect()))
    monkeypatch.setattr(top_k, "BLOCK_BYTES", 2000)
    assert sorted(map(tuple, top_k.exact_top_k(spark, v, q, k=3).collect())) == one


def test_top_k_blocks_of_queries(spark):
    v = common.table(spark, "/root/testdata/sf0.01", "embeddings")
    q = v.where("vec_id % 50 = 0")
    one, many = (sorted(map(tuple, top_k.exact_top_k(spark, v, q, k=3, query_block=n).collect())) for n in (4096, 4))
    assert one == many


def test_trigram_queries():
    q = secrets.trigram_query(secrets.BASE_RULES[0].pattern)
    assert {"pas", "tok", "api", "sec"} <= secrets.trigrams_of(q)
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == ("and", ("aki", "kia"))
    assert secrets.trigram_query("[0-9a-f]+") is True
    assert secrets.trigram_query("(?:abc|x)y?") is True
    assert secrets.trigram_query("(abcd){2}") == ("and", ("abc", "bcd", "cda", "dab"))


def brute_secrets(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    out = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secrets_match_brute_force(spark):
    rng = random.Random(4)
    bits = ["token", "secret=", "TOKEN = '", "api_key:", "apikey", ":", "=", " ", "é\U0001f600", "AKIA", "ABCDEFGH12345678", "deadbeef" * 3, "0f" * 14, "password", "pass", "\n", '"', "abcdef", "-----BEGIN RSA PRIVATE KEY-----"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 25)))) for i in range(300)] + [(900, None), (901, ""), (902, "secret=token:abcdefgh"), (None, "token=abcdefgh"), (0, "token=abcdefgh")]
    got = secrets.secret_spans(spark, frame(spark, rows, "doc_id long, text string"), secrets.BASE_RULES).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, [(s.start, s.order, s.end) for s in r.found]) for r in got) == sorted(
        (d if d is not None else -1, brute_secrets(t or "")) for d, t in rows)
    assert secrets.secret_spans(spark, frame(spark, [], "doc_id long, text string")).count() == 0


def test_secrets_in_a_megabyte_of_matches(spark):
    """50,000 kept matches, and as many dropped ones, in one text; a text of one endless match; both in seconds."""
    many = "token=abcdef \U0001f600 secret=ab\n" * 50_000
    rows = [(1, many), (2, "f" * 1_000_000), (3, "AKIA" * 250_000), (4, "é" * 1_000_000 + "password: hunter22")]
    start = time.monotonic()
    got = {r.doc_id: [tuple(s) for s in r.found] for r in secrets.secret_spans(spark, frame(spark, rows, "doc_id long, text string"), secrets.BASE_RULES).collect()}
    assert time.monotonic() - start < 40
    assert got == {d: brute_secrets(t) for d, t in rows}
    assert len(got[1]) == 50_000


def test_secret_digest(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op6_trigram_secrets"](spark, SF).collect()}
    for r in common.table(spark, SF, "documents").collect():
        want = ",".join(f"{secrets.BASE_RULES[k].kind}:{a}:{b}" for a, k, b in brute_secrets(r.text or ""))
        assert got[r.doc_id].base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_language_held_out_and_joined_words(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    train = docs.where(~common.held_out()).select("text", "lang")
    near, far = ({r.doc_id: (r.lang_pred, r.score) for r in language.identify(spark, docs, train, b).collect()} for b in (None, 0))
    assert near == far
    truth = {r.doc_id: r.lang for r in docs.where(common.held_out()).collect()}
    assert sum(near[d][0] == x for d, x in truth.items()) >= 0.98 * len(truth)


def test_language_odd_rows(spark):
    train = frame(spark, [("the cat", "en"), ("le chat", "fr"), (None, "fr"), ("x", None)], "text string, lang string")
    docs = frame(spark, [(1, None), (2, ""), (3, "123 —"), (4, "the the"), (5, "chat"), (None, "le"), (5, "chat")], "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred) for r in language.identify(spark, docs, train).collect()]
    assert sorted(got, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "fr"), (5, "fr"), (None, "fr")], key=str)
    assert {r.lang_pred for r in language.identify(spark, docs, train.where("false")).collect()} == {"und"}


def test_language_backoff_matches_exact_grams(spark):
    """Every distinct character n-gram has its own count, with more of them than a fixed table could keep apart."""
    rng = random.Random(12)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(2, 9)))
    train = [(" ".join(word(x) for _ in range(8000)), k) for x, k in (("abcdefghijklmnoé", "en"), ("hijklmnopqrstuvß", "fr"))] * 2
    train += [("once once once", "en"), (word("abc"), None)]
    docs = [(i, " ".join(word("abchijkuvwéßжz") for _ in range(rng.randint(1, 4)))) for i in range(200)] + [(900, "жжжж"), (901, "once wzwz")]
    seen = {k: collections.Counter(w for t, y in train if y == k for w in t.split()) for k in ("en", "fr")}
    n_words = len(set().union(*seen.values()))
    grams = lambda w, n: [f" {w} "[k:k + n] for k in range(len(w) + 3 - n)]
    held = {(k, n): collections.Counter() for k in seen for n in range(1, 5)}
    for k, n in held:
        for w, c in seen[k].items():
            for g in grams(w, n):
                held[k, n][g] += c
    distinct = {n: len(set(held["en", n]) | set(held["fr", n])) for n in range(1, 5)}
    assert distinct[4] > 32768

    def value(w, k):
        if sum(c[w] for c in seen.values()) >= 3:
            return np.log((seen[k][w] + 0.5) / (sum(seen[k].values()) + 0.5 * n_words))
        for n in range(4, 0, -1):
            hits = [g for g in grams(w, n) if held["en", n][g] + held["fr", n][g]]
            if hits:
                all_of = sum(held[k, n].values()) + 0.5 * distinct[n]
                return np.mean([np.log((held[k, n][g] + 0.5) / all_of) for g in hits]) + (4 - n) * np.log(0.4)

    want = {}
    for d, t in docs:
        x = {k: sum(value(w, k) for w in t.split()) for k in seen}
        want[d] = max(x, key=x.get), 1 / (1 + np.exp(min(x.values()) - max(x.values())))
    for limit in (None, 0):
        got = language.identify(spark, frame(spark, docs, "doc_id long, text string"), frame(spark, train, "text string, lang string"), limit).collect()
        assert len(got) == len(docs)
        assert all(r.score == pytest.approx(want[r.doc_id][1], abs=1e-4) for r in got)
        assert all(r.lang_pred == want[r.doc_id][0] for r in got if r.score > 0.5001)


def test_segments_match_brute_force():
    def brute(x):
        best = None
        for i in range(len(x)):
            for j in range(i, len(x)):
                t = sum(x[i:j + 1])
                if t > 0 and (best is None or t > best[0] + 1e-9 or abs(t - best[0]) < 1e-9 and j - i < best[2] - best[1]):
                    best = (t, i, j)
        if best is None:
            return []
        t, i, j = best
        return brute(x[:i]) + [(i, j, round(t, 6))] + [(a + j + 1, b + j + 1, c) for a, b, c in brute(x[j + 1:])]

    rng = random.Random(3)
    for _ in range(200):
        x = [rng.choice([-1.0, -1.0, -1.0, 2.3, 1.7, 3.1]) for _ in range(12)]
        at = [i for i, v in enumerate(x) if v > 0]
        assert [(a, b, round(c, 6)) for a, b, c in toxicity.segments(at, [x[i] for i in at], 1.0)] == brute(x)


def test_toxicity_finds_planted_words(spark):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(400):
        w, bad = words(rng, 60).split(), i % 8 == 0
        if bad:
            for k in rng.sample(range(60), 4):
                w[k] = rng.choice(["vile", "rotten"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs += [(900, None), (901, ""), (None, "vile vile vile vile")]
    d, y = frame(spark, docs, "doc_id long, text string"), frame(spark, labels + [(3, None), (None, 1)], "doc_id long, toxic int")
    train = d.where(~common.held_out())
    near, far = (sorted(((r.doc_id, r.score, r.predicted) for r in toxicity.toxic_scores(spark, d, train, y, b).collect()), key=str) for b in (None, 0))
    assert near == far and len(near) == len(docs)
    assert all(p == (1 if i is None or i < 400 and i % 8 == 0 else 0) for i, _, p in near)
    nothing = toxicity.toxic_scores(spark, d, train, y.where("false")).collect()
    assert len(nothing) == len(docs) and all(r.predicted == 0 for r in nothing)


def test_pii_base_spans(spark):
    rng = random.Random(8)
    bits = ["a.b@c.de", "@", "x@y", "+49 (30) 123-456", "+1", "10.0.0.1", "999.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111", "4111111111111112", " ", "é", "-", "jo (at) site (dot) org", "call ", "\n"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 20)))) for i in range(300)] + [(900, None), (901, ""), (None, "a@b.cd"), (0, "9" * 9000)]

    def brute(t):
        sp = [(0, m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        sp += [(1, m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(q) <= 255 for q in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            g = re.sub("[ -]", "", m[0])
            if 16 <= len(g) <= 19 and pii.luhn(g):
                sp.append((2, m.start(), m.end()))
        return sorted(sp + [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= sum(c.isdigit() for c in m[0]) <= 15])

    f = pii.find_personal(spark, frame(spark, rows, "doc_id long, text string"))
    got = collections.Counter((r.doc_id, str([(pii.BASE.index(s.kind), s.start, s.end) for s in r.found if s.kind in pii.BASE])) for r in f.collect())
    assert got == collections.Counter((d, str(brute(t or ""))) for d, t in rows)
    assert {r.text for r in pii.redact(f).where("doc_id is null").collect()} == {"[email]"}


def test_pii_thresholds_by_kind(spark):
    """Loose kinds are judged by their own held-out candidates: phones without a plus are found, serial numbers and handles are not."""
    rng = random.Random(12)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    phone = lambda: f"({digits(3)}) {digits(3)}-{digits(4)}"
    rows = []
    for i in range(600):
        parts = [f"call +1 {phone()} now", f"serial {digits(9)}", f"order {digits(17)}", f"jo{i}@site{i}.org", "see ops@desk today"]
        rng.shuffle(parts)
        rows.append((i, " and ".join(parts)))
    model, least = pii.fit(frame(spark, rows, "doc_id long, text string"))
    assert least[4] <= 1 and least[5] <= 1 and least[6] > 1  # a sixteen-digit number passes the card check by chance only
    found = lambda t: [(pii.KINDS[k], t[a:b]) for k, a, b in pii.spans_of(t, model, least)]
    assert found("call (555) 123-4567 now") == [("more_phone", "(555) 123-4567")]
    assert found("serial 123456789, order 12345678901234567, ops@desk") == []
    assert found("jo7 (at) site7 (dot) org") == [("more_email", "jo7 (at) site7 (dot) org")]
    x, y = zip(*[(k, y) for k, _, _, y in pii.labelled(rows[0][1])])
    assert sorted(zip(x, y))[:4] == [(4, False), (4, True), (5, False), (5, True)]
    rng = np.random.default_rng(3)
    p, truth = rng.random(5000), rng.random(5000)
    t = pii.threshold(p, (truth < p ** 0.1))
    assert t <= 0.99 and (truth < p ** 0.1)[p >= t].mean() >= pii.PRECISION
    assert pii.threshold(p[:10], np.ones(10)) > 1 and pii.threshold(p, np.zeros(5000)) > 1


def test_pii_learns_from_every_candidate(spark):
    """Two texts whose telephone numbers follow many others of their kind: all are learned from, and all held-out ones set the threshold."""
    texts = " and ".join([f"serial {100000000 + i}" for i in range(40)] + [f"call +1 (555) 123-{1000 + i} now" for i in range(40)])
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 0)
    seen = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5)
    docs = frame(spark, [(held, texts), (seen, texts), (None, None)], "doc_id long, text string")
    model, least = pii.fit(docs)
    assert least[5] <= 1 and least[4] > 1 and least[6] > 1
    plain = "call 1 (555) 987-6543 now and serial 123456789"
    assert [(k, plain[a:b]) for k, a, b in pii.spans_of(plain, model, least)] == [(5, "1 (555) 987-6543")]


def test_pii_cells_count_every_candidate(spark, monkeypatch):
    monkeypatch.setattr(pii, "ROWS", 3)  # candidates leave a task in more than one batch
    rng = random.Random(4)
    bits = ["a@b.cd", "x@y", "+1 (555) 123-4567", "(555) 123-4567", "4111 1111 1111 1111", "123456789", "é", "call"]
    rows = [(i, " , ".join(rng.choices(bits, k=rng.randint(0, 30)))) for i in range(60)] + [(None, "x@y"), (7, None), (3, "x@y, 123456789")]
    want = collections.Counter()
    for d, t in rows:
        out = d is None or zlib.crc32(str(d).encode()) % 5 == 0
        want.update((tuple(pii.features(t, k, a, b)), y, out) for k, a, b, y in pii.labelled(t or ""))
    got = pii.cells_of(frame(spark, rows, "doc_id long, text string")).collect()
    assert len(got) == len(want) and {(tuple(map(float, r.x)), r.y, r.held): r.n for r in got} == want


def test_trees_of_a_table_are_those_of_arrays(spark):
    """Counted rows, in any order and partitions, give the trees of the rows themselves."""
    rng = np.random.default_rng(6)
    x = np.stack([rng.integers(0, 30, 3000), rng.integers(0, 9, 3000), rng.integers(0, 2, 3000)], 1)
    y = ((x[:, 0] > 12) ^ (x[:, 1] > 3)) & (rng.random(3000) > 0.1)
    cells = collections.Counter((tuple(map(int, r)), bool(t)) for r, t in zip(x, y))
    table = frame(spark, [(list(r), t, n) for (r, t), n in cells.items()], "x array<smallint>, y boolean, n long")
    one, many = (trees.boost_table(table.repartition(k), rounds=3) for k in (1, 7))
    assert one == many and len(one) == 4
    assert np.abs(trees.boosted(one, x) - trees.boosted(trees.boost(x, y.astype(float), rounds=3), x)).max() < 1e-4
    assert trees.boost_table(table.where("false")) == trees.boost(x[:0], y[:0])
    same = trees.boost_table(table.select("x", F.lit(True).alias("y"), "n"), rounds=2)
    assert trees.boosted(same, x).min() > 0.99


def test_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.random((400, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    assert ((trees.predict(trees.grow(x, y, np.ones(400), 6, 1), x) >= 0.5) == y).mean() > 0.97
    assert ((trees.boosted(trees.boost(x, y), x) >= 0.5) == y).mean() > 0.97


def test_line_dedup_matches_brute_force(spark):
    rng = random.Random(9)
    long, block = words(rng, 60), "\n".join(words(rng, 12) for _ in range(9))
    docs = []
    for i in range(40):
        lines = [words(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 8))]
        if i % 3 == 0:
            lines.insert(rng.randint(0, len(lines)), long)
        if i % 4 == 0:
            lines.insert(rng.randint(0, len(lines)), block)
        docs.append((i, "\n".join(lines)))
    docs += [(100, None), (101, ""), (102, "\n\n"), (103, "same line"), (104, "same line")]
    cut = line_dedup.dedup_lines(spark, frame(spark, [(d, t, 7) for d, t in docs], "doc_id long, text string, n_removed long"))
    got = {r.doc_id: r.text for r in cut.collect()}
    count = collections.Counter(c for _, t in docs for c, k in line_dedup.chunks(t or "") if k)
    seen = set()
    for d, t in docs:
        left = []
        for c, k in line_dedup.chunks(t or ""):
            if not (k and count[c] > 1 and c in seen):
                left.append(c)
            seen.add(c)
        assert got[d] == (None if t is None else "\n".join(left))
    assert sum(long in (t or "") for t in got.values()) == 1
    assert all("\n".join(c for c, _ in line_dedup.chunks(t or "")) == (t or "") for _, t in docs)
    assert line_dedup.dedup_lines(spark, frame(spark, [], "doc_id long, text string")).count() == 0


def passages_cut(docs):
    """Brute force: the lines of a passage (two lines and 20 words, or one line of 50) that occurs earlier go."""
    seen, out = set(), []
    for t in docs:
        lines = t.split("\n")
        spans = [(i, j) for i in range(len(lines)) for j in range(i, len(lines)) if lines[i].strip() and lines[j].strip()
                 and (n := len(" ".join(lines[i:j + 1]).split())) >= (50 if i == j else 20)]
        gone = set()
        for i, j in spans:  # in order of their first lines
            x = "\n".join(lines[i:j + 1])
            if x in seen:
                gone.update(range(i, j + 1))
            seen.add(x)
        out.append("\n".join(x for k, x in enumerate(lines) if k not in gone))
    return out


@pytest.mark.parametrize("hash_bits", [64, 6])
def test_line_dedup_of_short_lines(spark, hash_bits):
    """Repeated passages of 2 to 10 lines of 5 to 30 words, blank lines in some, whole at every place; short lines stay."""
    rng = random.Random(11)
    passages = [[words(rng, -(-60 // n)) for _ in range(n)] for n in range(2, 11) for _ in range(3)]
    passages += [[words(rng, 15), "", words(rng, 15)], [words(rng, 60), words(rng, 4)], [words(rng, 7)] * 6]
    docs = []
    for i in range(60):
        blocks = [[words(rng, rng.randint(1, 12))] for _ in range(rng.randint(0, 3))] + [["read more"]]
        for p in rng.sample(passages, 3):
            p = p if rng.random() < 0.7 else p[rng.randint(0, 1):]
            blocks.insert(rng.randint(0, len(blocks)), p)
        docs.append("\n".join(itertools.chain(*blocks)))
    docs += ["read more"] * 2
    got = line_dedup.dedup_lines(spark, frame(spark, list(enumerate(docs)), "doc_id long, text string"), hash_bits).collect()
    assert [r.text for r in sorted(got, key=lambda r: r.doc_id)] == passages_cut(docs)
    for p in passages[:27]:
        assert sum("\n".join(p) in r.text for r in got) <= 1
    assert [r.text for r in got if r.doc_id >= 60] == ["read more"] * 2


def test_targets():
    assert mixing.targets([100, 100, 100], [3, 1, 2]) == pytest.approx([200, 250 / 3, 500 / 3])
    assert mixing.targets([0, 10], [3, 1]) == pytest.approx([0, 15])
    assert mixing.targets([], []) == []


def test_permutation_and_shards():
    for n in (1, 2, 5, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 3).tolist()) == list(range(n))
    counts = np.array([700, 3, 0, 297])
    parts = [mixing.shard_counts(counts, k, 8, 128, 1) for k in range(8)]
    assert (sum(p[1] for p in parts) == counts).all() and all(p[1].sum() <= 128 for p in parts)
    assert all((parts[k][0] + parts[k][1] == parts[k + 1][0]).all() for k in range(7))
    big = np.array([3, 2]) * 10 ** 9
    assert sum(mixing.shard_counts(big, k, 4, 1_250_000_000, 1)[1].sum() for k in range(4)) == 5 * 10 ** 9


def test_draws_beyond_the_library_limit(monkeypatch):
    """Many independent draws have the mean and spread of the hypergeometric law; huge totals are exact in sum, drawn and repeatable."""
    counts = np.array([30, 5, 0, 65])
    plain = np.array([mixing.halved(counts, 40, [1, k]) for k in range(4000)])
    monkeypatch.setattr(mixing, "DRAWN", 50)
    many = np.array([mixing.halved(counts, 40, [2, k]) for k in range(4000)])
    for got in (plain, many):
        assert (got.sum(1) == 40).all() and (got >= 0).all() and (got <= counts).all()
        assert np.abs(got.mean(0) - 0.4 * counts).max() < 0.25
        share = counts / 100
        assert np.abs(got.var(0) / np.maximum(40 * share * (1 - share) * 60 / 99, 1e-9) - 1)[[0, 1, 3]].max() < 0.15
    huge = np.array([7 * 10**10, 0, 10**10, 3])
    a, b, c = (mixing.halved(huge, 4 * 10**10, [k]) for k in (1, 1, 2))
    assert a.sum() == c.sum() == 4 * 10**10 and (a == b).all() and (a != c).any() and (a <= huge).all()
    assert abs(a[0] - 3.5 * 10**10) < 10**7
    parts = [mixing.shard_counts(huge, k, 1 << 24, 4768, 7)[1] for k in (0, 1, (1 << 24) - 1)]
    assert [int(p.sum()) for p in parts[:2]] == [4768, 4768] and (parts[0] != parts[1]).any()


def test_mix_near_targets(spark):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    got = queries.QUERIES["op8_multinomial_mix"](spark, "/root/testdata/sf0.01").toPandas()
    assert (got.taken <= 2 * got["size"]).all() and len(got) == docs.count()
    by = got.merge(docs.select("doc_id", "source").toPandas(), on="doc_id").groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by.taken / by.target - 1).abs() < 0.02).all()
    out = mixing.mixed(spark, docs).toPandas()
    assert sum(len(t.split()) for t in out.text) == got.taken.sum()


def test_mix_of_many_runs(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "source")
    m = mixing.mix(spark, docs, 16, run_words=1000)
    assert m.runs.count() > 2 * m.sources.count()
    slots = m.slots.toPandas()
    out = mixing.mixed(spark, docs, 16, run_words=1000).toPandas()
    assert len(out) == len(slots) and not out.duplicated(["shard", "slot"]).any()
    assert sorted(zip(out.shard, out.slot, out.block)) == sorted(zip(slots.shard, slots.slot, slots.block))
    # brute force: the streams cut into blocks
    text = {r.doc_id: (r.text or "").split() for r in docs.collect()}
    blocks = {}
    for r in sorted(mixing.streams(m).where("size > 0").collect(), key=lambda r: r.start):
        for w, word in enumerate(text[r.doc_id], r.start):
            blocks.setdefault((r.source, w // 16), []).append(word)
    assert all(t.split() == blocks[s, b] for s, b, t in zip(out.source, out.block, out.text))
    by_doc = {r.doc_id: (r.taken, r["size"]) for r in mixing.taken(m).collect()}
    assert sum(t for t, _ in by_doc.values()) == sum(len(t.split()) for t in out.text)
    assert all(t <= 2 * n for t, n in by_doc.values())


def test_mix_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "x y z", None), (4, "x y z", "b"), (4, "x y z", "b"), (None, "q r", "a")]
    d = frame(spark, rows, "doc_id long, text string, source string")
    m = mixing.mix(spark, d, 2)
    got = mixing.taken(m).collect()
    assert len(got) == 6 and all(r.taken <= 2 * r["size"] for r in got)
    assert mixing.mixed(spark, d, 2).count() == m.slots.count()
    assert mixing.mixed(spark, d.where("false"), 2).count() == 0
    empty = mixing.mix(spark, d.where("false"), 2)
    assert mixing.taken(empty).count() == 0


def test_containment_matches_brute_force(spark):
    rng = random.Random(10)
    items = [(i, words(rng, rng.choice([2, 4, 9, 20, 60, 200]))) for i in range(60)] + [(90, None), (91, ""), (None, "a b c"), (5, words(rng, 30))]
    docs = []
    for i in range(80):
        body = words(rng, rng.choice([3, 40, 3000])).split()
        w = (items[i % 60][1] or "").upper().split()
        if i % 5 == 0 and len(w) > 15:
            w[len(w) // 2] = "other"
        at = rng.randint(0, len(body))
        docs.append((i, " ".join(body[:at] + w + body[at:])))
    docs += [(i + 200, items[i][1]) for i in range(10)] + [(300, None), (301, ""), (None, items[3][1])]
    got = {(r.doc_id, r.item_id, r.held, r.item_shingles) for r in decontaminate.contained(
        spark, frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string")).collect()}
    want = set()
    for d, t in docs:
        own = shingles(t)
        for i, x in items:
            s = shingles(x)
            if i is not None and s and len(own & s) >= 0.8 * len(s):
                want.add((d, i, len(own & s), len(s)))
    assert got == want


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<p></p>", ""),
    ("<nav><a>x</a></nav><article><h1>A &amp; B &lt;i&gt;</h1><p>One<br>two  <b>th</b>ree<p>Last&nbsp;one</article><div class='ad'>Buy</div><footer>f</footer>", "A & B <i> One two three Last one"),
    ("<body><header><p>Site</p></header><main><p>Story.</p><form>Mail <input></form><script>x<p>y</p></script><style>p{}</style><!-- no --><section id='comments'><p>Nice story it is</p></section></main><aside>more</aside>", "Story."),
    ("<div class='cookie-notice'>We use cookies</div><div id='content'><p>Text</p><div class='sidebar'>side</div><p>End</p></div>", "Text End"),
])
def test_main_text(html, text):
    assert html_text.main_text(html, html_text.train()) == text


LONG = " ".join(["The river rose again that night and the town moved its boats to higher ground,"] * 2)
MORE = "Nobody in the valley had seen water at that height before the old mill was built in the north."


@pytest.mark.parametrize("html, text", [
    # advertising and hidden text inside an article, by the attributes of any tag
    (f"<article><p>{LONG}<p class='advert'>Buy now</p><p>{MORE}</p></article>", f"{LONG} {MORE}"),
    (f"<article><p hidden>secret<p>{LONG}</p></article>", LONG),
    (f"<article><p style='display: none'>secret</p><p>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG} <span class='ad'>Buy <span>now</span></span> {MORE}</p></article>", f"{LONG} {MORE}"),
    (f"<article><div hidden><div>a</div><p>b</p></div><p>{LONG}</p></article>", LONG),
    (f"<article><p>one <i aria-hidden='true'>icon</i> two</p></article>", "one two"),
    # names that hold a word of furniture, but are none
    (f"<article><div class='entry-header'><h1>Flood</h1></div><p>{LONG}</p></article>", f"Flood {LONG}"),
    (f"<article><div class='article-header'><p>{LONG}</p><p>{MORE}</p></div></article>", f"{LONG} {MORE}"),
    (f"<article><div class='story-side'><p>{LONG}</p></div></article>", LONG),
    (f"<article><section id='search-and-rescue'><p>{LONG}</p><p>{MORE}</p></section></article>", f"{LONG} {MORE}"),
    (f"<article class='legal'><p>{LONG}</p><p>{MORE}</p></article>", f"{LONG} {MORE}"),
    (f"<div class='content-sidebar-wrap'><article><p>{LONG}</p></article><div class='sidebar'><p>{MORE}</p></div></div>", LONG),
    (f"<div class='no-sidebar'><div class='post'><p>{LONG}</p></div></div>", LONG),
    # names that are furniture
    (f"<article><p>{LONG}</p><div class='comment-list'><article class='comment'><p>{MORE}</p></article></div></article>", LONG),
    (f"<article><p>{LONG}</p></article><section class='comments'><p>{MORE}</p></section>", LONG),
    (f"<article><p>{LONG}</p><div id='relatedPosts'><a>One</a> <a>Two</a></div></article>", LONG),
    (f"<div class='main-menu'><a>Home</a> <a>News</a></div><main><p>{LONG}</p></main><div class='site-footer'>2024 Some paper</div>", LONG),
    (f"<div role='banner'>Paper</div><div role='main'><p>{LONG}</p></div><div role='contentinfo'>Address</div>", LONG),
    # pages without an article
    (LONG, LONG), ("Short note.", "Short note."), (f"a &lt; b &#233;", "a < b é"),
    (f"<p>{LONG}<p>Why?<p>{MORE}", f"{LONG} Why? {MORE}"),
    (f"<body><div><a>Home</a> <a>News</a> <a>Sport</a> <a>Contact us</a></div><h1>Flood in town</h1><p>{LONG}</p><p>{MORE}</p><p>{LONG}</p><div><a>Next</a> <a>More of this</a></div></body>",
     f"Flood in town {LONG} {MORE} {LONG}"),
    (f"<table><tr><td class='menu'><a>Home</a></td><td><p>{LONG}</p><p>{MORE}</p></td></tr></table>", f"{LONG} {MORE}"),
    # tags left open, or closed without a start
    (f"<html><head><title>T</title><meta charset=x><p>{LONG}</p>", LONG),
    (f"<article><p>{LONG}</p><iframe src=x><p>{MORE}</p></article>", f"{LONG} {MORE}"),
    (f"<article></section></p></b><p>{LONG}</article>", LONG),
    (f"<article><ul><li>one<li>two</ul><h2>Sub<p>{LONG}</article><p>{MORE}</p>", f"one two Sub {LONG}"),
    (f"<article><p>{LONG}</p><svg><title>icon</title><svg></svg></svg><noscript>Turn it on</noscript><script>var p = '<p>x</p>';</script></article>", LONG),
    (f"<article><p>{LONG}</p><!-- <p>old</p> --><template><p>t</p></template><p>{MORE}</p></article>", f"{LONG} {MORE}"),
])
def test_main_text_of_other_layouts(html, text):
    assert html_text.main_text(html, html_text.train()) == text


def test_tree_splits_on_words_and_neighbours():
    def used(t):
        return set() if len(t) == 1 else {html_text.FEATURES[t[0]]} | used(t[2]) | used(t[3])

    assert {"words", "links", "words before", "links before"} <= used(html_text.train())


@pytest.mark.parametrize("html", ["<div>" * 100_000 + "x" + "</p>" * 100_000, "<div>x" * 100_000 + "</section>" * 100_000, "<svg>" * 100_000 + "</object>" * 100_000 + "</svg>" * 100_000,
                                  "<p hidden>" * 100_000, "<a>" * 200_000 + "x", "<span class=ad>" * 100_000 + "</b>" * 100_000, "<p>" + "x " * 500_000, "<li>" * 200_000, "<" * 300_000])
def test_main_text_is_linear(html):
    began = time.monotonic()
    html_text.main_text(html, html_text.train())
    assert time.monotonic() - began < 15


def test_pages(spark):
    import html as h
    got = {r.page_id: r.text for r in queries.QUERIES["op1_block_tree_text"](spark, SF).collect()}
    for r in common.table(spark, SF, "pages").collect():
        inner = re.search(r"(?s)<article>(.*?)</article>", r.html)[1]
        parts = [" ".join(h.unescape(re.sub("<[^>]+>", "", re.sub("<br>", " ", x))).split()) for x in re.split("</?(?:h1|p)>", inner)]
        assert got[r.page_id] == " ".join(x for x in parts if x)


@pytest.mark.parametrize("name", ["op2_setsketch_near_dup", "op10_minhash_containment"])
def test_sql_twins(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(queries.SQL[name]).df()
    got = queries.QUERIES[name](spark, SF).toPandas()[list(want.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))


def test_pipeline(spark):
    import corpus_pipeline as p
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    before = docs.columns
    held = {}
    for name, stage in p.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, "/root/testdata/sf0.01"), "test-pipeline")
        assert docs.columns == before
        held[name] = {r.doc_id: r.text for r in docs.collect()}
    sets = {d: shingles(t) for d, t in held["line_dedup"].items()}
    label = reachable(dict(sorted(sets.items())), 80)
    assert set(held["near_dedup"]) == {d for d in label if label[d] == d}
    items = [shingles(r.text) for r in common.table(spark, "/root/testdata/sf0.01", "benchmark").collect()]
    clean = {d for d, t in held["near_dedup"].items() if not any(len(shingles(t) & s) >= 0.8 * len(s) for s in items)}
    assert set(held["decontamination"]) == clean
    out = p.run(spark, "/root/testdata/sf0.01").collect()
    assert {d for r in out for d in r.doc_ids} <= clean and out


def test_pipeline_decides_by_row(spark):
    """Rows without an id stay if they pass; a bad row takes no other row of its id with it; of identical rows one stays."""
    import corpus_pipeline as p
    sf = "/root/testdata/sf0.01"
    table = common.table(spark, sf, "documents")
    good = [r for r in table.where(~common.held_out()).orderBy("doc_id").limit(40).collect()]
    texts = [r.text.split("\n")[0] for r in good]
    item = common.table(spark, sf, "benchmark").orderBy("item_id").first().text

    def table_of(rows):
        return frame(spark, [{**good[0].asDict(), "doc_id": i, "text": t} for i, t in rows], table.schema)

    docs = table_of([(None, texts[0]), (None, texts[1]), (None, "123"), (1, texts[2]), (1, "456")]).union(table.where(~common.held_out()).limit(300))
    kept = [(r.doc_id, r.text) for r in p.identify_language(spark, docs, sf).collect()]
    assert {(None, texts[0]), (None, texts[1]), (1, texts[2])} <= set(kept) and not {"123", "456"} & {t for _, t in kept}
    far = ["a b c d e f g h", "k l m n o p q r", "s t u v w x y z"]
    docs = table_of([(5, far[0]), (5, far[0]), (5, far[1]), (3, far[1]), (None, far[1]), (None, far[2]), (None, far[2]), (8, None), (8, None)])
    kept = [(r.doc_id, r.text) for r in p.drop_near_duplicates(spark, docs, sf).collect()]
    assert sorted(kept, key=str) == sorted([(5, far[0]), (3, far[1]), (None, far[2]), (8, None), (8, None)], key=str)
    docs = table_of([(7, item), (7, far[0]), (None, item), (None, far[1])])
    assert {(r.doc_id, r.text) for r in p.drop_contaminated(spark, docs, sf).collect()} == {(7, far[0]), (None, far[1])}


def test_pipeline_stages_keep_odd_columns(spark):
    """Maps and columns that share a name with a key come back as they were; of equal rows one stays."""
    import corpus_pipeline as p
    rng = random.Random(11)
    texts = [words(rng, 60) for _ in range(4)]
    rows = [(i, t, "en", {"a": i}, f"k{i}") for i, t in enumerate(texts)] + [(2, texts[2], "en", {"a": 2}, "k2"), (None, texts[3], "en", {"a": 9}, "k9"), (9, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, m map<string,int>, _row_key string")
    out = p.drop_near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted((r.doc_id, r.m["a"] if r.m else None, r._row_key) for r in out.collect())
    assert got == [(0, 0, "k0"), (1, 1, "k1"), (2, 2, "k2"), (3, 3, "k3"), (9, None, None)]
    assert p.drop_contaminated(spark, docs, SF).columns == docs.columns
    assert p.drop_near_duplicates(spark, docs.where("false"), SF).count() == 0
