"""Mixing sources to target weights.

Each source's words, in a fixed order of its documents, form one stream that
is packed into blocks of ``block`` words.  A stream is a sequence of runs of
about ``RUN_WORDS`` words, each of which begins a new block, so that one task
packs a run without the others; a run's last block may be short.  A source's
target sets how many output slots it fills.  Slots are dealt to output shards
by multinomial draws given the sources' totals: the shards are halved again
and again, and each half draws its counts from its parent's, so any shard
finds its own draws and where they begin without the others, and the totals
come out exact.  The j-th slot of a source maps to a block through the
source's pseudorandom permutation (a new one for each round through the
source), and slots and blocks are joined by source and block index: slots find
the run that holds their block, and meet its documents there, so the texts are
shuffled once.

The list of sources is a parameter of a mixture: it is held by the driver and
every task, and more than ``MOST_SOURCES`` are refused.  Documents, blocks and
slots are never held whole by anyone.

A null text has size 0, and sizes of 0 are never taken.  A null source is a
source of its own.  Rows that repeat a doc_id are documents of their own; rows
that repeat id, text and source fall into one run, which grows with them.  An
empty table gives an empty mix.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

WEIGHTS = (3, 1, 2)
SHARE, MOST_TIMES = 1.5, 2
MOST_SOURCES = 100_000
#: Words of a run on average; a run holds one document at least.
RUN_WORDS = 1 << 21
SHARD = 4096
#: numpy draws from at most so many slots at once; from more, they are drawn slot by slot independently and then evened out.
DRAWN = 500_000_000


def targets(sizes: list[int], weights: list[float], share: float = SHARE, most: float = MOST_TIMES) -> list[float]:
    """``share`` of all sizes, by weight; no target over ``most`` times its size, the excess reshared."""
    target, rest, open_ = [0.0] * len(sizes), share * sum(sizes), [i for i, x in enumerate(sizes) if x]
    while open_:
        level = rest / sum(weights[i] for i in open_)
        over = [i for i in open_ if level * weights[i] > most * sizes[i]]
        if not over:
            for i in open_:
                target[i] = level * weights[i]
            break
        for i in over:
            target[i] = float(most * sizes[i])
            rest -= target[i]
        open_ = [i for i in open_ if i not in set(over)]
    return target


def picked(counts: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each source are among ``n`` slots drawn without replacement, in memory of ``n``."""
    ends, chosen = np.cumsum(counts), np.empty(0, np.int64)
    while len(chosen) < n:
        chosen = np.unique(np.r_[chosen, rng.integers(0, ends[-1], n - len(chosen))])
    return np.bincount(np.searchsorted(ends, chosen, "right"), minlength=len(counts))


def halved(counts: np.ndarray, left: int, seed: list[int]) -> np.ndarray:
    """How many of each source's slots are among the first ``left``, drawn without replacement.

    Beyond ``DRAWN`` slots each one is taken independently, which is a binomial
    draw for a source, and as many as are over (or short) are given back (or
    added) at random.  Every choice of ``left`` slots stays equally likely, and
    what is evened out is about the square root of the slots.
    """
    rng, total = np.random.default_rng(seed), int(counts.sum())
    if total <= DRAWN:
        return rng.multivariate_hypergeometric(counts, left, method="marginals")
    got = rng.binomial(counts, left / total)
    over = int(got.sum()) - left
    return got - picked(got, over, rng) if over > 0 else got + picked(counts - got, -over, rng)


def shard_counts(counts: np.ndarray, shard: int, shards: int, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(first slot, number of slots) of each source in ``shard``."""
    first, low, high, total = np.zeros_like(counts), 0, shards, int(counts.sum())
    while high - low > 1:
        middle = (low + high) // 2
        left = halved(counts, min(total, middle * size) - low * size, [seed, low, high])
        if shard < middle:
            counts, high = left, middle
        else:
            first, counts, low = first + left, counts - left, middle
    return first, counts


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of range(n): Feistel rounds, walked until inside."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for r in range(4):
            left, right = right, left ^ (C.mix(right + np.uint64((key * 4 + r + 1) * C.PRIME % (1 << 64))) & mask)
        return (left << np.uint64(half)) | right

    x = once(index.astype(np.uint64))
    while (out := x >= n).any():
        x[out] = once(x[out])
    return x.astype(np.int64)


@dataclass
class Mix:
    """``placed``: doc_id, h (hash of the text), source, source_id, size, run; ``runs``: source_id, run, base (its
    first block), blocks; ``sources``: source_id, source, source_size, target, runs; ``slots``: shard, slot, source_id, block."""

    placed: DataFrame
    runs: DataFrame
    sources: DataFrame
    slots: DataFrame
    block: int
    run_words: int


def _placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows(doc_id, h, source, …)`` with source_id and run."""
    few = F.broadcast(sources.select("source_id", F.col("source").alias("s"), "runs"))
    return (rows.join(few, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("run", F.pmod(F.xxhash64("doc_id", "h"), F.col("runs"))).drop("s", "runs"))


def _own() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("h"),
            F.col("source").cast("string").alias("source")]


def mix(spark: SparkSession, docs: DataFrame, block: int = 64, weights: tuple = WEIGHTS, share: float = SHARE,
        most: float = MOST_TIMES, shard: int = SHARD, seed: int = 7, run_words: int = RUN_WORDS) -> Mix:
    """Plan the mix of ``docs(doc_id, text, source)``."""
    rows = C.stored(docs.select(*_own(), F.greatest(F.lit(0), F.coalesce(
        F.size(F.regexp_extract_all("text", F.lit(C.WORD), F.lit(0))), F.lit(0))).cast("long").alias("size")), "mix-sizes")
    found = rows.groupBy("source").agg(F.sum("size").alias("words")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"a mixture has at most {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    words = [r["words"] for r in found]
    target = targets(words, [weights[i % len(weights)] for i in range(len(found))], share, most)
    sources = spark.createDataFrame([(i, r["source"], w, t, max(1, -(-w // run_words))) for i, (r, w, t) in enumerate(zip(found, words, target))],
                                    "source_id int, source string, source_size long, target double, runs long")
    placed = _placed(rows, sources)
    before = Window.partitionBy("source_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = C.stored(placed.groupBy("source_id", "run").agg(F.ceil(F.sum("size") / block).cast("long").alias("blocks"))
                    .withColumn("base", F.coalesce(F.sum("blocks").over(before), F.lit(0))), "mix-runs")

    n_blocks = np.zeros(len(words), np.int64)
    for r in runs.groupBy("source_id").agg(F.sum("blocks").alias("n")).collect():  # a row for each source
        n_blocks[r["source_id"]] = r["n"]
    n_slots = np.array([min(round(t * b / w), most * b) if 0 < t < most * w else most * b for t, w, b in zip(target, words, n_blocks.tolist())], np.int64)
    shards = max(1, -(-int(n_slots.sum()) // shard))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for k in f["id"]:
                first, n = shard_counts(n_slots, int(k), shards, shard, seed)
                who = np.repeat(np.arange(len(n)), n)
                at = np.zeros(len(who), np.int64)
                for s in np.flatnonzero(n):
                    j = np.arange(first[s], first[s] + n[s])
                    for turn in np.unique(j // n_blocks[s]):
                        here = j // n_blocks[s] == turn
                        at[np.flatnonzero(who == s)[here]] = permuted(j[here] % n_blocks[s], int(n_blocks[s]), seed * 1_000_003 + int(s) * 101 + int(turn))
                order = np.random.default_rng([seed, int(k), 1]).permutation(len(who))
                yield pd.DataFrame({"shard": int(k), "slot": np.arange(len(who)), "source_id": who[order].astype(np.int32), "block": at[order]})

    slots = spark.range(shards).mapInPandas(deal, "shard long, slot long, source_id int, block long")
    return Mix(placed, runs, sources, slots, block, run_words)


def streams(m: Mix) -> DataFrame:
    """The placed rows with ``start``, the document's offset in its source's stream (runs begin at whole blocks)."""
    inside = Window.partitionBy("source_id", "run").orderBy("doc_id", "size", "h").rowsBetween(Window.unboundedPreceding, -1)
    return (m.placed.withColumn("start", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(m.runs, ["source_id", "run"])
            .withColumn("start", F.col("start") + F.col("base") * m.block).drop("run", "base", "blocks", "h"))


def taken(m: Mix) -> DataFrame:
    """The streams' rows with ``taken``, the words that the mix takes of each, repeats counted."""
    rows = C.stored(streams(m), "mix-streams")
    piece = (rows.where("size > 0").withColumn("block", F.explode(F.expr(f"sequence(start div {m.block}, (start + size - 1) div {m.block})")))
             .select("source_id", "start", "block", F.expr(f"least(start + size, (block + 1) * {m.block}) - greatest(start, block * {m.block})").alias("n")))
    # merged: the plan takes the slots for as small as the range of shards that they are dealt from, and would broadcast them
    times = m.slots.groupBy("source_id", "block").agg(F.count("*").alias("times")).hint("merge")
    # a nonempty document's start is unique in its source
    took = piece.join(times, ["source_id", "block"]).groupBy("source_id", "start").agg(F.sum(F.col("n") * F.col("times")).alias("t"))
    empty = rows.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (rows.where("size > 0").join(took, ["source_id", "start"], "left").withColumn("taken", F.coalesce("t", F.lit(0).cast("long"))).drop("t")
            .unionByName(empty))


def packed(texts: pa.Table, wanted: np.ndarray, block: int) -> dict[int, tuple[list, str]]:
    """The ``wanted`` blocks (doc_ids, text) of a run of documents ``texts(doc_id, h, text)``, by place in the run."""
    found = []  # of each document: order, bytes, where its words begin and end
    at_row = 0
    ids, h = texts["doc_id"].to_pylist(), texts["h"].to_pylist()
    for chunk in texts["text"].chunks:
        for i, j, data, at in C.pieces(chunk):
            row, a, b = C.words(data, at)
            cut = np.searchsorted(row, np.arange(j - i + 1))
            for k in range(j - i):
                who = at_row + i + k
                x, y = cut[k], cut[k + 1]
                if x < y:
                    found.append(((ids[who] is not None, ids[who] or 0, int(y - x), h[who]), data, a[x:y], b[x:y]))
        at_row += len(chunk)
    found.sort(key=lambda f: f[0])
    open_, out, start = set(wanted.tolist()), {}, 0
    for (known, doc, n, _), data, a, b in found:
        for k in range(start // block, (start + n - 1) // block + 1):
            if k in open_:
                x, y = max(0, k * block - start), min(n, (k + 1) * block - start)
                docs, parts = out.setdefault(k, ([], []))
                docs.append(doc if known else None)
                parts.append(data[a[x]:b[y - 1]].tobytes())
        start += n
    return {k: (docs, b"\n".join(parts).decode()) for k, (docs, parts) in out.items()}


def mixed(spark: SparkSession, docs: DataFrame, block: int = 64, **options) -> DataFrame:
    """shard, slot, source, block, doc_ids, text: the mix itself, a row for each slot."""
    m = mix(spark, docs, block, **options)
    texts = _placed(docs.where("text is not null").select(*_own(), F.col("text").cast("string").alias("text")), m.sources).drop("source")
    # the run that holds a slot's block: both meet in cells of as many blocks as a run has on average
    cell = max(1, m.run_words // block)
    homes = m.runs.where("blocks > 0").withColumn("cell", F.explode(F.expr(f"sequence(base div {cell}, (base + blocks - 1) div {cell})")))
    slots = (m.slots.withColumn("cell", F.expr(f"block div {cell}")).hint("merge").join(C.small(homes, 40), ["source_id", "cell"])
             .where("block between base and base + blocks - 1").select("source_id", "run", "base", "shard", "slot", "block"))
    kinds = pa.schema([("shard", pa.int64()), ("slot", pa.int64()), ("source_id", pa.int32()), ("block", pa.int64()),
                       ("doc_ids", pa.list_(pa.int64())), ("text", pa.string())])

    def fill(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return kinds.empty_table()
        place = right["block"].to_numpy() - right["base"].to_numpy()
        wanted, which = np.unique(place, return_inverse=True)
        got = packed(left, wanted, block)
        ids = pa.array([got[k][0] for k in wanted.tolist()], kinds.field("doc_ids").type)
        text = pa.array([got[k][1] for k in wanted.tolist()], pa.string())
        which = pa.array(which)
        return pa.Table.from_arrays([right["shard"], right["slot"], right["source_id"], right["block"], ids.take(which), text.take(which)], schema=kinds)

    filled = texts.groupBy("source_id", "run").cogroup(slots.groupBy("source_id", "run")).applyInArrow(
        fill, "shard long, slot long, source_id int, block long, doc_ids array<long>, text string")
    return (filled.join(F.broadcast(m.sources.select("source_id", "source")), "source_id")
            .select("shard", "slot", "source", "block", "doc_ids", "text"))


def op8_multinomial_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of 150% of all ``documents`` takes of each."""
    m = mix(spark, C.table(spark, sf_dir, "documents"))
    return taken(m).join(F.broadcast(m.sources.select("source_id", "source_size", "target")), "source_id").select(
        "doc_id", "size", "source_size", "target", "taken")
