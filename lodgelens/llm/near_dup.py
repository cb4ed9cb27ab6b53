"""Near-duplicate documents by SetSketch registers.

Every distinct word shingle draws exponentially spaced values, one in each of
the intervals that split the unit exponential into equal masses; a register
keeps the least value that reaches it, truncated to an integer on a
logarithmic scale.  The registers of a union are the register-wise maxima of
the parts, and two registers agree about as often as the sets' Jaccard
similarity, so bands of registers are hashed into buckets.  A bucket's pairs
are estimated jointly, by the likelihood of how many registers are greater,
equal and less given both exact set sizes, and what survives is confirmed on
the full shingle sets.

Documents with equal sets collapse into one class before any pair is formed.
Pairs are formed between classes only, which have numbers of their own:

* every member of a bucket against the bucket's most central one, by likelihood
  and then on full sets;
* then the members left outside its component against the rest of the bucket
  on full sets, block against block in separate tasks; only links across
  components leave the task.

What holds for a whole bucket (its size, its most central member, how many are
left outside) is a row a bucket, which members meet by ``common.met``, so a
bucket's members are never dealt by the bucket alone.

No bucket is cut.  A null or empty text has no shingles and is linked with
nothing.  Rows that repeat a doc_id are one document: its texts' classes are
linked.  A null doc_id links nothing; its row gets the component of an equal
set that has an id, else a null one.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

REGISTERS = 256
RATE, BASE, TOP = 20.0, 1.001, (1 << 16) - 2
#: Values drawn at once: bounds the kernel's memory where many small sets need all their values.
CELLS = 1 << 20
#: Buckets of up to SMALL classes are compared once for each list of members;
#: larger ones are cut into blocks of about BLOCK classes.
SMALL, BLOCK = 16, 128
#: A pair is dropped when its best similarity at the threshold or above is so
#: many nats less likely than its best similarity: a true link is lost with a
#: probability of about e**-GIVEN_UP.
GIVEN_UP = 14.0


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows): at the threshold, a pair shares no band with p < 3e-6."""
    rows = max(1, int(np.floor(np.log(0.3) / np.log(min(percent, 99) / 100))))
    rows = min(rows, 8)
    return REGISTERS // rows, rows


def registers(row: np.ndarray, element: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """Register values (n x m, uint16) of the sets given as (row, element), sorted by row."""
    least = np.full((n, m), np.inf)
    count = np.bincount(row, minlength=n)
    start, stride = C.mix(element + np.uint64(11)), C.mix(element + np.uint64(23)) | np.uint64(1)
    active, j, width = np.arange(len(row)), 1, 1
    while len(active):
        steps = np.arange(j, min(j + width, m + 1))
        e = element[active][:, None]
        u = (C.mix(e * np.uint64(C.PRIME) + steps.astype(np.uint64)) >> np.uint64(11)) * 2.0 ** -53
        # the j-th value lies in the j-th interval of equal mass 1/m
        x = (-np.log1p(-(steps - 1) / m) - np.log1p(-u / (m - steps + 1))) / RATE
        where = ((start[active][:, None] + stride[active][:, None] * steps.astype(np.uint64)) % np.uint64(m)).astype(np.int64)
        np.minimum.at(least.reshape(-1), (row[active][:, None] * m + where).reshape(-1), x.reshape(-1))
        j += len(steps)
        if j > m:
            break
        # no later value can be under this bound
        open_rows = (least.max(1) > -np.log1p(-(j - 1) / m) / RATE) & (count > 0)
        active = active[open_rows[row[active]]]
        width = max(1, min(width * 2, CELLS // max(len(active), 1)))
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(least) / np.log(BASE))
    return np.clip(np.nan_to_num(k, neginf=0, posinf=TOP + 1), 0, TOP + 1).astype(np.uint16)


def band_keys(regs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None], len(regs), 0)
    for r in range(rows):
        key = C.mix(key * np.uint64(C.PRIME) + regs[:, r * bands:(r + 1) * bands].astype(np.uint64))
    return key.view(np.int64)


def likely(greater: np.ndarray, equal: np.ndarray, less: np.ndarray, na: np.ndarray, nb: np.ndarray, at_least: float) -> np.ndarray:
    """Whether a similarity of ``at_least`` or more is likely enough, jointly with the sizes."""
    grid = np.linspace(0, 1, 101)
    u, v = na / (na + nb), nb / (na + nb)
    top = np.minimum(u / v, v / u)[:, None]
    j = np.minimum(grid[None], top)

    def p(x):
        return -np.log(1 - np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    up = np.maximum(p(u[:, None] - v[:, None] * j), 1e-9)
    down = np.maximum(p(v[:, None] - u[:, None] * j), 1e-9)
    same = np.maximum(1 - up - down, 1e-9)
    fit = greater[:, None] * np.log(up) + less[:, None] * np.log(down) + equal[:, None] * np.log(same)
    over = np.where(j >= np.minimum(at_least, top) - 1e-9, fit, -np.inf)
    return fit.max(1) - over.max(1) <= GIVEN_UP


def fingerprints(row: np.ndarray, sh: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's set."""
    f1, f2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    np.add.at(f1, row, C.mix(sh + np.uint64(1)))
    np.add.at(f2, row, C.mix(sh ^ np.uint64(C.PRIME)))
    return f1, f2


def sketched(docs: DataFrame, bands: int, rows: int, size: int = 5) -> DataFrame:
    """doc_id, n (set size), f1, f2 (fingerprint of the set), regs, bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 1):
            for i, j, data, at in C.pieces(batch.column(1)):
                row, sh = C.shingles(data, at, size)
                n = j - i
                regs = registers(row, sh, n)
                f1, f2 = fingerprints(row, sh, n)
                keys = band_keys(regs, bands, rows)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[i:j], pa.array(np.bincount(row, minlength=n).astype(np.int64)),
                    pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                    pa.FixedSizeListArray.from_arrays(pa.array(keys.reshape(-1)), bands).cast(pa.list_(pa.int64())),
                ], ["doc_id", "n", "f1", "f2", "regs", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, f1 long, f2 long, regs binary, bands array<long>")


def shingle_sets(docs: DataFrame, nodes: DataFrame, size: int = 5) -> DataFrame:
    """node, shingles: the sorted 64-bit hashes of the whole set of each class of ``nodes(node, rep, f1, f2, n)``, packed.

    Taken from the texts of the class's least doc_id, of which the right one is told by the set's fingerprint.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 1):
            for i, j, data, at in C.pieces(batch.column(1)):
                row, sh = C.shingles(data, at, size)
                cut, (f1, f2) = np.searchsorted(row, np.arange(j - i + 1)), fingerprints(row, sh, j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array(np.diff(cut).astype(np.int64)), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                     pa.array([sh[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], ["rep", "n", "f1", "f2", "shingles"])

    ids = nodes.select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.join(C.small(C.stored(ids, "near-ids"), 16), "doc_id", "left_semi").select("doc_id", "text")
    sets = texts.mapInArrow(run, "rep long, n long, f1 long, f2 long, shingles binary")
    return sets.join(C.small(nodes, 48), ["rep", "f1", "f2", "n"]).select("node", "shingles").dropDuplicates(["node"])


def _screen(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose registers make the threshold likely."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(
        f"100 * least(na, nb) >= {percent} * greatest(na, nb)")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                x = np.frombuffer(b"".join(f.ra), np.uint16).reshape(len(f), -1)
                y = np.frombuffer(b"".join(f.rb), np.uint16).reshape(len(f), -1)
                yes = likely((x > y).sum(1), (x == y).sum(1), (x < y).sum(1), f.na.to_numpy(float), f.nb.to_numpy(float), percent / 100)
                yield f.loc[yes, ["a", "b"]]

    return both.select("a", "b", "na", "nb", "ra", "rb").mapInPandas(run, "a long, b long")


def _confirm(pairs: DataFrame, docs: DataFrame, cls: DataFrame, percent: int, size: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold."""
    nodes = C.stored(cls.join(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "node", "left_semi"), "near-nodes")
    sets = C.stored(shingle_sets(docs, nodes, size), "near-sets")
    side = lambda x: sets.select(F.col("node").alias(x), F.col("shingles").alias(f"s{x}"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            keep = np.zeros(len(f), bool)
            for k, (x, y) in enumerate(zip(f.sa, f.sb)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep[k] = 100 * both >= percent * (len(x) + len(y) - both) and both > 0
            yield f.loc[keep, ["a", "b"]]

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInPandas(run, "a long, b long")


def intersections(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairs' intersections: products of 0/1 matrices, a slice of the shared shingles at a time."""
    both = left + right
    code, of = np.concatenate(both), np.repeat(np.arange(len(both)), [len(x) for x in both])
    _, code, count = np.unique(code, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    code, of = (np.cumsum(count > 1) - 1)[code[shared]], of[shared]
    order = np.argsort(code, kind="stable")
    code, of = code[order], of[order]
    out = np.zeros((len(left), len(right)), np.float64)
    for first in range(0, int(code[-1]) + 1 if len(code) else 0, columns):
        a, b = np.searchsorted(code, [first, first + columns])
        held = np.zeros((len(both), columns), np.float32)
        held[of[a:b], code[a:b] - first] = 1
        out += held[:len(left)] @ held[len(left):].T
    return out


def _block_links(member: DataFrame, docs: DataFrame, cls: DataFrame, percent: int, size: int) -> DataFrame:
    """Links across components inside buckets; ``member``: key, node, component, hub.

    Those outside the hub's component meet all of their bucket, block against
    block, on full shingle sets; a link for each pair of a class and a
    component that it reaches leaves the task.
    """
    sizes = C.stored(member.groupBy("key").agg(
        F.count("*").alias("size"),
        F.sum((F.col("component") != F.col("hub")).cast("long")).alias("outside")).where("outside > 0"), "near-sizes")
    m = C.stored(C.met(member, sizes, "key", 24), "near-open")
    nodes = C.stored(cls.join(m.select("node").distinct(), "node", "left_semi"), "near-nodes")
    m = (m.join(shingle_sets(docs, nodes, size), "node")
         .withColumn("mb", F.expr(f"cast(ceil(size / {BLOCK}) as int)"))
         .withColumn("ob", F.expr(f"cast(ceil(outside / {BLOCK}) as int)"))
         .withColumn("h", F.expr("xxhash64(node) & 9223372036854775807L")))
    out = m.where("component <> hub").select(
        "key", F.expr("cast(h % ob as int)").alias("i"), F.explode(F.expr("sequence(0, mb - 1)")).alias("j"),
        "node", "component", "shingles", F.lit(True).alias("outer"))
    rest = m.select(
        "key", F.explode(F.expr("sequence(0, ob - 1)")).alias("i"), F.expr("cast(h % mb as int)").alias("j"),
        "node", "component", "shingles", F.lit(False).alias("outer"))

    def run(f: pd.DataFrame) -> pd.DataFrame:
        left, right = f[f.outer], f[~f.outer]
        found: list[tuple[int, int]] = []
        if len(left) and len(right):
            x, y = ([np.frombuffer(s, np.uint64) for s in side.shingles] for side in (left, right))
            nx, ny = (np.array([len(s) for s in side], float) for side in (x, y))
            cx, cy, ids = left.component.to_numpy(), right.component.to_numpy(), right.node.to_numpy()
            both = intersections(x, y)
            linked = (100 * both >= percent * (nx[:, None] + ny[None] - both)) & (both > 0) & (cx[:, None] != cy[None])
            for k, node in enumerate(left.node.tolist()):
                at = np.flatnonzero(linked[k])
                for o in at[np.unique(cy[at], return_index=True)[1]].tolist():
                    found.append((min(node, int(ids[o])), max(node, int(ids[o]))))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return out.union(rest).groupBy("key", "i", "j").applyInPandas(run, "a long, b long").distinct()


def _same_documents(base: DataFrame, cls: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of different texts of one doc_id."""
    ids = base.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.count("*").alias("rows"), *[f(c).alias(f"{f.__name__}_{c}") for c in ("f1", "f2", "n") for f in (F.min, F.max)])
    several = ids.where("min_f1 <> max_f1 or min_f2 <> max_f2 or min_n <> max_n").select("doc_id", F.col("rows").alias("size"))
    several = C.stored(several, "near-several")
    if several.isEmpty():
        return several.select(F.col("doc_id").alias("a"), F.col("doc_id").alias("b"))
    texts = C.met(base.where("n > 0").select("doc_id", "f1", "f2", "n"), several, "doc_id", 16)
    of = C.stored(texts.join(cls.select("node", "f1", "f2", "n"), ["f1", "f2", "n"]).select("doc_id", "node").distinct(), "near-texts")
    first = C.stored(of.groupBy("doc_id").agg(F.min("node").alias("a"), F.count("*").alias("size")), "near-first-texts")
    return C.met(of, first, "doc_id", 24).where("a <> node").select("a", F.col("node").alias("b"))


def near_duplicates(spark: SparkSession, docs: DataFrame, percent: int = 80, size: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bands, rows = bands_for(percent)
    base = C.stored(sketched(docs, bands, rows, size), "near-base")
    # one class per distinct set, numbered; it is read from its smallest doc_id
    cls = base.where("n > 0 and doc_id is not null").groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"))
    cls = C.stored(cls.select(F.monotonically_increasing_id().alias("node"), "rep", "f1", "f2", "n"), "near-classes")
    classes = C.stored(base.withColumnRenamed("doc_id", "rep").join(cls, ["f1", "f2", "n", "rep"]).dropDuplicates(["node"]).select("node", "n", "regs", "bands"), "near-sketches")
    band = classes.select("node", F.explode("bands").alias("key"))
    counted = C.stored(band.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "near-bucket-sizes")
    band = C.stored(C.met(band, counted, "key", 16), "near-buckets")

    central = band.groupBy("node").agg(F.sum("size").alias("weight"))
    hub = band.join(central, "node").groupBy("key").agg(F.expr("max(struct(weight, -node))").alias("m"), F.first("size").alias("size"))
    hub = C.stored(hub.select("key", F.expr("-m.col2").alias("hub"), "size"), "near-hubs")
    band = C.stored(C.met(band.drop("size"), hub, "key", 24).select("key", "size", "node", "hub"), "near-buckets")
    star = band.where("node <> hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))

    pairs = C.stored(_screen(star.distinct(), classes, percent), "near-pairs")
    links = C.stored(_confirm(pairs, docs, cls, percent, size).union(_same_documents(base, cls)), "near-links")
    comp = components(links)
    at = lambda x, y: comp.select(F.col("node").alias(x), F.col("component").alias(y))
    # buckets of one list of members count once; only larger ones may be too large to list
    few = (band.where(f"size between 3 and {SMALL}").groupBy("key", "hub").agg(F.sort_array(F.collect_list("node")).alias("ids"))
           .select("hub", "ids").distinct().select(F.xxhash64("hub", "ids").alias("key"), "hub", F.explode("ids").alias("node")))
    few = few.join(at("hub", "ch"), "hub", "left").select("key", "node", F.coalesce("ch", "hub").alias("hub"))
    of_hub = C.stored(hub.where(f"size > {SMALL}").join(at("hub", "ch"), "hub", "left").select("key", F.coalesce("ch", "hub").alias("hub"), "size"), "near-hub-components")
    many = C.met(band.where(f"size > {SMALL}").select("key", "node"), of_hub, "key", 24).select("key", "node", "hub")
    member = many.union(few).join(at("node", "c"), "node", "left").select("key", "node", F.coalesce("c", "node").alias("component"), "hub")
    more = C.stored(_block_links(C.stored(member, "near-members"), docs, cls, percent, size), "near-links")
    if not more.isEmpty():
        comp = components(links.union(more))
    # a component is named by its smallest doc_id
    named = cls.join(comp, "node").select("f1", "f2", "n", "rep", "component")
    names = C.stored(named.groupBy("component").agg(F.min("rep").alias("name"), F.count("*").alias("size")), "near-names")
    linked = C.met(named.select("f1", "f2", "n", "component"), names, "component", 24).select("f1", "f2", "n", "name")
    alone = cls.join(comp.select("node"), "node", "left_anti").select("f1", "f2", "n", F.col("rep").alias("name"))
    labelled = C.stored(linked.union(alone), "near-labels")
    return (base.join(labelled, ["f1", "f2", "n"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("name", "doc_id").alias("component_id"))
            .withColumn("kept", F.expr("doc_id <=> component_id")))


def components(edges: DataFrame) -> DataFrame:
    return C.components(edges, "near-components")


def op2_setsketch_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents`` (Jaccard of 5-word shingles >= 0.85)."""
    return near_duplicates(spark, C.table(spark, sf_dir, "documents"), percent=85)
