"""Small regression trees, alone (a decision tree) or boosted, fitted on bounded arrays or, boosted, on a table of any size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
#: Gradients are summed as whole multiples of 1 / SCALE, so sums do not depend on the order of rows (up to 2**39 rows).
SCALE = 1 << 24


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, least: float) -> tuple:
    """A tree whose leaf value is sum(g) / sum(h): (value,) or (feature, threshold, low, high).

    Splits maximise the gain in sum(g)**2 / sum(h); with g the 0/1 class and h 1
    that is the Gini gain.  Each side keeps a weight of ``least``.
    """
    best, total_g, total_h = None, g.sum(), h.sum()
    value = (float(total_g / max(total_h, 1e-9)),)
    if depth == 0 or len(x) < 2:
        return value
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        if len(values) < 2:
            continue
        cuts = (values[:-1] + values[1:]) / 2
        if len(cuts) > BINS:
            cuts = np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1]))
        cell = np.searchsorted(cuts, x[:, f], "left")
        gl = np.cumsum(np.bincount(cell, g, len(cuts) + 1))[:-1]
        hl = np.cumsum(np.bincount(cell, h, len(cuts) + 1))[:-1]
        gr, hr = total_g - gl, total_h - hl
        ok = (hl >= least) & (hr >= least)
        gain = np.where(ok, gl ** 2 / np.maximum(hl, 1e-9) + gr ** 2 / np.maximum(hr, 1e-9), -np.inf) - total_g ** 2 / max(total_h, 1e-9)
        k = int(gain.argmax())
        if gain[k] > 1e-9 and (best is None or gain[k] > best[0] + 1e-12):
            best = (gain[k], f, float(cuts[k]))
    if best is None:
        return value
    _, f, cut = best
    low = x[:, f] <= cut
    return f, cut, grow(x[low], g[low], h[low], depth - 1, least), grow(x[~low], g[~low], h[~low], depth - 1, least)


def predict(tree: tuple, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    f, cut, low, high = tree
    left = x[:, f] <= cut
    out = np.empty(len(x))
    out[left], out[~left] = predict(low, x[left]), predict(high, x[~left])
    return out


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3) -> list[tuple]:
    """Logistic boosting by Newton steps; the first entry is the starting log-odds."""
    mean = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    score = np.full(len(y), np.log(mean / (1 - mean)))
    trees: list[tuple] = [(float(np.log(mean / (1 - mean))),)]
    for _ in range(rounds if len(y) else 0):
        p = 1 / (1 + np.exp(-score))
        tree = grow(x, y - p, p * (1 - p) + 1e-6, depth, 0.5)
        if len(tree) == 1:
            break
        score = score + rate * predict(tree, x)
        trees.append(tree)
    return trees


def boosted(trees: list[tuple], x: np.ndarray, rate: float = 0.3) -> np.ndarray:
    score = np.full(len(x), trees[0][0])
    for t in trees[1:]:
        score += rate * predict(t, x)
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def matrix(x: pa.Array) -> np.ndarray:
    """A list column whose rows are equally long."""
    return x.flatten().to_numpy().reshape(len(x), -1).astype(float)


def relabel(tree: tuple, leaf: Callable) -> tuple:
    return (leaf(tree[0]),) if len(tree) == 1 else (*tree[:2], relabel(tree[2], leaf), relabel(tree[3], leaf))


def best_cut(values: np.ndarray, g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, float, int]:
    """(gain, threshold, values below it) of the best cut between neighbouring values with the sums ``g`` and ``h`` each."""
    gl, hl, total_g, total_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1], g.sum(), h.sum()
    gr, hr = total_g - gl, total_h - hl
    gain = np.where((hl >= least) & (hr >= least), gl ** 2 / np.maximum(hl, 1e-9) + gr ** 2 / np.maximum(hr, 1e-9), -np.inf) - total_g ** 2 / max(total_h, 1e-9)
    k = int(gain.argmax())
    return float(gain[k]), float(values[k] + values[k + 1]) / 2, k + 1


def node_sums(cells: DataFrame, model: list[tuple], shape: tuple, nodes: list[int], rate: float) -> dict[int, dict[int, np.ndarray]]:
    """Of each node (leaf number of ``shape``) and feature: rows (value, sum of g, sum of h), values ascending.

    One pass over ``cells``; the driver gets a row for each node, feature and value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, n = matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False).astype(float), batch.column(2).to_numpy()
            p, at = boosted(model, x, rate), predict(shape, x)
            g = np.rint((y - p) * SCALE).astype(np.int64) * n
            h = np.rint((p * (1 - p) + 1e-6) * SCALE).astype(np.int64) * n
            out = []
            for node in nodes:
                here = at == node
                for f in range(x.shape[1]) if here.any() else ():
                    values, cell = np.unique(x[here, f], return_inverse=True)
                    sums = np.zeros((2, len(values)), np.int64)
                    np.add.at(sums[0], cell, g[here])
                    np.add.at(sums[1], cell, h[here])
                    out.append(np.stack([np.full(len(values), node), np.full(len(values), f), values.astype(np.int64), *sums]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out, 1)], ["node", "feature", "value", "g", "h"])

    sums = cells.select("x", "y", "n").mapInArrow(run, "node long, feature long, value long, g long, h long")
    found: dict[int, dict[int, list]] = {}
    for r in sums.groupBy("node", "feature", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
        found.setdefault(r.node, {}).setdefault(r.feature, []).append((r.value, r.g / SCALE, r.h / SCALE))
    return {node: {f: np.array(sorted(rows)) for f, rows in of.items()} for node, of in found.items()}


def grow_table(cells: DataFrame, model: list[tuple], depth: int, least: float, rate: float) -> tuple:
    """The tree that ``grow`` makes of the gradients after ``model``, cut between any two values; one pass a level."""
    shape, value, nodes = (0,), {0: 0.0}, [0]
    for _ in range(depth):
        splits = {}
        for node, of in sorted(node_sums(cells, model, shape, nodes, rate).items()):
            best = None
            value[node] = of[0][:, 1].sum() / max(of[0][:, 2].sum(), 1e-9)
            for f, rows in sorted(of.items()):
                if len(rows) > 1:
                    gain, cut, below = best_cut(*rows.T, least)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-12):
                        best = gain, f, cut, below
            if best:
                _, f, cut, below = best
                low, high = len(value), len(value) + 1
                for part, rows in ((low, of[f][:below]), (high, of[f][below:])):
                    value[part] = rows[:, 1].sum() / max(rows[:, 2].sum(), 1e-9)
                splits[node] = f, cut, (low,), (high,)
        if not splits:
            break
        shape = _replace(shape, splits)
        nodes = [leaf[0] for s in splits.values() for leaf in s[2:]]
    return relabel(shape, lambda node: float(value[node]))


def _replace(tree: tuple, splits: dict[int, tuple]) -> tuple:
    return splits.get(tree[0], tree) if len(tree) == 1 else (*tree[:2], _replace(tree[2], splits), _replace(tree[3], splits))


def boost_table(cells: DataFrame, rounds: int = 40, depth: int = 3, rate: float = 0.3) -> list[tuple]:
    """``boost`` on all rows of the (stored) table ``cells(x array<smallint>, y boolean, n long)``, each of which counts n times.

    The table stays where it is: a tree takes a pass for each level, and the
    driver holds the sums of each value of each feature in a node, so features
    have few distinct values (counts and flags).
    """
    total, true = cells.agg(F.sum("n"), F.sum(F.when(F.col("y"), F.col("n")).otherwise(0))).first()
    mean = float(np.clip(true / total if total else 0.5, 1e-3, 1 - 1e-3))
    trees: list[tuple] = [(float(np.log(mean / (1 - mean))),)]
    for _ in range(rounds if total else 0):
        tree = grow_table(cells, trees, depth, 0.5, rate)
        if len(tree) == 1:
            break
        trees.append(tree)
    return trees
