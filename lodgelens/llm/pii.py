"""Personal data by candidate gradient boosting.

High-recall generators propose spans, which may overlap: the four base kinds'
patterns, whose matches stay if they pass their checks, and looser ones for
addresses, telephone-like and long numbers.  Boosted trees judge each loose
candidate by its format and its context.  They learn from all loose candidates
of all documents that are not held out: positive are those that meet a base
span of their kind (email, phone, card), negative the others, except that a
spelled-out address is not labelled.  The signs by which the base patterns
decide (the plus, the at sign as against its spelling) are no features.  The
probability from which a kind is redacted is set for that kind alone: on all
labelled candidates of its own generator in the documents that are held out,
as the lowest from which ``PRECISION`` of at
least ``SUPPORT`` candidates are positive; a kind without one adds nothing.  As
true data that no base pattern confirms count as negative, the precision is
rather higher than that.  Redacted candidates that overlap a base span or an
earlier one are left out, and the others carry kinds of their own
(``more_...``).

Positions are code points, end exclusive.  A null or empty text has no spans.
Rows that repeat a doc_id are each searched.  Other columns are not looked at.
Texts are searched whole, in time linear in their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import trees

BASE = ("email", "ip", "card", "phone")
MORE = ("more_email", "more_phone", "more_number")
KINDS = BASE + MORE
PRECISION, SUPPORT = 0.95, 20
#: The probabilities from which a kind may be redacted.
LEVELS = np.linspace(0.5, 0.99, 50)
#: Features leave a task in batches of about so many candidates.
ROWS = 8192

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match begins where digits do, so no run is read from each of its digits
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_AT, _DOT = re.compile(r"@|\(at\)|\[at\]"), re.compile(r"\.|\(dot\)|\[dot\]")
_ADDRESS = re.compile(rf"[A-Za-z0-9._%+-]{{1,64}}+ ?(?:{_AT.pattern}) ?[A-Za-z0-9-]{{1,64}}(?: ?(?:{_DOT.pattern}) ?[A-Za-z0-9-]{{2,24}}){{0,4}}")
_NUMBER = re.compile(r"(?<![A-Za-z0-9])\(?[0-9][\x20().0-9/-]{5,40}[0-9](?![A-Za-z0-9])")
_CUE = {"more_email": re.compile(r"mail|contact|write", re.I), "more_phone": re.compile(r"tel|phone|call|mobile|fax", re.I),
        "more_number": re.compile(r"card|account|iban|ssn|number", re.I)}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards: linear however long the runs are."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_SET:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_candidates(text: str) -> list[tuple[int, int, int, bool]]:
    """(kind number, start, end, passed) of the base patterns' matches."""
    out = [(0, a, b, True) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        out.append((1, m.start(), m.end(), all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        out.append((2, m.start(), m.end(), 16 <= len(digits) <= 19 and luhn(digits)))
    for m in _PHONE.finditer(text):
        out.append((3, m.start(), m.end(), 8 <= sum(c.isdigit() for c in m[0]) <= 15))
    return out


def more_candidates(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the looser patterns' matches."""
    out = [(4, m.start(), m.end()) for m in _ADDRESS.finditer(text)] if "@" in text or "at)" in text or "at]" in text else []
    for m in _NUMBER.finditer(text):
        digits = sum(c.isdigit() for c in m[0])
        if 7 <= digits <= 24:
            out.append((5 if digits <= 15 else 6, m.start(), m.end()))
    return out


#: The base kind that confirms a loose one.
CONFIRMS = {4: 0, 5: 3, 6: 2}


def labelled(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind number, start, end, whether a base span of its kind meets it) of the loose candidates that have a label."""
    base = [s for s in base_candidates(text) if s[3]]
    met = {}
    for kind, of in CONFIRMS.items():
        at = [(a, b) for k, a, b, _ in base if k == of]  # in order and apart
        met[kind] = np.array([a for a, _ in at], int), np.array([b for _, b in at], int)
    for kind, a, b in more_candidates(text):
        starts, ends = met[kind]
        i = int(np.searchsorted(ends, a, "right"))  # the first base span that ends after a
        if kind != 4 or "@" in text[a:b]:
            yield kind, a, b, i < len(starts) and bool(starts[i] < b)


def features(text: str, kind: int, a: int, b: int) -> list[float]:
    span, before, after = text[a:b], text[max(0, a - 40):a].rstrip("+"), text[b:b + 1]
    digits = sum(c.isdigit() for c in span)
    groups = re.findall(r"[0-9]+", span[:200])
    return [kind, digits, sum(c.isalpha() for c in _AT.sub("", _DOT.sub("", span))), len(_DOT.findall(span)), span.count("-"), span.count(" "),
            float(span[:1] == "("), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
            float(before[-1:].isalnum()), float(after.isalnum()), float(before[-1:] in tuple("/=#_$@.")), *[float(bool(c.search(before))) for c in _CUE.values()]]


WIDTH = 16


def lowest(total: np.ndarray, true: np.ndarray) -> float:
    """The lowest of LEVELS from which at least SUPPORT candidates are positive in a share of PRECISION; 1.01 if none.

    ``total`` and ``true`` count all and positive candidates by the number of levels that they reach.
    """
    over, hits = (np.cumsum(c[::-1])[::-1][1:] for c in (total, true))
    good = np.flatnonzero((over >= SUPPORT) & (hits >= PRECISION * over))
    return float(LEVELS[good[0]]) if len(good) else 1.01


def reached(p: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, p, "right")


def threshold(p: np.ndarray, truth: np.ndarray) -> float:
    """``lowest`` of candidates with the probabilities ``p``."""
    count = lambda weights: np.bincount(reached(p), weights, len(LEVELS) + 1)
    return lowest(count(None), count(truth))


def cells_of(docs: DataFrame) -> DataFrame:
    """x, y, held, n: how many labelled loose candidates of ``docs(doc_id, text)`` have the features x and the label y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            flat = pa.array(np.array(x, np.int16).reshape(-1))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * WIDTH), flat)
            return pa.RecordBatch.from_arrays([lists, pa.array(y, pa.bool_()), pa.array(held, pa.bool_())], ["x", "y", "held"])

        x, y, held = [], [], []
        for batch in C.slim(batches, 1):
            for out, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                for kind, a, b, met in labelled(text):
                    x.append(features(text, kind, a, b))
                    y.append(met)
                    held.append(out)
                    if len(x) == ROWS:
                        yield packed()
                        x, y, held = [], [], []
        if x:
            yield packed()

    rows = docs.select(C.held_out().alias("held"), F.col("text").cast("string").alias("text")).mapInArrow(run, "x array<smallint>, y boolean, held boolean")
    return rows.groupBy("x", "y", "held").agg(F.count("*").alias("n"))


def thresholds(cells: DataFrame, model: list[tuple]) -> dict[int, float]:
    """The threshold of each loose kind from all of ``cells(x, y, n)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = trees.matrix(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0].astype(np.int64)), pa.array(reached(trees.boosted(model, x))), batch.column(1), batch.column(2)],
                                             ["kind", "levels", "y", "n"])

    found = cells.select("x", "y", "n").mapInArrow(run, "kind long, levels long, y boolean, n long").groupBy("kind", "levels", "y").agg(F.sum("n").alias("n")).collect()
    counts = {k: np.zeros((2, len(LEVELS) + 1)) for k in CONFIRMS}
    for r in found:
        counts[r.kind][0][r.levels] += r.n
        counts[r.kind][1][r.levels] += r.n * r.y
    return {k: lowest(*c) for k, c in counts.items()}


def fit(docs: DataFrame) -> tuple[list[tuple], dict[int, float]]:
    """(trees, threshold of each loose kind) from all of ``docs(doc_id, text)``."""
    cells = C.stored(cells_of(docs), "pii_cells")
    model = trees.boost_table(cells.where("not held"))
    return model, thresholds(cells.where("held"), model)


def spans_of(text: str, model: list[tuple], least: dict[int, float]) -> list[tuple[int, int, int]]:
    """(kind number, start, end), sorted; ``least`` holds the threshold of each loose kind."""
    base = [(k, a, b) for k, a, b, passed in base_candidates(text) if passed]
    more = sorted((s for s in more_candidates(text) if least[s[0]] <= 1), key=lambda s: (s[1], -s[2]))
    if more:
        p = trees.boosted(model, np.array([features(text, *s) for s in more], float))
        taken = sorted((a, b) for _, a, b in base)
        starts = np.array([a for a, _ in taken] or [0])
        ends = np.maximum.accumulate(np.array([b for _, b in taken] or [0]))
        last = 0
        for (k, a, b), q in zip(more, p):
            at = int(np.searchsorted(starts, b)) - 1  # the last base span that begins before b
            if q >= least[k] and a >= last and (not taken or at < 0 or ends[at] <= a):
                base.append((k, a, b))
                last = b
    return sorted(base)


def find_personal(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, text, spans (kind, start, end) for ``docs(doc_id, text)``."""
    model, least = fit(docs.select("doc_id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in C.slim(batches, 1):
            found = [[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans_of(t.as_py() or "", model, least)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, kind)], ["doc_id", "text", "found"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, text string, found array<struct<kind:string,start:int,end:int>>")


def redact(spans: DataFrame, mark: str = "[{}]") -> DataFrame:
    """``find_personal``'s rows with each span of text replaced by its kind (overlaps as one)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 1):
            out = []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts, at = [], 0
                for s in sorted(found or [], key=lambda s: (s["start"], -s["end"])):
                    if s["start"] >= at:
                        parts += [text[at:s["start"]], mark.format(s["kind"])]
                    at = max(at, s["end"])
                out.append(None if text is None else "".join(parts) + text[at:])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["doc_id", "text"])

    return spans.select("doc_id", "text", "found").mapInArrow(run, "doc_id long, text string")


def op5_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all ``documents``, with a digest of the base kinds' spans."""
    f = find_personal(spark, C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE))
    count = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return f.select("doc_id", *map(count, BASE),
                    F.sha2(text(base), 256).alias("base_sha256"), text(F.col("found")).alias("spans"))
