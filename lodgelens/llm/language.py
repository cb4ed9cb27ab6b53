"""Language identification by word-first backoff.

A known word adds its log frequency in each language.  An unseen word falls
back to its character n-grams, longest first: the first length of which some
n-gram was seen in training scores the word.  N-grams are of characters, and
their counts come from the training vocabulary, one for every distinct n-gram
(told apart by 64-bit hash).  They are sent whole to the tasks if they are
small enough; if not, they are joined by hash with the n-grams of the
documents' distinct unseen words, and these words' scores go the way of the
known words.

A null text, or one without a letter, is ``und`` with score 0.  Ties go to the
language that sorts first.  With no training rows every text is ``und``.
Rows that repeat a doc_id are each scored; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from . import vocabulary as V

LONGEST = 4
#: A word seen fewer times than this in all languages is left to its n-grams.
KNOWN_FROM = 3
BACKOFF = 0.4


class Grams:
    """The padded words ``data[start:end]`` by characters."""

    def __init__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        size = end - start + 2  # a space before and after
        of = np.repeat(np.arange(len(start)), size)
        offset = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        inner = (offset > 0) & (offset < size[of] - 1)
        self.data = np.full(len(of), 32, np.uint8)
        self.data[inner] = data[(start[of] + offset - 1)[inner]]
        at = np.flatnonzero((self.data & 0xC0) != 0x80)
        self.at, self.word = np.r_[at, len(of)], of[at]

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(word number, hash) of every n-gram."""
        k = np.flatnonzero(self.word[n - 1:] == self.word[:len(self.word) - n + 1])
        return self.word[k], C.span_hashes(self.data, self.at[k], self.at[k + n])


class Model:
    """``table`` holds (word, log frequencies); ``grams`` (hash, log frequencies) of the n-grams of all lengths."""

    def __init__(self, languages: list[str], table: DataFrame, grams: DataFrame, unseen: np.ndarray):
        self.languages, self.table, self.grams, self.unseen = languages, table, grams, unseen


def fit(docs: DataFrame) -> Model:
    """Learn from ``docs(text, lang)``; rows with a null language are left out."""
    counts = C.stored(V.word_counts(docs, F.col("lang"), by_document=False), "language-words")
    totals = {r["kind"]: r["n"] for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect()}  # a row for each language
    languages = sorted(totals)
    n_words = max(1, counts.select("word").distinct().count())
    per = [F.sum(F.when(F.col("kind") == x, F.col("n")).otherwise(0)) for x in languages]
    known = counts.groupBy("word").agg(F.sum("n").alias("all"), F.array(*[
        F.log((p + 0.5) / (totals[x] + 0.5 * n_words)).cast("float") for p, x in zip(per, languages)]).alias("payload"))
    known = known.where(F.col("all") >= KNOWN_FROM)

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 1):
            kinds, codes = np.unique(batch.column(0).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            n = batch.column(2).to_numpy()
            for i, j, data, at in C.pieces(batch.column(1)):
                grams = Grams(data, at[:-1], at[1:])
                for g in range(1, LONGEST + 1):
                    word, h = grams.of(g)
                    code = codes[i:j][word]
                    order = np.lexsort((h, code))
                    cut = np.flatnonzero(np.r_[True, (h[order][1:] != h[order][:-1]) | (code[order][1:] != code[order][:-1])][:len(order)])
                    if len(cut):
                        yield pa.RecordBatch.from_arrays([
                            pa.array(np.full(len(cut), g, np.int32)), pa.array(h[order][cut].view(np.int64)), pa.array(kinds[code[order][cut]].astype(object), pa.string()),
                            pa.array(np.add.reduceat(n[i:j][word][order], cut))], ["g", "hash", "kind", "n"])

    parts = counts.select("kind", "word", "n").mapInArrow(count_grams, "g int, hash long, kind string, n long")
    parts = C.stored(parts.groupBy("g", "hash", "kind").agg(F.sum("n").alias("n")), "language-grams")
    # a row for each length and language, and one for each length
    all_of = {(r["g"], r["kind"]): r["n"] for r in parts.groupBy("g", "kind").agg(F.sum("n").alias("n")).collect()}
    distinct = {r["g"]: r["n"] for r in parts.select("g", "hash").distinct().groupBy("g").agg(F.count("*").alias("n")).collect()}

    def frequency(x):
        seen = F.sum(F.when(F.col("kind") == x, F.col("n")).otherwise(0))
        out = F.lit(None)
        for g in sorted(distinct):
            out = F.when(F.col("g") == g, F.log((seen + 0.5) / (all_of.get((g, x), 0) + 0.5 * distinct[g]))).otherwise(out)
        return out.cast("float")

    grams = parts.groupBy("g", "hash").agg(F.array(*[frequency(x) for x in languages]).cast("array<float>").alias("payload"))
    grams = C.stored(grams.select("hash", "payload").dropDuplicates(["hash"]), "language-gram-table")
    return Model(languages, known, grams, np.log(0.5 / (np.array([totals[x] for x in languages], float) + 0.5 * n_words)))


def backoff(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: V.Words, unseen: np.ndarray) -> np.ndarray:
    """Scores (a row for each word) of the unseen words ``data[start:end]``."""
    out = np.tile(unseen.astype(np.float32), (len(start), 1))
    left, discount, grams = np.ones(len(start), bool), 0.0, Grams(data, start, end)
    for n in range(LONGEST, 0, -1):
        if not left.any():
            break
        word, h = grams.of(n)
        word, h = word[left[word]], h[left[word]]
        found = table.find(h)
        word, found = word[found >= 0], found[found >= 0]
        hits = np.bincount(word, minlength=len(start))
        done = hits > 0
        for c in range(out.shape[1]):
            mean = np.bincount(word, table.payload[found, c], len(start)) if len(found) else np.zeros(len(start))
            out[done, c] = mean[done] / hits[done] + discount
        left, discount = left & ~done, discount + np.log(BACKOFF)
    return out


def scorer(model: Model, grams=None):
    """``grams``: a broadcast of the n-grams' hashes and rows; without it the word table holds every word that has a score."""
    languages, width, unseen = np.array(model.languages, object), len(model.languages), model.unseen

    def score(texts: pa.Array, words: V.Words) -> list[pa.Array]:
        total, some = np.zeros((len(texts), max(width, 1))), np.zeros(len(texts), bool)
        for i, j, data, at in C.pieces(V.lowered(texts)):
            row, start, end, h = V.letter_words(data, at)
            if not len(row) or not width:
                continue
            found = words.find(h)
            value = np.tile(unseen.astype(np.float32), (len(row), 1))
            known = found >= 0
            if known.any():
                value[known] = words.payload[found[known]]
            if grams is not None and not known.all():
                _, first, each = np.unique(h[~known], return_index=True, return_inverse=True)
                first = np.flatnonzero(~known)[first]
                value[~known] = backoff(data, start[first], end[first], V.Words(*grams.value), unseen)[each]
            for c in range(width):
                total[i:j, c] = np.bincount(row, value[:, c], j - i)
            some[i:j] = np.bincount(row, minlength=j - i) > 0
        for k in np.flatnonzero(some):  # non-ASCII characters need not be letters
            if not any(x.isalpha() for x in texts[int(k)].as_py()):
                some[k] = False
        best = total.argmax(1)
        odds = np.exp(total - total.max(1, keepdims=True))
        sure = odds.max(1) / odds.sum(1)
        pred = np.where(some, languages[best], "und") if width else np.full(len(texts), "und", object)
        return [pa.array(pred, pa.string()), pa.array(np.where(some, sure, 0.0))]

    return score


def unseen_words(docs: DataFrame, model: Model) -> DataFrame:
    """(word, payload) of the documents' distinct words that the model does not know but some n-gram of which it does."""
    width, unseen = len(model.languages), model.unseen
    words = V.word_counts(docs, F.lit("x"), by_document=False).select("word").join(model.table.select("word"), "word", "left_anti")
    words = C.stored(words, "language-unseen")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 0):
            for i, j, data, at in C.pieces(batch.column(0)):
                grams = Grams(data, at[:-1], at[1:])
                for g in range(1, LONGEST + 1):
                    word, h = grams.of(g)
                    yield pa.RecordBatch.from_arrays([batch.column(0)[i:j].take(pa.array(word)), pa.array(h.view(np.int64))], ["word", "hash"])

    hits = (words.mapInArrow(explode, "word string, hash long").distinct().join(model.grams, "hash")
            .groupBy("word").agg(F.collect_list(F.struct("hash", "payload")).alias("hits")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in C.slim(batches, 0):
            for i, j, data, at in C.pieces(batch.column(0), 1 << 14):
                found = batch.column(1)[i:j].flatten()
                h = found.field("hash").to_numpy(zero_copy_only=False).astype(np.int64)
                _, first = np.unique(h, return_index=True)
                own = V.Words(*V.arrays(h[first], found.field("payload").take(pa.array(first)), width))
                value = backoff(data, at[:-1], at[1:], own, unseen)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.ListArray.from_arrays(
                    pa.array(np.arange(j - i + 1, dtype=np.int32) * width), pa.array(value.reshape(-1)))], ["word", "payload"])

    return hits.mapInArrow(run, "word string, payload array<float>")


def identify(spark: SparkSession, docs: DataFrame, train: DataFrame, broadcast_bytes: int | None = None) -> DataFrame:
    """doc_id, lang_pred, score for ``docs(doc_id, text)``, learned from ``train(text, lang)``."""
    model = fit(train)
    width = max(1, len(model.languages))
    sent, table = V.sent(model.grams, width, broadcast_bytes) if model.languages else None, model.table
    if model.languages and sent is None:
        table = C.stored(table.select("word", "payload"), "language-known")
        model.table = table
        table = table.union(unseen_words(docs, model))
    return V.scored(docs, table, width, scorer(model, sent), "lang_pred string, score double", broadcast_bytes)


def op9_word_backoff_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all ``documents``, learned from those whose crc32 mod 5 is not 0."""
    docs = C.table(spark, sf_dir, "documents")
    out = identify(spark, docs, docs.where(~C.held_out()).select("text", "lang"))
    return out.select("doc_id", C.held_out().alias("held_out"), "lang_pred", "score")
