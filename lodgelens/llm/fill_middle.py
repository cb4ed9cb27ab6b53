"""Fill-in-the-middle samples: each text as prefix, suffix and middle behind marks.

A text is cut into units, the runs of blanks with the word that follows (blanks
at the end are a unit of their own), by one full match of the repeated unit:
the match keeps every repetition's end, so their number is the number of units
and any cut is one look-up.  Cuts and form come from the sha256 of ``seed`` and
doc_id alone, so reruns agree.  A text stays plain if it is empty, holds a mark
itself, or draws so; plain output is the text.

A null text counts as empty.  A null doc_id draws as the empty id.  Rows that
repeat a doc_id are cut each by its own text with the same draws.  Texts are
matched whole, in time linear in their length.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

UNITS = r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+)*"
#: What opens prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def _samples(seed: int, rate: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(UNITS)

        def sample(doc_id: int | None, text: str) -> tuple:
            ends = units.fullmatch(text).ends(1)
            n, (h1, h2, h3, h4) = len(ends), draws(seed, doc_id)
            if not text or h3 % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
                return doc_id, n, "plain", None, None, text
            i, j = (ends[k - 1] if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
            head, body, tail = text[:i], text[i:j], text[j:]
            form = "spm" if h4 % 100 < spm else "psm"
            parts = (SUFFIX, tail, PREFIX, head) if form == "spm" else (PREFIX, head, SUFFIX, tail)
            return doc_id, n, form, len(head), len(body), "".join((*parts, MIDDLE, body))

        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                            ("middle_chars", pa.int64()), ("output", pa.string())])
        for batch in C.slim(batches, 1):
            rows = [sample(d, t or "") for d, t in zip(*(batch.column(k).to_pylist() for k in (0, 1)))]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
    return run


def fill_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm: int = 80) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain), output.

    ``rate`` percent of the texts are cut, and of those ``spm`` percent have the
    suffix first.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_samples(seed, rate, spm), OUT)


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone.  A cut text holds no mark, so each mark's first place is its own."""
    second = F.when(form == "spm", F.instr(output, F.lit(PREFIX))).otherwise(F.instr(output, F.lit(SUFFIX)))
    third = F.instr(output, F.lit(MIDDLE))
    one = F.substr(output, F.lit(4), second - 4)
    two = F.substr(output, second + 3, third - second - 3)
    middle = F.substr(output, third + 3)
    return (F.when(form == "plain", output)
            .when(form == "spm", F.concat(two, middle, one)).otherwise(F.concat(one, middle, two)))


def op12_capture_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` as a sample, with digests of the output and of the text rebuilt from it."""
    made = fill_middle(C.table(spark, sf_dir, "documents"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                       digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
