"""Token ids in seekable files: independent zstandard frames behind a trailing seek table.

File layout (little-endian), readable by any zstandard decoder:

* frames of about ``FRAME_IDS`` ids (whole documents).  Decompressed: the
  number of documents (u32); per document its id (i64), 1 if it has one, 0 if
  it is null (u8) and its number of ids (u64); then all ids (u32);
* a skippable frame with one entry a frame: first and last id (i64), 1 if a
  null id is in it (u8), its documents (u32), the file's ids before it (u64);
* a skippable frame with the seek table: per frame its compressed and its
  decompressed size and the low half of the XXH64 of the decompressed bytes
  (u32 each), then the number of frames (u32), 0x80 (u8), the magic number.

A reader takes the last bytes first, then only the frames it needs, each
checked against its checksum.  A table beside the files, ``manifest``, names
the files of the run and the ids before each; a file that it doesn't name (a
task tried twice) isn't part of the data.

Documents go in ascending doc_id, null last; rows that repeat a doc_id follow
each other by the hash of their text, equal rows in any order.  A null or empty
text has the end id alone.  Texts are encoded whole: by one call each, or, for
vocabularies whose pre-tokenizer drops blanks (``by_words``), word by word with
a memo, which gives the same ids as no piece of such a vocabulary holds a blank.
A long document's ids stay
in one frame, so a frame holds fewer than 2^30 ids; one text beyond that is an
error.  Other columns are not looked at.  Without rows there are no files.
"""

from __future__ import annotations

import os
import re
import struct
import sys
import types
import uuid
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C

#: Ids in a frame and in a file, before the document that reaches the number.
FRAME_IDS, FILE_IDS = 1 << 16, 1 << 24
#: Words, and pieces, that a worker remembers twice over (some 200 bytes an entry), and the longest (bytes).
MEMO, MEMO_BYTES = 1 << 18, 64
#: Letters that stay one letter when lowered and take part in no composition with what is not a mark.
LATIN = re.compile("[a-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+")
#: Frames that one reading task's row stands for.
SLICE = 32
LEVEL = 3

# Fixed values of the seekable format.
SKIPPABLE, SEEK_FRAME, SEEK_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80

INDEX = np.dtype([("first", "<i8"), ("last", "<i8"), ("null", "u1"), ("docs", "<u4"), ("before", "<u8")])
SEEK = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
FOOTER = "<IBI"
FOOTER_BYTES = struct.calcsize(FOOTER)

MANIFEST = "partition int, file int, path string, frames int, docs long, ids long, bytes long, first_id long, last_id long, nulls boolean"


class DamagedFrame(ValueError):
    """A frame's bytes don't match its checksum, or the file isn't one of ours."""


def opened(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


class FileWriter:
    """Writes one file, frame by frame."""

    def __init__(self, path: str):
        self.fs, self.place = opened(path)
        self.path, self.packer = path, zstandard.ZstdCompressor(level=LEVEL)
        self.out = self.fs.open_output_stream(self.place, compression=None)
        self.index, self.seek, self.ids = [], [], 0
        self.docs, self.held = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids))
        self.held += len(ids)
        if self.held >= FRAME_IDS:
            self._frame()

    def _frame(self) -> None:
        if not self.docs:
            return
        if self.held >= 1 << 30:
            raise ValueError("a text of 2^30 ids or more")
        ids = [d for d, _ in self.docs]
        known = [d for d in ids if d is not None]
        raw = b"".join([struct.pack("<I", len(ids)), np.array([d or 0 for d in ids], "<i8").tobytes(),
                        np.array([d is not None for d in ids], "u1").tobytes(), np.array([len(x) for _, x in self.docs], "<u8").tobytes(),
                        *[x.astype("<u4").tobytes() for _, x in self.docs]])
        packed = self.packer.compress(raw)
        self.out.write(packed)
        # no id known: a range that holds no id
        self.index.append((min(known, default=1), max(known, default=0), len(known) < len(ids), len(ids), self.ids))
        self.seek.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.ids += self.held
        self.docs, self.held = [], 0

    def close(self) -> tuple:
        """frames, docs, ids, bytes, first_id, last_id, nulls of the finished file."""
        self._frame()
        index = np.array(self.index, INDEX)
        seek = np.array(self.seek, SEEK).tobytes() + struct.pack(FOOTER, len(self.seek), CHECKSUMS, SEEK_MAGIC)
        tail = b"".join(struct.pack("<II", magic, len(body)) + body for magic, body in ((SKIPPABLE, index.tobytes()), (SEEK_FRAME, seek)))
        self.out.write(tail)
        self.out.close()
        known = index[index["first"] <= index["last"]]
        first, last = (int(known["first"].min()), int(known["last"].max())) if len(known) else (None, None)
        return len(index), int(index["docs"].sum()), self.ids, sum(s[0] for s in self.seek) + len(tail), first, last, bool(index["null"].any())


class FileReader:
    """Reads single frames of one file."""

    def __init__(self, path: str):
        fs, place = opened(path)
        self.path, self.file, self.unpacker = path, fs.open_input_file(place), zstandard.ZstdDecompressor()
        end = self.file.size()
        frames, flags, magic = struct.unpack(FOOTER, self._read(end - FOOTER_BYTES, FOOTER_BYTES))
        if (magic, flags) != (SEEK_MAGIC, CHECKSUMS):
            raise DamagedFrame(f"{path}: no seek table")
        at = end - FOOTER_BYTES - frames * SEEK.itemsize
        self.seek = np.frombuffer(self._read(at, frames * SEEK.itemsize), SEEK)
        at -= 8 + frames * INDEX.itemsize
        self.index = np.frombuffer(self._read(at, frames * INDEX.itemsize), INDEX)
        self.offset = np.r_[0, np.cumsum(self.seek["packed"], dtype=np.int64)]

    def _read(self, at: int, size: int) -> bytes:
        if at < 0:
            raise DamagedFrame(f"{self.path}: cut short")
        self.file.seek(at)
        return self.file.read(size)

    def frame(self, k: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in the file, its ids) of the frame's documents."""
        try:
            raw = self.unpacker.decompress(self._read(int(self.offset[k]), int(self.seek["packed"][k])), max_output_size=int(self.seek["size"][k]))
        except zstandard.ZstdError as e:
            raise DamagedFrame(f"{self.path}: frame {k}: {e}") from e
        if len(raw) != self.seek["size"][k] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.seek["check"][k]:
            raise DamagedFrame(f"{self.path}: frame {k} doesn't match its checksum")
        n, = struct.unpack_from("<I", raw)
        doc, has = np.frombuffer(raw, "<i8", n, 4), np.frombuffer(raw, "u1", n, 4 + 8 * n)
        size = np.frombuffer(raw, "<u8", n, 4 + 9 * n).astype(np.int64)
        ids = np.frombuffer(raw, "<u4", offset=4 + 17 * n)
        at = np.r_[0, np.cumsum(size)]
        before = int(self.index["before"][k])
        for i in range(n):
            yield int(doc[i]) if has[i] else None, before + int(at[i]), ids[at[i]:at[i + 1]]

    def frames_of(self, doc_ids: np.ndarray) -> list[int]:
        """The frames whose range holds one of the (sorted) ids."""
        low, high = (np.searchsorted(doc_ids, self.index[c], side) for c, side in (("first", "left"), ("last", "right")))
        return np.flatnonzero(high > low).tolist()


class _Memo(dict):
    """Values made on first use; when full, entries not used since it was last full are forgotten."""

    def __init__(self, make):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: bytes) -> bytes | None:
        made = self.older[key] if key in self.older else self.make(key)
        if len(key) <= MEMO_BYTES:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[key] = made
        return made


class WordEncoder:
    """Ids of texts (UTF-8), as u32 bytes, word by word, for byte-level vocabularies that part letters from all else.

    A word without an apostrophe parts into runs of ASCII letters and non-ASCII
    characters and runs of other characters.  Where the former are Latin letters
    the pre-tokenizer parts as well, and such a run is one piece: it needs the
    normalizer and the model alone.  Everything else, and what holds an added
    token, goes through the whole tokenizer.
    """

    def __init__(self, tokenizer):
        from tokenizers.pre_tokenizers import ByteLevel

        normal, spelled = tokenizer.normalizer.normalize_str, ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        run, model = re.compile(rb"[a-z\x80-\xff]+|[^a-z\x80-\xff]+"), tokenizer.model.tokenize
        special = re.compile(b"|".join([b"'", *(re.escape(t.content.encode()) for t in tokenizer.get_added_tokens_decoder().values())]))

        def whole(word: bytes) -> bytes:
            return array("I", tokenizer.encode_batch_fast([word.decode()], add_special_tokens=False)[0].ids).tobytes()

        def piece(low: bytes) -> bytes | None:
            text = low.decode()
            if not low.isalpha():  # not a-z alone
                if low.isascii():
                    return whole(low)
                if not LATIN.fullmatch(text):
                    return None
                (text, _), = spelled(normal(text))
            return array("I", [t.id for t in model(text)]).tobytes()

        def word(raw: bytes) -> bytes:
            if special.search(raw):
                return whole(raw)
            parts = [pieces[r] for r in run.findall(raw.lower())]  # lowers A-Z only
            return whole(raw) if None in parts else b"".join(parts)

        pieces = _Memo(piece)
        self.words = _Memo(word)

    def __call__(self, text: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, text.split()))  # bytes part at the ASCII blanks


def _encoder(vocabulary: str, by_words: bool):
    """Texts to u32 bytes; kept with its memo for the life of the worker process (this module's globals last a task)."""
    from tokenizers import Tokenizer

    kept = sys.modules.setdefault("token_files_kept", types.ModuleType("token_files_kept")).__dict__
    key = xxhash.xxh128_hexdigest(vocabulary), by_words
    if key not in kept:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = Tokenizer.from_str(vocabulary)
        if by_words:
            kept[key] = lambda texts, encode=WordEncoder(tokenizer): [encode(t.encode()) for t in texts]
        else:
            kept[key] = lambda texts: [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return kept[key]


def _writing(folder: str, vocabulary, end_id: int, by_words: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _encoder(vocabulary.value, by_words), array("I", [end_id]).tobytes()
        partition, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex[:12]
        writer, made = None, []

        def done() -> None:
            made.append((partition, len(made), writer.path, *writer.close()))

        for batch in C.slim(batches, 1, 2 * C.PIECE_BYTES):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc_id, found in zip(batch.column(0).to_pylist(), encode(texts)):
                writer = writer or FileWriter(f"{folder}/part-{partition:06d}-{len(made):04d}-{attempt}.zst")
                writer.add(doc_id, np.frombuffer(found + end, np.uint32))
                if writer.ids + writer.held >= FILE_IDS:
                    done()
                    writer = None
        if writer:
            done()
        if made:
            yield pa.RecordBatch.from_pylist([dict(zip([c.split()[0] for c in MANIFEST.split(", ")], m)) for m in made], schema=_arrow(MANIFEST))
    return run


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in schema.split(", "))])


def write_ids(docs: DataFrame, folder: str, vocabulary_path: str, end_id: int, by_words: bool = False, partitions: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files of ``folder``; returns its manifest, which lies in ``folder``/manifest.

    ``vocabulary_path`` is a file of the tokenizers library; its text (a few
    MB, refused beyond ``BROADCAST_BYTES``) goes to the tasks.  Texts are dealt
    by ranges of (doc_id, hash of the text), so a repeated id can be split.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as f:
        text = f.read()
    if len(text) > C.BROADCAST_BYTES:
        raise ValueError(f"{vocabulary_path} is too large to send to every task")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text")).withColumn("at", F.monotonically_increasing_id())
    order = [F.asc_nulls_last("doc_id"), F.asc("h"), F.asc("at")]
    dealt = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    opened(folder)[0].create_dir(opened(folder)[1], recursive=True)
    files = dealt.sortWithinPartitions(*order).select("doc_id", "text")
    files = files.mapInArrow(_writing(folder, spark.sparkContext.broadcast(text), end_id, by_words), MANIFEST)
    raw = C.stored(files, "token-files")
    before = F.sum("ids").over(Window.orderBy("partition", "file").rowsBetween(Window.unboundedPreceding, -1))  # one row a file
    raw.withColumn("start", F.coalesce(before, F.lit(0)).cast("long")).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{MANIFEST}, start long").parquet(f"{folder}/manifest")


ROWS = "doc_id long, start long, n_tokens long, ids binary"


def _rows(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)


def _reading(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow(ROWS)
    for batch in batches:
        for path, start, k in zip(*(batch.column(c).to_pylist() for c in range(3))):
            reader = FileReader(path)
            for frame in range(k, min(k + SLICE, len(reader.seek))):
                yield _rows([(d, start + at, len(x), x.tobytes()) for d, at, x in reader.frame(frame)], schema)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids (u32, little-endian) of every document, frames dealt to all tasks."""
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))  # rows here are few, what they stand for is not
    slices = manifest(spark, folder).select("path", "start", F.explode(F.sequence(F.lit(0), F.col("frames") - 1, F.lit(SLICE))).alias("frame"))
    return slices.repartition(tasks).mapInArrow(_reading, ROWS)


def fetch_ids(spark: SparkSession, folder: str, doc_ids: list[int]) -> DataFrame:
    """The same columns for the asked documents only: other files aren't opened, other frames aren't decompressed."""
    wanted = np.unique(np.array(doc_ids, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = _arrow(ROWS)
        asked = set(wanted.tolist())
        for batch in batches:
            for path, start, first, last in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if first is None or np.searchsorted(wanted, first, "left") == np.searchsorted(wanted, last, "right"):
                    continue
                reader = FileReader(path)
                for k in reader.frames_of(wanted):
                    found = [(d, start + at, len(x), x.tobytes()) for d, at, x in reader.frame(k) if d in asked]
                    if found:
                        yield _rows(found, schema)

    return manifest(spark, folder).select("path", "start", "first_id", "last_id").mapInArrow(run, ROWS)


def op11_seekable_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` as ids in files, read back."""
    import public_tokenizers

    from lodgelens.session import scratch_path

    folder = scratch_path(spark, "token-ids")
    write_ids(C.table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1, by_words=True)
    return read_ids(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
