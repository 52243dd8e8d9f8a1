"""Token ids of documents as Arrow files of equal-length sequences.

A file is in Arrow's file format: the stream format (record batches one after the other) with
an index of the batches behind it. Its columns:

    ids   fixed-size list of SEQUENCE unsigned ids (16 bit where the vocabulary allows)
    mask  fixed-size list of SEQUENCE booleans, false on padding
    docs  list of (doc_id, at): the documents that begin in this sequence, and where

All batches but the last hold BATCH_SEQUENCES rows, so sequence i lies in batch i // BATCH_SEQUENCES,
and a memory-mapped file gives it, and its mask, without copying (``sequence``). Documents follow
one another in ascending doc_id order, each closed by the end id; only the last sequence of a file
is padded. Files are numbered by doc_id range.

Texts are encoded where they are scanned, and compressed ids are shuffled once to their doc_id
range. Each task writes files under names of its own and lists them in the manifest, so a task
that runs twice does no harm. Files go to the folder given, by pyarrow's file systems (local or
shared mounts, HDFS, S3), never to a machine-local one.

Defined results: a null text counts as empty and has the end id only; rows without a doc_id come
last; rows that share a doc_id are ordered by their ids; an empty table gives no files.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerloom.llm import common

SEQUENCE = 2048
BATCH_SEQUENCES = 128
END_ID = 2
# Text pieces that a worker remembers with their ids; beyond it starts afresh.
REMEMBERED_PIECES = 3 << 19

MANIFEST = "part int, path string, n_docs long, n_tokens long, n_sequences long"
ENCODED = "part int, doc_id long, ids binary"

# A single space between two other characters always begins a token of byte-level BPE, so a
# text may be encoded in pieces that are cut there.
_CUT = re.compile(r" (?=\S)(?<=\S )")


# ------------------------------------------------------------------ encoding

def cut(text: str) -> list[str]:
    """Pieces of a text between such spaces."""
    pieces = text.split(" ")
    # the usual text: no piece is empty or has white space at its ends
    if all(pieces) and list(map(str.strip, pieces)) == pieces:
        return pieces
    return _CUT.split(text)


def byte_characters() -> dict[int, str]:
    """The characters that byte-level BPE writes bytes as: printable ones as themselves."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_CHARACTERS = byte_characters()
# Punctuation that is a token of its own between a word and the end of a piece.
_STOPS = frozenset(".,;:!?)")


class Encoder:
    """Encodes texts piece by piece with a byte-level tokenizer; equal pieces once.

    Pieces of letters are a single pre-token and go straight to the tokenizer's BPE model;
    a stop behind letters, and a line end inside a piece, are tokens of their own. Whatever
    else a piece holds, the whole tokenizer encodes.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.remembered = self.tokenizer.model, remembered
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.code = self.dtype.char          # of Python's arrays
        self.known: dict[str, bytes] = {}    # pieces behind a space, without it
        self.bare: dict[str, bytes] = {}     # pieces behind a line end or nothing
        self.line_end = self._whole("\n")
        self.stops = {stop: self._whole(stop) for stop in _STOPS}

    def _whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, letters: str, space: bool) -> bytes:
        """Ids of a run of letters, with a space before it or not."""
        known = self.known if space else self.bare
        if (ids := known.get(letters)) is None:
            shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(_CHARACTERS)
            if space:
                shown = _CHARACTERS[32] + shown
            ids = known[letters] = array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()
        return ids

    def _piece(self, piece: str, space: bool) -> bytes:
        """Ids of a piece that is not known, or of a line of it."""
        if piece.isalpha():
            return self._word(piece, space)
        if piece[-1:] in _STOPS and piece[:-1].isalpha():
            return self._word(piece[:-1], space) + self.stops[piece[-1]]
        first, *lines = piece.split("\n")
        if lines and first and all(lines) and not any(c.isspace() for c in "".join(lines) + first):
            parts = [self._piece(first, space)]
            for line in lines:
                parts += [self.line_end, self._piece(line, False)]
            return b"".join(parts)
        return self._whole(" " + piece if space else piece)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as unsigned integers of ``dtype``."""
        known = self.known
        for text in texts:
            if len(known) > self.remembered:
                known.clear()
                self.bare.clear()
            pieces = cut(text or "")
            ids = list(map(known.get, pieces, repeat(b"")))
            at = -1
            for _ in range(ids.count(b"")):
                at = ids.index(b"", at + 1)
                piece = pieces[at]
                if piece not in known:
                    known[piece] = self._piece(piece, True)
                ids[at] = known[piece]
            ids[0] = self._piece(pieces[0], False)
            yield b"".join(ids)


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, remembered: int = REMEMBERED_PIECES) -> Encoder:
    """The encoder of this process: a worker's later tasks go on with the pieces it knows."""
    if (path, remembered) not in _ENCODERS:
        _ENCODERS[path, remembered] = Encoder(path, remembered)
    return _ENCODERS[path, remembered]


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype(np.uint16) if vocabulary <= 1 << 16 else np.dtype(np.uint32)


def _encode(path: str, splits: np.ndarray, end_id: int, remembered: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, remembered)
        packer = zstandard.ZstdCompressor(level=1)
        end = np.array([end_id], dtype=own.dtype).tobytes()
        for batch in batches:
            ids = [packer.compress(x + end) for x in own.encode(batch.column("text").to_pylist())]
            doc_id = batch.column("doc_id")
            numbers = doc_id.fill_null(np.iinfo(np.int64).max).to_numpy()
            parts = np.searchsorted(splits, numbers, "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(parts), doc_id, pa.array(ids, pa.binary())],
                                             names=["part", "doc_id", "ids"])

    return run


# ------------------------------------------------------------------ writing

def schema(dtype: np.dtype, sequence: int) -> pa.Schema:
    return pa.schema([
        ("ids", pa.list_(pa.from_numpy_dtype(dtype), sequence)), ("mask", pa.list_(pa.bool_(), sequence)),
        ("docs", pa.list_(pa.struct([("doc_id", pa.int64()), ("at", pa.int32())]))),
    ], metadata={"sequence": str(sequence), "batch_sequences": str(BATCH_SEQUENCES)})


class Writer:
    """One file; holds at most one batch of sequences and one document."""

    def __init__(self, folder: str, part: int, dtype: np.dtype, sequence: int):
        self.part, self.dtype, self.sequence = part, dtype, sequence
        self.path = f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
        files, place = file_system(self.path)
        self.stream = files.open_output_stream(place)
        self.schema = schema(dtype, sequence)
        self.writer = pa.ipc.new_file(self.stream, self.schema)
        self.held: list[np.ndarray] = []
        self.begins: list[tuple[int | None, int]] = []   # documents of the held ids
        self.in_held = self.n_docs = self.n_tokens = self.n_sequences = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.begins.append((doc_id, self.in_held))
        self.held.append(ids)
        self.in_held += len(ids)
        self.n_docs += 1
        self.n_tokens += len(ids)
        if self.in_held >= self.sequence * BATCH_SEQUENCES:
            self._write(BATCH_SEQUENCES)

    def _write(self, rows: int) -> None:
        """Write the held ids in batches of ``rows`` sequences, as far as they are full."""
        ids = np.concatenate(self.held)
        size = self.sequence * rows
        full = len(ids) // size
        for b in range(full):
            self._batch(ids[b * size:(b + 1) * size], size)
        self.held, self.in_held = [ids[full * size:]], len(ids) - full * size

    def _batch(self, ids: np.ndarray, real: int) -> None:
        rows = len(ids) // self.sequence
        here = [x for x in self.begins if x[1] < len(ids)]
        self.begins = [(d, at - len(ids)) for d, at in self.begins[len(here):]]
        docs: list[list[dict]] = [[] for _ in range(rows)]
        for doc_id, at in here:
            docs[at // self.sequence].append({"doc_id": doc_id, "at": at % self.sequence})
        self.writer.write_batch(pa.RecordBatch.from_arrays([
            pa.FixedSizeListArray.from_arrays(pa.array(ids), self.sequence),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < real), self.sequence),
            pa.array(docs, self.schema.field("docs").type)], schema=self.schema))
        self.n_sequences += rows

    def close(self) -> tuple:
        if self.in_held:
            ids = np.concatenate(self.held)
            padded = np.zeros(-(-len(ids) // self.sequence) * self.sequence, dtype=self.dtype)
            padded[:len(ids)] = ids
            self._batch(padded, len(ids))
        self.writer.close()
        self.stream.close()
        return self.part, self.path, self.n_docs, self.n_tokens, self.n_sequences


def file_system(path: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def _uri(path: str) -> str:
    """``file:/x`` as Spark writes it becomes ``file:///x``."""
    return re.sub(r"^file:/+", "file:///", path)


def _write(folder: str, dtype: np.dtype, sequence: int):
    """Sorted (part, doc_id, ids) rows become files; yields the manifest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, rows = None, []
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for part, doc_id, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if writer is None or writer.part != part:
                    if writer is not None:
                        rows.append(writer.close())
                    writer = Writer(folder, part, dtype, sequence)
                writer.add(doc_id, np.frombuffer(unpacker.decompress(packed), dtype=dtype))
        if writer is not None:
            rows.append(writer.close())
        columns = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["part", "path", "n_docs", "n_tokens", "n_sequences"])

    return run


def write(docs: DataFrame, folder: str, tokenizer: str, *, end_id: int = END_ID, sequence: int = SEQUENCE,
          remembered: int = REMEMBERED_PIECES) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files below ``folder``; returns the manifest.

    ``remembered`` bounds the pieces that a worker keeps, at some 200 bytes each.

    One manifest row for each file: part, path, n_docs, n_tokens, n_sequences and ``start``, the
    number of ids in the files before it.
    """
    spark = docs.sparkSession
    common.configure(spark)
    folder = _uri(folder)
    files, place = file_system(folder)
    files.create_dir(place, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    number = common.partitions(spark)
    cuts = [i / number for i in range(1, number)]
    found = rows.agg(F.percentile_approx("doc_id", cuts, max(10_000, 20 * number)).alias("cuts")).first()[0] if cuts else []
    splits = np.unique(np.array(found or [], dtype=np.int64))
    dtype = encoder(tokenizer, remembered).dtype
    encoded = common.map_batches(rows, _encode(tokenizer, splits, end_id, remembered), ENCODED)
    placed = encoded.repartitionById(len(splits) + 1, F.col("part")).sortWithinPartitions(
        "part", F.col("doc_id").asc_nulls_last(), "ids")
    common.map_batches(placed, _write(folder, dtype, sequence), MANIFEST).write.parquet(f"{folder}/_manifest")
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The files below ``folder`` in order, with the ids before each. One row for each file."""
    files = spark.read.schema(MANIFEST).parquet(f"{_uri(folder)}/_manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


# ------------------------------------------------------------------ reading

def opened(path: str) -> pa.RecordBatchFileReader:
    """A file for random access, memory-mapped where it is on a mounted file system."""
    files, place = file_system(path)
    if isinstance(files, arrow_fs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(place))
    return pa.ipc.open_file(files.open_input_file(place))


def sequence(reader: pa.RecordBatchFileReader, number: int) -> tuple[np.ndarray, pa.Array]:
    """Ids and mask of one sequence. Of a memory-mapped file the ids are a view, not a copy."""
    batch = reader.get_batch(number // BATCH_SEQUENCES)
    row = number % BATCH_SEQUENCES
    ids, mask = batch.column("ids"), batch.column("mask")
    size = ids.type.list_size
    return (ids.values.slice((ids.offset + row) * size, size).to_numpy(),
            mask.values.slice((mask.offset + row) * size, size))


def documents_of(path: str, start: int) -> Iterator[tuple]:
    """(doc_id, start, n_tokens, crc32) of each document in a file, batch by batch."""
    reader = opened(path)
    doc, begun, seen, crc = None, start, start, 0
    open_doc = False
    for b in range(reader.num_record_batches):
        batch = reader.get_batch(b)
        size = batch.column("ids").type.list_size
        ids = batch.column("ids").flatten().to_numpy()
        real = batch.column("mask").flatten().true_count
        at = 0
        for row, here in enumerate(batch.column("docs").to_pylist()):
            for item in here:
                place = row * size + item["at"]
                crc = zlib.crc32(ids[at:place].astype("<u4").tobytes(), crc)
                if open_doc:
                    yield doc, begun, seen + place - begun, crc
                doc, begun, crc, at, open_doc = item["doc_id"], seen + place, 0, place, True
        crc = zlib.crc32(ids[at:real].astype("<u4").tobytes(), crc)
        seen += real
    if open_doc:
        yield doc, begun, seen - begun, crc


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
            rows = documents_of(path, start)
            while chunk := [row for _, row in zip(range(10_000), rows)]:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*chunk)],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32. A task for each file."""
    files = manifest(spark, folder).select("part", "path", "start")
    number = max(1, common.partitions(spark))
    return common.map_batches(files.repartitionById(number, F.pmod("part", F.lit(number)).cast("int")), _read,
                              "doc_id long, start long, n_tokens long, ids_crc32 long")


def report(docs: DataFrame, tokenizer: str, remembered: int = REMEMBERED_PIECES) -> DataFrame:
    """Write the files to a new folder below the shared one and read them back."""
    spark = docs.sparkSession
    folder = common.run_folder(spark, "tokens")
    write(docs.select("doc_id", "text"), folder, tokenizer, remembered=remembered)
    return read(spark, folder)
