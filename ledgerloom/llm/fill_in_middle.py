"""Fill-in-the-middle transformation with piece tables.

A document is never edited. It is a piece table: descriptors (buffer, start, end) over two immutable
buffers, the text and the sentinels. Cutting a document splits its descriptor, an arrangement
permutes descriptors, and hashes and outputs stream the bytes that the descriptors name. To restore a
text, the output becomes the text buffer of a new table, is cut at its sentinels, and the inverse
permutation puts the pieces back; the sentinels' descriptors are dropped.

Tokens are words with the white space before them, and white space at the end. A document
is cut before two tokens that its id picks, and arranged as

    psm    <P> prefix <S> suffix <M> middle
    spm    <S> suffix <P> prefix <M> middle
    plain  the text as it is

Sentinels begin with ``<`` and end with ``>``, so one cannot overlap another, and a text that
holds one stays plain: the three in an output are found without doubt.

Each document is transformed where it is scanned; nothing is shuffled, and a lost task is run
again with the same result, as the cuts depend on the id alone.

Defined results: a null text counts as empty; an empty text, and one that holds a sentinel, is plain;
a null doc_id picks its cuts as an empty id; repeated rows are transformed one by one, alike where id
and text are alike; an empty table gives an empty result; further columns are ignored, whatever
their names. Ids may have any type and are hashed as text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.llm import common

SEED = 42
ARRANGED_PERCENT = 50   # of the documents; the others stay plain
SPM_PERCENT = 80        # of the arranged ones

SENTINELS = {"P": b"<P>", "S": b"<S>", "M": b"<M>"}
TEXT, MARKS = "text", "sentinels"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Pieces of a cut document with all sentinels: prefix 0, middle 1, suffix 2, <P> 3, <S> 4, <M> 5.
ARRANGEMENTS = {PLAIN: (0,), PSM: (3, 0, 4, 2, 5, 1), SPM: (4, 2, 3, 0, 5, 1)}


class Piece(NamedTuple):
    """A descriptor: bytes ``start`` to ``end`` of a buffer."""

    buffer: str
    start: int
    end: int


class PieceTable:
    """Descriptors over a text buffer and the sentinel buffer; neither is ever changed."""

    marks = b"".join(SENTINELS.values())

    def __init__(self, text: bytes, pieces: Iterable[Piece] | None = None):
        self.text = text
        self.pieces = [Piece(TEXT, 0, len(text))] if pieces is None else list(pieces)

    def cut(self, *places: int) -> PieceTable:
        """The table with its descriptors split at these places (bytes of the whole, ascending)."""
        pieces, left, at = [], list(places), 0
        for buffer, start, end in self.pieces:
            begin = start
            while left and left[0] <= at + end - start:
                middle = start + left.pop(0) - at
                pieces.append(Piece(buffer, begin, middle))
                begin = middle
            pieces.append(Piece(buffer, begin, end))
            at += end - start
        return PieceTable(self.text, pieces)

    def marked(self) -> PieceTable:
        """The table with a descriptor for each sentinel behind its own."""
        ends = np.cumsum([len(mark) for mark in SENTINELS.values()]).tolist()
        return PieceTable(self.text, [*self.pieces, *(Piece(MARKS, a, b) for a, b in zip([0, *ends], ends))])

    def arranged(self, order: tuple[int, ...]) -> PieceTable:
        return PieceTable(self.text, [self.pieces[i] for i in order])

    def put_back(self, order: tuple[int, ...]) -> PieceTable:
        """The inverse permutation: undoes ``arranged`` with the same order."""
        back = [0] * len(order)
        for place, piece in enumerate(order):
            back[piece] = place
        return self.arranged(tuple(back))

    def stream(self) -> Iterator[memoryview]:
        """The bytes that the descriptors name, without a copy."""
        views = {TEXT: memoryview(self.text), MARKS: memoryview(self.marks)}
        return (views[buffer][start:end] for buffer, start, end in self.pieces)

    def content(self) -> bytes:
        return b"".join(self.stream())

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for view in self.stream():
            digest.update(view)
        return digest.hexdigest()


def token_ends(text: bytes) -> np.ndarray:
    """The byte at which each token ends."""
    own = np.frombuffer(text, np.uint8)
    space = (own == 32) | ((own >= 9) & (own <= 13))
    ends = np.flatnonzero(~space & np.r_[space[1:], True]) + 1
    return np.r_[ends, len(text)] if len(text) and space[-1] else ends


def characters(text: bytes) -> int:
    """Code points of UTF-8: the bytes that do not continue one."""
    own = np.frombuffer(text, np.uint8)
    return int(np.count_nonzero((own & 0xC0) != 0x80))


def draws(doc_id: str | None, seed: int = SEED) -> list[int]:
    """Four numbers below 2^32 that an id picks."""
    shown = hashlib.sha256(f"{seed}:{doc_id or ''}".encode()).hexdigest()
    return [int(shown[i:i + 8], 16) for i in range(0, 32, 8)]


def form_of(text: bytes, h3: int, h4: int, arranged_percent: int, spm_percent: int) -> str:
    if not text or any(mark in text for mark in SENTINELS.values()) or h3 % 100 >= arranged_percent:
        return PLAIN
    return SPM if h4 % 100 < spm_percent else PSM


class Arranged(NamedTuple):
    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    table: PieceTable


def arrange(doc_id: str | None, text: bytes | None, seed: int = SEED, arranged_percent: int = ARRANGED_PERCENT,
            spm_percent: int = SPM_PERCENT) -> Arranged:
    """The arranged table of a document."""
    text = text or b""
    ends = token_ends(text)
    h1, h2, h3, h4 = draws(doc_id, seed)
    form = form_of(text, h3, h4, arranged_percent, spm_percent)
    if form == PLAIN:
        return Arranged(len(ends), form, None, None, PieceTable(text))
    units = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    first, second = (int(ends[k - 1]) if k else 0 for k in units)
    table = PieceTable(text).cut(first, second).marked().arranged(ARRANGEMENTS[form])
    return Arranged(len(ends), form, characters(text[:first]), characters(text[first:second]), table)


def restore(output: bytes, form: str) -> PieceTable:
    """The table of the text that was arranged into ``output``."""
    whole = PieceTable(output)
    if form == PLAIN:
        return whole
    places = []
    for piece in ARRANGEMENTS[form]:
        if piece > 2:
            mark = list(SENTINELS.values())[piece - 3]
            begin = output.index(mark, places[-1] if places else 0)
            places += [begin, begin + len(mark)]
    # the output begins with a sentinel: the cut at 0 leaves an empty piece in front
    cut = whole.cut(*places)
    return PieceTable(output, cut.pieces[1:]).put_back(ARRANGEMENTS[form]).arranged((0, 1, 2))


# ------------------------------------------------------------------ tables

def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("doc_id").cast("string").alias("id_text"), "text")


def _id_field(docs: DataFrame) -> T.StructField:
    return T.StructField("doc_id", docs.schema["doc_id"].dataType)


_COUNTS = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
           T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())]
_PIECES = T.ArrayType(T.StructType([T.StructField("buffer", T.StringType()), T.StructField("start", T.LongType()),
                                    T.StructField("end", T.LongType())]))
_PIECES_ARROW = pa.list_(pa.struct([("buffer", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _counts(found: list[Arranged]) -> list[pa.Array]:
    return [pa.array([x.n for x in found], pa.int64()), pa.array([x.form for x in found], pa.string()),
            pa.array([x.prefix_chars for x in found], pa.int64()), pa.array([x.middle_chars for x in found], pa.int64())]


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


def transformed(docs: DataFrame, *, seed: int = SEED, arranged_percent: int = ARRANGED_PERCENT,
                spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per document: doc_id, n (tokens), form, prefix_chars, middle_chars, pieces, output.

    ``pieces`` are the descriptors of the arranged text, in bytes of its UTF-8 form.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [arrange(i, text, seed, arranged_percent, spm_percent)
                     for i, text in zip(batch.column(1).to_pylist(), common.texts_of(batch))]
            pieces = [[x._asdict() for x in f.table.pieces] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *_counts(found), pa.array(pieces, _PIECES_ARROW),
                 _strings([f.table.content() for f in found])], names=schema.names)

    schema = T.StructType([_id_field(docs), *_COUNTS, T.StructField("pieces", _PIECES),
                           T.StructField("output", T.StringType())])
    return common.map_batches(_rows(docs), run, schema)


def restored(outputs: DataFrame) -> DataFrame:
    """doc_id and text, rebuilt from ``output`` and ``form`` alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [restore(output or b"", form).content() for output, form in zip(
                common.texts_of(batch, "output"), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), _strings(texts)], names=schema.names)

    schema = T.StructType([_id_field(outputs), T.StructField("text", T.StringType())])
    return common.map_batches(outputs.select("doc_id", "form", "output"), run, schema)


def report(docs: DataFrame, *, seed: int = SEED, arranged_percent: int = ARRANGED_PERCENT,
           spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per document: the counts, output_sha256, and restored_sha256 of the text rebuilt from the output.

    Texts and outputs do not leave their task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, outputs, texts = [], [], []
            for i, text in zip(batch.column(1).to_pylist(), common.texts_of(batch)):
                found.append(arrange(i, text, seed, arranged_percent, spm_percent))
                outputs.append(found[-1].table.sha256())
                texts.append(restore(found[-1].table.content(), found[-1].form).sha256())
                found[-1] = found[-1]._replace(table=None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *_counts(found), pa.array(outputs, pa.string()), pa.array(texts, pa.string())],
                names=schema.names)

    schema = T.StructType([_id_field(docs), *_COUNTS, T.StructField("output_sha256", T.StringType()),
                           T.StructField("restored_sha256", T.StringType())])
    return common.map_batches(_rows(docs), run, schema)
