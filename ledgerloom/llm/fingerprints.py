"""Lempel-Ziv phrase fingerprints of documents.

A text is parsed into the phrases of an LZ78 dictionary: each phrase is the shortest run of
characters not seen as a phrase before. The phrase set is hashed, and one-permutation
minimum hashing keeps the least hash of each of ``BINS`` bins, 16 bits of it. The share of
equal bins estimates the overlap of two phrase sets, which is near the saving that a
compressor with one text's dictionary has on the other.

Defined results: a null text counts as empty; two empty texts are alike (1), an empty and another
are not (0); equal texts have equal fingerprints. For the order of documents, rows without a
doc_id come last and rows that share one are ordered by their texts; an empty table gives an
empty result; a single document is its own next one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.llm import common

BINS = 256
LAST = (1 << 63) - 1

_EDGES = np.arange(1, BINS, dtype=np.uint64) * np.uint64((1 << 64) // BINS)


# ------------------------------------------------------------------ one text

def parse(text: str, phrases: set[str], open_phrase: str = "") -> str:
    """Add the phrases of ``text`` to ``phrases``; returns the phrase that is still open."""
    add = phrases.add
    for character in text:
        open_phrase += character
        if open_phrase not in phrases:
            add(open_phrase)
            open_phrase = ""
    return open_phrase


def hashed(phrases: set[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, phrases), np.uint64, len(phrases))


def signature(hashes: np.ndarray) -> np.ndarray:
    """16 bits of the least hash in each bin, 0 for an empty bin."""
    ordered = np.sort(hashes)
    begin = np.r_[0, np.searchsorted(ordered, _EDGES)]
    filled = begin < np.r_[begin[1:], len(ordered)]
    out = np.zeros(BINS, dtype=np.uint16)
    # the low bits are independent of the bin; 0 is kept for empty bins
    out[filled] = (ordered[begin[filled]] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)
    return out


def encode(bins: np.ndarray) -> str:
    return base64.b64encode(bins.astype("<u2").tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u2")


def fingerprint(text: str | None) -> str:
    phrases: set[str] = set()
    parse(text or "", phrases)
    return encode(signature(hashed(phrases)))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal bins among those that are filled in either signature."""
    filled = (a != 0) | (b != 0)
    return float((a == b)[filled].mean()) if filled.any() else 1.0


# ------------------------------------------------------------------ columns

def fingerprint_column(text: str | Column) -> Column:
    """The fingerprint of a text column."""
    def rate(texts: pd.Series) -> pd.Series:
        return texts.map(fingerprint)

    return F.pandas_udf(rate, T.StringType())(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def likeness_column(a: str | Column, b: str | Column) -> Column:
    """The likeness of two fingerprint columns, 0 to 1; null where one is missing."""
    def compare(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else likeness(decode(x), decode(y))
                          for x, y in zip(left, right)], dtype="float64")

    return F.pandas_udf(compare, T.DoubleType())(a, b)


# ------------------------------------------------------------------ edited texts

def edited_text(text: str, following: str) -> str:
    """The last half of the characters replaced by as many (or all) of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _rate(text: str, following: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Signatures of a text and of its edited text, which share their beginning, and a digest."""
    half = len(text) // 2
    shared: set[str] = set()
    kept = text[:len(text) - half]
    open_phrase = parse(kept, shared)
    both = hashed(shared)
    rests = []
    edited = edited_text(text, following)
    for rest in (text[len(kept):], edited[len(kept):]):
        phrases = shared.copy()
        parse(rest, phrases, open_phrase)
        phrases -= shared
        rests.append(signature(np.concatenate([both, hashed(phrases)])))
    return rests[0], rests[1], hashlib.sha256(edited.encode()).hexdigest()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one doc_id range in order, the first row of the next range behind them."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    held = None          # the row that waits for its next one
    ended = False
    rows: list[tuple] = []

    def batch_of(chunk):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*chunk), kinds)], names=names)

    def finish(row, own, edited, digest, next_bins):
        doc_id, text = row
        return (doc_id, len(text), digest, encode(own), encode(edited), likeness(own, edited),
                likeness(own, next_bins))

    waiting = None       # rated, but for the next text's fingerprint
    for batch in batches:
        for doc_id, text, tail in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                      batch.column("tail").to_pylist()):
            if ended:
                continue
            text = text or ""
            if held is not None:
                rated = _rate(held[1], text)
                if waiting is not None:
                    rows.append(finish(*waiting, rated[0]))
                waiting = (held, *rated)
            if tail:     # the rows that share the id of the first one are not needed
                ended = True
                if waiting is not None:
                    phrases: set[str] = set()
                    parse(text, phrases)
                    rows.append(finish(*waiting, signature(hashed(phrases))))
            held = (doc_id, text)
        if rows:
            yield batch_of(rows)
            rows = []


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness.

    Texts are shuffled once, to ranges of the doc_id. The cuts are ids that occur, so each range
    begins with a known id, and that row also goes behind the range before.
    """
    spark = docs.sparkSession
    common.configure(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "_order", F.coalesce("doc_id", F.lit(LAST)))
    number = common.partitions(spark)
    cuts = [i / number for i in range(1, number)] or [0.5]
    least, found = rows.agg(
        F.min("_order"), F.percentile_approx("_order", cuts, max(10_000, 20 * number))).first()
    firsts = np.unique(np.array([least, *(found or [])] if least is not None else [0], dtype=np.int64))

    # a range's first row also closes the range before; the very first closes the last range
    @F.pandas_udf(T.ArrayType(T.StructType([T.StructField("part", T.IntegerType()), T.StructField("tail", T.BooleanType())])))
    def places(order: pd.Series) -> pd.Series:
        part = np.searchsorted(firsts, order.to_numpy(), "right") - 1
        is_first = firsts[part] == order.to_numpy()
        return pd.Series([
            [{"part": int(p), "tail": False}, {"part": int(p - 1) % len(firsts), "tail": True}] if f
            else [{"part": int(p), "tail": False}] for p, f in zip(part, is_first)], dtype=object)

    placed = rows.withColumn("_place", F.explode(places("_order"))).select(
        "doc_id", "text", "_order", F.col("_place.part").alias("part"), F.col("_place.tail").alias("tail"))
    ordered = placed.repartitionById(len(firsts), F.col("part")).sortWithinPartitions("tail", "_order", "text")
    return common.map_batches(
        ordered.select("doc_id", "text", "tail"), _compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
