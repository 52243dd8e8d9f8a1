"""Packing of documents into windows by non-negative least squares.

1. Each document becomes ids with an end id. What is longer than a window is cut into whole
   windows and a rest; the pieces are staged with their ids. All that the driver sees is the
   histogram of piece lengths, which has no more entries than a window has places.
2. All combinations of up to three lengths that fill a window exactly are enumerated. Repeat
   counts x >= 0 with least |A x - h| against the histogram h are found by an active-set method: combinations
   join the active set where the gradient is steepest, the least-squares problem on the set is solved by
   conjugate gradients, and combinations that would turn negative leave it at the boundary.
   Counts are rounded and taken, the most repeated first, as far as pieces last.
3. The residuals are packed greedily: the longest piece, with what fills the window best. A
   window that stays more than ``SLACK`` short is given up; the pieces of that length join a
   stream, which is laid end to end and cut at windows. Only the stream cuts pieces of documents
   that fit a window, and only its last sequence has more padding than SLACK.

The plan is a list of slots (length, first, position, stride): piece number ``first + k`` of a length begins
at ``position + k * stride`` of the sequences laid end to end. The plan does not grow with the corpus:
active combinations have three slots at most, and every greedy step leaves fewer pieces of some length than
it took at once, at most window / length, so steps are fewer than the sum of these. Pieces are numbered
within their length by scan task, and tasks by sums of their counts, so no length, however common,
is gathered anywhere.

Defined results: a null or empty text has the end id only; a null doc_id stays null; repeated rows are packed
one by one; an empty table gives an empty result; further columns are ignored, whatever their names.
Which documents share a sequence depends on how the scan is split; how many windows there are does not.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ledgerloom.llm import common
from ledgerloom.llm.token_files import REMEMBERED_PIECES, encoder

WINDOW = 2048
END_ID = 1
SLACK = 8
# The counts of pieces by task and length are broadcast up to so many rows, and joined by a shuffle beyond.
BROADCAST_COUNTS = 1_000_000

ROUNDS, BATCH, INNER, SOLVE = 200, 256, 20, 300
NUMBER_BITS = 50


# ------------------------------------------------------------------ combinations

def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of three places in ``lengths`` (ascending) whose lengths add up to ``window``; len(lengths) for none."""
    none = len(lengths)
    place = np.full(window + 1, -1)
    place[lengths] = np.arange(none)
    found = []
    for i, a in enumerate(lengths):
        if 2 * a <= window and place[window - a] >= 0:
            found.append(np.array([[i, place[window - a], none]]))
        if 3 * a <= window:
            second = np.arange(i, np.searchsorted(lengths, (window - a) // 2, "right"))
            third = place[window - a - lengths[second]]
            keep = third >= 0
            found.append(np.column_stack([np.full(keep.sum(), i), second[keep], third[keep]]))
    return np.concatenate(found) if found else np.zeros((0, 3), int)


def _times(columns: np.ndarray, x: np.ndarray, size: int) -> np.ndarray:
    """A x: the pieces of each length that the combinations use."""
    return np.bincount(columns.ravel(), np.repeat(x, 3), size + 1)[:size]


def _transposed(columns: np.ndarray, r: np.ndarray) -> np.ndarray:
    """A' r."""
    return np.r_[r, 0.0][columns].sum(axis=1)


def _least_squares(columns: np.ndarray, h: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Conjugate gradients on the normal equations, from ``x``."""
    x = x.copy()
    r = h - _times(columns, x, len(h))
    s = _transposed(columns, r)
    p, norm = s, s @ s
    enough = 1e-20 * max(1.0, h @ h)
    for _ in range(SOLVE):
        if norm <= enough:
            break
        q = _times(columns, p, len(h))
        step = norm / (q @ q)
        x += step * p
        r -= step * q
        s = _transposed(columns, r)
        p, norm = s + (s @ s) / norm * p, s @ s
    return x


def _steepest(columns: np.ndarray, gradient: np.ndarray, size: int, many: int) -> np.ndarray:
    """Up to ``many`` combinations of the steepest gradient that share no length."""
    order = np.argsort(-gradient, kind="stable")[:16 * many]
    used, chosen = np.zeros(size + 1, bool), []
    for c in order:
        if gradient[c] <= 0 or len(chosen) == many:
            break
        own = columns[c][columns[c] < size]
        if not used[own].any():
            used[own] = True
            chosen.append(c)
    return np.array(chosen, int)


def repeat_counts(columns: np.ndarray, h: np.ndarray) -> np.ndarray:
    """x >= 0 with least |A x - h|, up to a gradient of a ten-thousandth of the largest count.

    Many combinations join at once as long as that gains something; in the end one by one, which always does.
    """
    x, active = np.zeros(len(columns)), np.zeros(len(columns), bool)
    h = h.astype(np.float64)
    enough = 1e-4 * max(1.0, h.max(initial=0))
    best, many = np.inf, BATCH
    for _ in range(ROUNDS):
        r = h - _times(columns[active], x[active], len(h))
        gradient = np.where(active, 0, _transposed(columns, r))
        if r @ r >= best * (1 - 1e-4):
            many //= 4
        if gradient.max(initial=0) <= enough or not many:
            break
        best = min(best, r @ r)
        active[_steepest(columns, np.where(gradient > enough, gradient, 0), len(h), many)] = True
        for _ in range(INNER):
            places = np.flatnonzero(active)
            own = x[places]
            solved = _least_squares(columns[places], h, own)
            below = solved <= 0
            if not below.any():
                x[places] = solved
                break
            share = np.min(own[below] / np.maximum(own[below] - solved[below], 1e-300))
            own = np.where(below & (own <= 0), 0, own + min(share, 1.0) * (solved - own))
            own[own < 1e-12] = 0
            x[places] = own
            active[places[own == 0]] = False
    return np.maximum(x, 0)


# ------------------------------------------------------------------ plan

@dataclass
class Plan:
    """Slots, sorted by length and first, and the number of sequences and of padding ids."""

    window: int
    length: np.ndarray
    first: np.ndarray
    position: np.ndarray
    stride: np.ndarray
    n_sequences: int
    padding: int

    def positions(self, length: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Where pieces begin, in the sequences laid end to end."""
        key = lambda a, b: (a.astype(np.int64) << NUMBER_BITS) + b
        at = np.searchsorted(key(self.length, self.first), key(length, number), "right") - 1
        return self.position[at] + (number - self.first[at]) * self.stride[at]


class _Planner:
    def __init__(self, histogram: np.ndarray, window: int):
        self.window, self.left = window, histogram.astype(np.int64).copy()
        self.taken = np.zeros_like(self.left)
        self.slots: list[tuple[int, int, int, int]] = []
        self.n_sequences = self.padding = 0

    def windows(self, lengths: list[tuple[int, int]], times: int) -> None:
        """``times`` windows that each hold so many pieces of each length."""
        at = self.n_sequences * self.window
        offset = 0
        for length, many in lengths:
            for _ in range(many):
                self.slots.append((length, int(self.taken[length]), at + offset, self.window))
                self.taken[length] += times
                offset += length
            self.left[length] -= many * times
        self.n_sequences += times
        self.padding += times * (self.window - offset)

    def stream(self, lengths: list[int]) -> None:
        """All that is left of these lengths, end to end."""
        at = begin = self.n_sequences * self.window
        for length in lengths:
            self.slots.append((length, int(self.taken[length]), at, length))
            at += length * int(self.left[length])
            self.taken[length] += self.left[length]
            self.left[length] = 0
        added = -(-(at - begin) // self.window)
        self.n_sequences += added
        self.padding += added * self.window - (at - begin)

    def fill(self, gap: int, length: int) -> list[tuple[int, int]]:
        """What goes with a piece of ``length``: one or two pieces that fill the gap, else the longest that fit."""
        left = self.left.copy()
        left[length] -= 1
        if left[gap] > 0:
            return [(gap, 1)]
        some = np.flatnonzero(left[:gap // 2 + 1] > 0)
        some = some[(left[gap - some] > 0) & ((2 * some != gap) | (left[some] > 1))]
        if len(some):
            return [(int(gap - some[-1]), 1), (int(some[-1]), 1)]
        present, found = np.flatnonzero(left[:gap + 1] > 0).tolist(), []
        while present and gap:
            at = bisect_right(present, gap)
            if not at:
                break
            own = present[at - 1]
            many = min(gap // own, int(left[own]))
            found.append((own, many))
            gap -= many * own
            present = present[:at - 1]
        return found

    def greedy(self, slack: int) -> list[int]:
        """Windows of the residuals; returns the lengths that found no partners."""
        lonely = []
        for length in range(self.window - 1, 0, -1):
            while self.left[length] and length not in lonely[-1:]:
                more = self.fill(self.window - length, length)
                counts: dict[int, int] = {length: 1}
                for own, many in more:
                    counts[own] = counts.get(own, 0) + many
                short = self.window - sum(own * many for own, many in counts.items())
                if short > slack:
                    lonely.append(length)
                else:
                    self.windows(list(counts.items()), min(int(self.left[own]) // many for own, many in counts.items()))
        return lonely


def plan(histogram: np.ndarray, window: int = WINDOW, slack: int = SLACK) -> Plan:
    """Slots for ``histogram[length]`` pieces of each length up to ``window``."""
    planner = _Planner(histogram, window)
    if planner.left[window]:
        planner.windows([(window, 1)], int(planner.left[window]))
    lengths = np.flatnonzero(planner.left[:window] > 0)
    columns = combinations(lengths, window)
    x = repeat_counts(columns, planner.left[lengths])
    for c in np.argsort(-x, kind="stable"):
        if x[c] < 0.5:
            break
        counts: dict[int, int] = {}
        for own in lengths[columns[c][columns[c] < len(lengths)]].tolist():
            counts[own] = counts.get(own, 0) + 1
        times = min(round(x[c]), *(int(planner.left[own]) // many for own, many in counts.items()))
        if times:
            planner.windows(list(counts.items()), times)
    planner.stream(planner.greedy(slack))
    slots = np.array(sorted(planner.slots), np.int64).reshape(-1, 4)
    return Plan(window, *slots.T, planner.n_sequences, planner.padding)


# ------------------------------------------------------------------ pieces

def _schema(docs: DataFrame, *fields: str) -> T.StructType:
    kinds = {"ids": T.BinaryType()}
    return T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                         *(T.StructField(f, kinds.get(f, T.LongType())) for f in fields)])


def pieces(docs: DataFrame, tokenizer: str, *, window: int = WINDOW, end_id: int = END_ID,
           remembered: int = REMEMBERED_PIECES) -> DataFrame:
    """Pieces of at most a window, staged: doc_id, start, length, doc_tokens, ids, and by which scan
    task and as how-manieth of its length (task, rank)."""
    schema = _schema(docs, "start", "length", "doc_tokens", "task", "rank", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, remembered)
        end, width = np.array([end_id], own.dtype).tobytes(), own.dtype.itemsize
        task, seen = TaskContext.get().partitionId(), np.zeros(window + 1, np.int64)
        for batch in batches:
            rows, columns = [], [[] for _ in range(5)]
            for row, ids in enumerate(own.encode(batch.column("text").to_pylist())):
                ids += end
                total = len(ids) // width
                for start in range(0, total, window):
                    length = min(window, total - start)
                    rows.append(row)
                    for column, value in zip(columns, (start, length, total, seen[length],
                                                       ids[start * width:(start + length) * width])):
                        column.append(value)
                    seen[length] += 1
            *numbers, ids = columns
            start, length, total, rank = (pa.array(c, pa.int64()) for c in numbers)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int32())), start, length, total,
                 pa.array(np.full(len(rows), task), pa.int64()), rank, pa.array(ids, pa.binary())], names=schema.names)

    return common.staged(common.map_batches(docs.select("doc_id", "text"), run, schema), "pieces")


def numbered(staged: DataFrame) -> DataFrame:
    """The pieces with ``number``, their place among all pieces of their length."""
    counts = common.staged(staged.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if counts.count() <= BROADCAST_COUNTS:
        bases = F.broadcast(bases)
    return staged.join(bases, ["task", "length"]).withColumn("number", F.col("base") + F.col("rank"))


def packed(docs: DataFrame, tokenizer: str, *, window: int = WINDOW, end_id: int = END_ID, slack: int = SLACK,
           remembered: int = REMEMBERED_PIECES, digest: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, and its ids (binary, of the
    encoder's type) or, for ``digest``, ids_crc32."""
    staged = pieces(docs, tokenizer, window=window, end_id=end_id, remembered=remembered)
    histogram = np.zeros(window + 1, np.int64)
    for r in staged.groupBy("length").agg(F.count("*").alias("n")).collect():
        histogram[r["length"]] = r["n"]
    slots = plan(histogram, window, slack)
    kind = encoder(tokenizer, remembered).dtype
    last = "ids_crc32" if digest else "ids"
    schema = _schema(docs, "start", "length", "doc_tokens", "sequence_id", "offset", last)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start, length, total, number = (batch.column(c).to_numpy() for c in ("start", "length", "doc_tokens", "number"))
            at = slots.positions(length, number)
            fits = np.minimum(length, window - at % window)
            cut = np.flatnonzero(fits < length)   # of these a second piece goes to the next sequence
            rows = np.r_[np.arange(len(at)), cut]
            skipped = np.r_[np.zeros(len(at), np.int64), fits[cut]]
            size, place = np.r_[fits, length[cut] - fits[cut]], at[rows] + skipped
            own = batch.column("ids").to_pylist()
            ids = [np.frombuffer(own[r], kind)[a:a + n] for r, a, n in zip(rows.tolist(), skipped.tolist(), size.tolist())]
            if digest:
                ids = pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())
            else:
                ids = pa.array([x.tobytes() for x in ids], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows)), pa.array(start[rows] + skipped), pa.array(size),
                 pa.array(total[rows]), pa.array(place // window), pa.array(place % window), ids], names=schema.names)

    return common.map_batches(numbered(staged).select("doc_id", "start", "length", "doc_tokens", "number", "ids"), run, schema)


def sequences(packed_pieces: DataFrame, tokenizer: str, *, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, ids (array, padded to the window), n_tokens, and the begins of its pieces.

    A sequence has at most ``window`` pieces.
    """
    kind = encoder(tokenizer).dtype
    rows = packed_pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("pieces"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tokens, begins = [], [], []
            for own in batch.column("pieces").to_pylist():
                found = np.frombuffer(b"".join(p["ids"] for p in own), kind)
                tokens.append(len(found))
                begins.append([p["offset"] for p in own])
                ids.append(np.r_[found, np.full(window - len(found), pad_id, kind)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(tokens, pa.int64()),
                 pa.array(begins, pa.list_(pa.int64()))], names=["sequence_id", "ids", "n_tokens", "begins"])

    return common.map_batches(rows, run, "sequence_id long, ids array<int>, n_tokens long, begins array<long>")


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return packed(docs, tokenizer, digest=True).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
