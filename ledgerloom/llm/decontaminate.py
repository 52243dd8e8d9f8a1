"""Benchmark decontamination with suffix arrays over the training text.

The documents are cut into shards of about ``SHARD_WORDS`` words as they are scanned, and
each shard gets a suffix array over its words. Every suffix of every benchmark item is
searched in it by binary search, word by word, which gives the suffix's longest verbatim
match in the shard and, ten words deep (or at the end of a shorter item), the places where
a window of the item occurs. Words under such a place are hit, and a document with a hit
word is removed by ``decontaminated``.

Shards never leave their scan task, so the documents are read once and not shuffled. Only
the benchmark travels: it is broadcast in blocks of at most about ``BLOCK_BYTES`` of text,
one block after the other, so that its size never decides whether a run fits in memory.

Defined results: a null or empty text has no words and no hits; items with a null or empty
text have no windows; items that repeat an item_id count once; windows of items without an
id hit words but name no item; repeated documents are rated one by one; an empty table gives
an empty result. A column that has the name of a result column is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.llm import common

WINDOW_WORDS = 10
SHARD_WORDS = 1 << 20
BLOCK_BYTES = 16 * 1024 * 1024
# Pairs of document and item that are told apart at once.
PAIR_CHUNK = 1 << 21

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FINDINGS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("spans", SPANS),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

# Letters, digits and bytes from 0x80 on are kept, lower-cased; all others separate words.
_KEEP = bytes(
    (b + 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words(text: bytes | None) -> list[bytes]:
    """The words of a text: runs of a-z (A-Z lower-cased), 0-9 and non-ASCII characters."""
    return text.translate(_KEEP).split() if text else []


# ------------------------------------------------------------------ benchmark block

@dataclass
class Block:
    """A block of benchmark items as word ids, with the suffixes to search."""

    vocabulary: dict[bytes, int]
    ids: np.ndarray        # words of all items one after the other, 0 behind each item
    left: np.ndarray       # words from each position to the end of its item
    need: np.ndarray       # window length where a window starts, else 0
    item: np.ndarray       # number of the item of each position
    names: list[str | None]
    longest: int


def build_block(items: list[tuple[str | None, bytes | None]], window: int) -> Block:
    vocabulary: dict[bytes, int] = {}
    ids, left, need, item, names = [], [], [], [], []
    for name, text in items:
        found = words(text)
        if not found:
            continue
        n = len(found)
        ids += [vocabulary.setdefault(w, len(vocabulary) + 1) for w in found] + [0]
        left += [*range(n, 0, -1), 0]
        need += ([window] * (n - window + 1) + [0] * window) if n >= window else [n] + [0] * n
        item += [len(names)] * (n + 1)
        names.append(name)
    as_array = lambda x: np.asarray(x, dtype=np.int64)
    return Block(vocabulary, as_array(ids), as_array(left), as_array(need), as_array(item), names,
                 int(max(left, default=0)))


# ------------------------------------------------------------------ suffix array

def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of non-zero words, sorted by the words that follow, up to a 0 or ``depth``.

    ``ids`` ends in at least ``2 * depth + 4`` zeros. Prefix doubling; each round sorts only the
    suffixes that still tie and go on.
    """
    pos = np.flatnonzero(ids)
    if not len(pos):
        return pos
    width = 3 if int(ids.max()) < 1 << 21 else 2
    bits = 64 // width
    key = ids[pos].astype(np.uint64)
    goes_on = np.ones(len(pos), dtype=bool)
    for step in range(1, width):
        following = np.where(goes_on, ids[pos + step], 0)
        goes_on &= following > 0
        key = (key << np.uint64(bits)) | following.astype(np.uint64)
    by_key = np.argsort(key)
    pos, key, goes_on = pos[by_key], key[by_key], goes_on[by_key]
    rank = np.zeros(len(ids), dtype=np.int64)
    full = np.zeros(len(ids), dtype=bool)     # the first ``length`` words are all there
    full[pos] = goes_on
    first = np.r_[True, key[1:] != key[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(pos)), 0))
    rank[pos] = start + 1
    single = first & np.r_[first[1:], True]
    open_slots = np.flatnonzero(~single & goes_on)
    length = width
    while length < depth and len(open_slots):
        members = pos[open_slots]
        group, following = rank[members], rank[members + length]
        order = np.lexsort((following, group))
        members, group, following = members[order], group[order], following[order]
        pos[open_slots] = members
        new = np.r_[True, (group[1:] != group[:-1]) | (following[1:] != following[:-1])]
        start = np.maximum.accumulate(np.where(new, open_slots, 0))
        still = full[members] & full[members + length]
        rank[members] = start + 1
        full[members] = still
        single = new & np.r_[new[1:], True]
        open_slots = open_slots[~single & still]
        length *= 2
    return pos


def bounds(ids, order, low, high, depth, wanted, upper: bool):
    """Binary search, for many suffixes at once, in the column ``depth`` words behind."""
    low, high = low.copy(), high.copy()
    while True:
        busy = np.flatnonzero(low < high)
        if not len(busy):
            return low
        middle = (low[busy] + high[busy]) >> 1
        seen = ids[order[middle] + depth]
        right = seen <= wanted[busy] if upper else seen < wanted[busy]
        low[busy[right]] = middle[right] + 1
        high[busy[~right]] = middle[~right]


def search(ids: np.ndarray, order: np.ndarray, block: Block):
    """Longest match of every suffix of the block, with its range in ``order``.

    Returns (length, low, high) of the longest match, and (low, high) at the window length.
    """
    total = len(block.ids)
    length = np.zeros(total, dtype=np.int64)
    low, high = np.zeros(total, dtype=np.int64), np.full(total, len(order), dtype=np.int64)
    window_low, window_high = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.int64)
    active = np.flatnonzero(block.left > 0)
    depth = 0
    while len(active):
        wanted = block.ids[active + depth]
        new_low = bounds(ids, order, low[active], high[active], depth, wanted, upper=False)
        new_high = bounds(ids, order, new_low, high[active], depth, wanted, upper=True)
        found = new_low < new_high
        active, new_low, new_high = active[found], new_low[found], new_high[found]
        depth += 1
        low[active], high[active], length[active] = new_low, new_high, depth
        complete = block.need[active] == depth
        window_low[active[complete]], window_high[active[complete]] = new_low[complete], new_high[complete]
        active = active[block.left[active] > depth]
    return length, low, high, window_low, window_high


def ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of all ranges [low, high), one after the other."""
    sizes = high - low
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - (ends - sizes), sizes)


# ------------------------------------------------------------------ shards

class Shard:
    """Documents of one shard as word ids; a 0 stands behind each document."""

    def __init__(self, block: Block):
        self.block = block
        self.parts: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.total = 0

    def add(self, text: bytes | None) -> None:
        found = words(text)
        part = np.zeros(len(found) + 1, dtype=np.int64)
        part[:-1] = np.fromiter(map(self.block.vocabulary.get, found, repeat(0)), np.int64, len(found))
        self.parts.append(part)
        self.sizes.append(len(found))
        self.total += len(found) + 1

    def indexed(self):
        pad = np.zeros(2 * self.block.longest + 4, dtype=np.int64)
        ids = np.concatenate([*self.parts, pad])
        order = suffix_array(ids, self.block.longest)
        starts = np.cumsum([0, *(s + 1 for s in self.sizes)])[:-1]
        return ids, order, starts

    def findings(self):
        """For each document: words, hit spans, names of the items with occurring windows."""
        block, n_docs = self.block, len(self.sizes)
        ids, order, starts = self.indexed()
        _, _, _, low, high = search(ids, order, block)
        hit = np.flatnonzero(high > low)
        spans: list[list[dict]] = [[] for _ in range(n_docs)]
        named: list[list[str]] = [[] for _ in range(n_docs)]
        if not len(hit):
            return self.sizes, spans, named
        # equal windows of several items have one range: mark each range once
        windows, of_window = np.unique(
            np.stack([low[hit], high[hit], block.need[hit]], axis=1), axis=0, return_inverse=True)
        of_window = of_window.reshape(-1)
        places = order[ranges(windows[:, 0], windows[:, 1])]
        sizes = windows[:, 1] - windows[:, 0]
        change = np.zeros(len(ids) + 1, dtype=np.int64)
        np.add.at(change, places, 1)
        np.add.at(change, places + np.repeat(windows[:, 2], sizes), -1)
        edges = np.diff(np.r_[0, (np.cumsum(change) > 0).astype(np.int8)])
        begins, ends = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
        for doc, a, b in zip(np.searchsorted(starts, begins, "right") - 1, begins, ends):
            spans[doc].append({"start": int(a - starts[doc]), "end": int(b - starts[doc])})
        for doc, item in self._pairs(windows, of_window, hit, places, sizes, starts):
            named[doc].append(block.names[item])
        return self.sizes, spans, named

    def _pairs(self, windows, of_window, hit, places, sizes, starts):
        """Distinct pairs of document and item, in chunks of bounded size."""
        n_items = len(self.block.names)
        docs = np.searchsorted(starts, places, "right") - 1
        seen = np.unique(np.repeat(np.arange(len(windows)), sizes) * len(self.sizes) + docs)
        window, doc = np.divmod(seen, len(self.sizes))
        listed = np.unique(of_window * n_items + self.block.item[hit])
        holder, item = np.divmod(listed, n_items)
        first = np.searchsorted(holder, np.arange(len(windows) + 1))
        many = first[window + 1] - first[window]
        chunk = np.cumsum(many) // PAIR_CHUNK
        pairs = np.zeros(0, dtype=np.int64)
        for c in np.unique(chunk):
            own = chunk == c
            rows = ranges(first[window[own]], first[window[own] + 1])
            pairs = np.union1d(pairs, np.repeat(doc[own], many[own]) * n_items + item[rows])
        for pair in pairs:
            d, i = divmod(int(pair), n_items)
            if self.block.names[i] is not None:
                yield d, i


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
        if out and span["start"] <= out[-1]["end"]:
            out[-1]["end"] = max(out[-1]["end"], span["end"])
        else:
            out.append(dict(span))
    return out


def _search_block(handle, text: str, result: str, shard_words: int):
    """Batches with the findings of one more benchmark block merged into column ``result``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        shard = Shard(handle.value)

        def close():
            sizes, spans, named = shard.findings()
            at = 0
            for batch in held:
                n, place = batch.num_rows, batch.schema.get_field_index(result)
                rows = []
                for i, before in zip(range(at, at + n), batch.column(place).to_pylist()):
                    rows.append({
                        "n_words": sizes[i],
                        "spans": _merged(before["spans"] + spans[i]),
                        "items": sorted({*before["items"], *named[i]}),
                    })
                at += n
                kind = pa.struct([("n_words", pa.int64()), ("spans", _SPAN_ARROW), ("items", pa.list_(pa.string()))])
                columns = [*batch.columns]
                columns[place] = pa.array(rows, type=kind)
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        for batch in batches:
            held.append(batch)
            for value in common.texts_of(batch, text):
                shard.add(value)
            if shard.total >= shard_words:
                yield from close()
                held, shard = [], Shard(handle.value)
        if held:
            yield from close()

    return run


def _longest_block(handle, shard_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, doc_ids = Shard(handle.value), []

        def close():
            ids, order, starts = shard.indexed()
            length, low, _, _, _ = search(ids, order, shard.block)
            found = np.flatnonzero(length)
            place = order[low[found]] if len(found) else found
            doc = np.searchsorted(starts, place, "right") - 1
            block = shard.block
            n_item = np.searchsorted(block.item, block.item[found])
            yield pa.RecordBatch.from_arrays([
                pa.array([block.names[i] for i in block.item[found]], pa.string()),
                pa.array(found - n_item, pa.int64()), pa.array(length[found], pa.int64()),
                pa.array([doc_ids[d] for d in doc], pa.int64()), pa.array(place - starts[doc], pa.int64()),
            ], names=["item_id", "position", "n_words", "doc_id", "doc_position"])

        for batch in batches:
            for doc_id, value in zip(batch.column(0).to_pylist(), common.texts_of(batch)):
                doc_ids.append(doc_id)
                shard.add(value)
            if shard.total >= shard_words:
                yield from close()
                shard, doc_ids = Shard(handle.value), []
        if doc_ids:
            yield from close()

    return run


# ------------------------------------------------------------------ operator

def _blocks(benchmark: DataFrame, item_id: str, text: str, block_bytes: int, window: int):
    """The benchmark in blocks of about ``block_bytes``, built one at a time."""
    items = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(text).cast("binary").alias("text"))
    items = items.where(F.length("text") > 0)
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    number = max(1, -(-size // block_bytes))
    for b in range(number):
        mine = items if number == 1 else items.where(F.pmod(F.xxhash64("name", "text"), F.lit(number)) == b)
        rows = mine.distinct().collect()
        yield build_block(sorted(((r.name, bytes(r.text)) for r in rows), key=lambda r: (r[0] or "", r[1])), window), number


def with_findings(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW_WORDS, result: str = "contamination",
                  shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column: words, hit word spans and items that occur."""
    spark = docs.sparkSession
    common.configure(spark)
    nothing = F.struct(F.lit(0).cast("long").alias("n_words"), F.array().cast(SPANS).alias("spans"),
                       F.array().cast("array<string>").alias("items")).cast(FINDINGS)
    out = docs.drop(result).withColumn(result, nothing)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in out.schema])
    for block, number in _blocks(benchmark, item_id, item_text, block_bytes, window):
        handle = spark.sparkContext.broadcast(block)
        out = common.map_batches(out, _search_block(handle, text, result, shard_words), schema)
        if number > 1:  # one block at a time in the workers' memory
            out = common.staged(out, "decontaminate")
    return out


def contaminated(result: str = "contamination") -> Column:
    return F.size(F.col(f"{result}.spans")) > 0


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any word under a benchmark window, columns unchanged."""
    # the findings get a name that no column of the documents has
    result = "_contamination"
    while result in docs.columns:
        result += "_"
    return with_findings(docs, benchmark, result=result, **options).where(~contaminated(result)).drop(result)


def longest_matches(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW_WORDS,
                    shard_words: int = SHARD_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each suffix of each item: its longest verbatim match in all documents, and where.

    One row per item and word position with a match; each shard sends its best match only.
    """
    spark = docs.sparkSession
    found = None
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    for block, _ in _blocks(benchmark, "item_id", "text", block_bytes, window):
        handle = spark.sparkContext.broadcast(block)
        part = common.map_batches(texts, _longest_block(handle, shard_words),
                                  "item_id string, position long, n_words long, doc_id long, doc_position long")
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("n_words", (-F.col("doc_id")).alias("d"), (-F.col("doc_position")).alias("p")))
    return found.groupBy("item_id", "position").agg(best.alias("b")).select(
        "item_id", "position", F.col("b.n_words").alias("n_words"),
        (-F.col("b.d")).alias("doc_id"), (-F.col("b.p")).alias("doc_position"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, hit words, items and a digest of the items' ids."""
    hits = F.aggregate("contamination.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    items = F.col("contamination.items")
    return with_findings(docs.select("doc_id", "text"), benchmark).select(
        "doc_id", F.col("contamination.n_words").alias("n_words"), hits.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(items)), 256).alias("items_sha256"),
        contaminated().alias("contaminated"))
