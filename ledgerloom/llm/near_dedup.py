"""Near-duplicate groups by one-permutation hashing with optimal densification.

1. Each document becomes the set of its distinct word shingles. Documents with equal sets
   form a class, represented by its smallest doc_id, so exact copies cost one row each.
2. A class is signed by one permutation: the sorted shingle hashes fall into ``BINS`` bins
   and each bin keeps its least hash. An empty bin copies the first non-empty bin of its
   own random order (optimal densification).
3. ``BANDS`` bands of ``BINS / BANDS`` bins give the buckets. In each bucket one member is
   the centre of a star of candidate pairs, so a bucket of m members costs m - 1 pairs.
4. Candidate pairs are confirmed on the full shingle sets, and confirmed links joined to
   components by alternating large-star and small-star steps.
5. A star can miss a link between two of its outer members. What is left after the first
   stars are buckets that still span several components, and there every pair across
   components counts:
   - Large buckets that share members form a family. Its fringe, all but the members of its
     largest component, is held against the whole family, in blocks of bounded size; only
     confirmed links leave a task.
   - Small buckets get further centres, ``CENTRE_GROWTH`` times more from round to round, until
     each lies in one component or all its members have been centres.
   Nothing is capped, and pairs within a component are never compared.

A pair of similarity 0.8 shares no bucket with probability (1 - 0.8^6)^48, below 5e-7.

Defined results of ``groups``: a document without words (also null) has an empty set and is linked with
nothing; rows without a doc_id are linked with nothing; rows that share a doc_id count as
one document, whose links are united; an empty table gives an empty result; further columns
are ignored.

``deduplicated`` keeps all columns and judges rows by their texts, whatever type of id they have: of the
rows that links join, the one with the smallest doc_id stays (rows without one come last, then the first as
stored), and every row without words. Unlike texts under one doc_id both stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerloom.llm import common
from ledgerloom.llm.hashing import WordHashes
from ledgerloom.operators.lookups import APART, apart

SHINGLE_WORDS = 5
THRESHOLD_PERCENT = 80
BANDS = 48
BINS = 288
SEED = 20
# Unresolved buckets of more members are held block against block.
SMALL_BUCKET = 32
CENTRE_GROWTH = 8
BLOCK_MEMBERS = 256

SIGNED = "doc_id long, n_shingles long, class binary, bands array<long>"


# ------------------------------------------------------------------ one document

def words(text: bytes | None) -> list[bytes]:
    """Runs of characters other than ASCII white space, A-Z lower-cased."""
    return text.translate(common.LOWER).split() if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(found: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the shingles; fewer words than ``size`` are one shingle."""
    n = min(size, len(found))
    if not n:
        return np.zeros(0, dtype=np.uint64)
    w = hashes.array(found)
    acc = np.full(len(found) - n + 1, n, dtype=np.uint64)
    for j in range(n):
        acc = acc * np.uint64(0x9E3779B97F4A7C15) + w[j:len(w) - n + 1 + j]
    return np.unique(_mixed(acc))


class Signer:
    """Band keys of shingle sets."""

    def __init__(self, bins: int, bands: int):
        rng = np.random.default_rng(SEED)
        self.bands = bands
        step = (1 << 64) // bins
        self.edges = np.arange(1, bins, dtype=np.uint64) * np.uint64(step)
        # order in which an empty bin (row) looks for a non-empty one (column)
        self.order = rng.permuted(np.tile(np.arange(bins, dtype=np.int16), (bins, 1)), axis=1)
        self.factors = rng.integers(0, 1 << 63, bins // bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.offsets = rng.integers(0, 1 << 63, bands, dtype=np.uint64)

    def bins(self, shingle_set: np.ndarray) -> np.ndarray:
        begin = np.r_[0, np.searchsorted(shingle_set, self.edges)]
        filled = begin < np.r_[begin[1:], len(shingle_set)]
        values = shingle_set[np.minimum(begin, len(shingle_set) - 1)]
        empty, full = np.flatnonzero(~filled), np.flatnonzero(filled)
        if len(empty):
            values[empty] = values[full[self.order[np.ix_(empty, full)].argmin(axis=1)]]
        return values

    def band_keys(self, shingle_set: np.ndarray) -> np.ndarray:
        values = self.bins(shingle_set).reshape(self.bands, -1)
        return _mixed((values * self.factors).sum(axis=1, dtype=np.uint64) + self.offsets).view(np.int64)


def _sign(size: int, bins: int, bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signer = WordHashes(), Signer(bins, bands)
        for batch in batches:
            sizes, classes, keys = [], [], []
            for text in common.texts_of(batch):
                own = shingles(words(text), size, hashes)
                sizes.append(len(own))
                classes.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                keys.append(signer.band_keys(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "class", "bands"])

    return run


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _confirm(size: int, percent: int):
    """Pairs (a, b, text_a, text_b) whose full shingle sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, last, own = WordHashes(), None, None
        for batch in batches:
            keep = []
            for text_a, text_b in zip(common.texts_of(batch, "text_a"), common.texts_of(batch, "text_b")):
                if text_a != last:  # the pairs of a centre follow one another
                    last, own = text_a, shingles(words(text_a), size, hashes)
                keep.append(similar(own, shingles(words(text_b), size, hashes), percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    return run


# ------------------------------------------------------------------ components

def components(links: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(node, root) for every node of the links (a, b) but the roots, its smallest node."""
    edges = scratch.staged(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .where(F.col("hi") != F.col("lo")).distinct(), "links")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before, old = state, edges
        edges = scratch.staged(_small_star(_large_star(edges)), "links")
        scratch.remove(old)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node points to the least node around it."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = apart(both, "u").agg(F.min("v").alias("m")).drop(APART)
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(
        F.col("v").alias("hi"), F.least("u", "m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, point to its least neighbour."""
    least = apart(edges, "hi").agg(F.min("lo").alias("m")).drop(APART)
    return edges.join(least, "hi").select(
        F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
                          F.struct("hi", F.col("m").alias("lo")))).alias("e")
    ).select("e.hi", "e.lo").where(F.col("hi") != F.col("lo")).distinct()


# ------------------------------------------------------------------ candidates

def _bucket_members(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """(bucket, node, n): the representatives in buckets of several members."""
    signatures = signed.join(
        classes.select("class", F.col("node").alias("doc_id")), ["class", "doc_id"], "left_semi")
    placed = signatures.select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("n"),
                               F.explode("bands").alias("bucket"))
    shared = apart(placed, "bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")) \
        .where(F.col("low") < F.col("high")).select("bucket")
    return placed.join(shared, "bucket").select("bucket", "node", "n")


def _labelled(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _centres(members: DataFrame, number: int) -> DataFrame:
    """Buckets that span several components, with the new centres among their members.

    One centre is a node of the bucket's smallest component; the others, if
    ``number`` is above 1, are picked by hash, about that many in each bucket.
    """
    parts = members.groupBy("bucket", "root").agg(F.count("*").alias("size"), F.min("node").alias("node"))
    spread = apart(parts, "bucket").agg(
        F.min_by("node", "size").alias("centre"), F.sum("size").alias("in_bucket"),
        F.min("root").alias("low"), F.max("root").alias("high")).drop(APART)
    spread = spread.where(F.col("low") < F.col("high")).select("bucket", "centre", "in_bucket")
    is_centre = F.col("node") == F.col("centre")
    if number > 1:
        is_centre |= F.pmod(F.xxhash64("node", "bucket"), F.col("in_bucket")) < number
    return members.join(spread, "bucket").select("bucket", "node", "n", "root", "in_bucket", is_centre.alias("is_centre"))


def _stars(marked: DataFrame, percent: int) -> DataFrame:
    """Distinct candidate pairs (a, b) of centres and members of other components."""
    centres = marked.where("is_centre").select(
        "bucket", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("root").alias("root_a"))
    near_size = 100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")
    return marked.join(centres, "bucket").where((F.col("root") != F.col("root_a")) & near_size).select(
        F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int, scratch: common.Scratch) -> DataFrame:
    # the predicate holds for all pairs; Spark thins the texts by a Bloom filter only where it sees one
    pairs = scratch.staged(pairs, "pairs").where("a < b")
    one = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = one.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    return common.map_batches(both.select("a", "b", "text_a", "text_b"), _confirm(size, percent), "a long, b long")


# ------------------------------------------------------------------ families

def _sets(size: int):
    """(node, shingles) of (node, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(words(text), size, hashes).tobytes() for text in common.texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["node", "shingles"])

    return run


def _blocks(large: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(family, fringe_block, member_block, is_fringe, node, root): who meets whom.

    ``large``: (bucket, node, root) of large unresolved buckets. A fringe member goes to all
    member blocks of its own fringe block, a member to all fringe blocks.
    """
    first = apart(large, "bucket").agg(F.min("node").alias("a")).drop(APART)
    families = components(large.join(first, "bucket").select("a", F.col("node").alias("b")), scratch)
    nodes = large.select("node", "root").distinct().join(
        families.withColumnRenamed("root", "family"), "node", "left").withColumn("family", F.coalesce("family", "node"))
    nodes = scratch.staged(nodes, "families")
    parts = nodes.groupBy("family", "root").agg(F.count("*").alias("size"))
    sizes = apart(parts, "family").agg(
        F.sum("size").alias("members"), F.max("size").alias("largest"), F.max_by("root", "size").alias("main")).drop(APART)
    blocks = lambda n: F.ceil(n / F.lit(BLOCK_MEMBERS)).cast("long")
    sizes = sizes.where(F.col("members") > F.col("largest")).select(
        "family", "main", blocks(F.col("members") - F.col("largest")).alias("fringe_blocks"),
        blocks(F.col("members")).alias("member_blocks"))
    placed = nodes.join(sizes, "family")
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    as_member = placed.select("family", "node", "root", F.lit(False).alias("is_fringe"),
                              mine("member_blocks").alias("member_block"), F.explode(every("fringe_blocks")).alias("fringe_block"))
    as_fringe = placed.where(F.col("root") != F.col("main")).select(
        "family", "node", "root", F.lit(True).alias("is_fringe"), F.explode(every("member_blocks")).alias("member_block"),
        mine("fringe_blocks").alias("fringe_block"))
    return as_member.unionByName(as_fringe)


def _meet(percent: int):
    """Confirmed links of one fringe block and one member block."""
    def run(block: pa.Table) -> pa.Table:
        is_fringe = np.asarray(block.column("is_fringe"))
        node, root = np.asarray(block.column("node")), np.asarray(block.column("root"))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in block.column("shingles").to_pylist()]
        member, fringe = np.flatnonzero(~is_fringe), np.flatnonzero(is_fringe)
        a, b = [], []
        if len(member) and len(fringe):
            size = np.array([len(sets[m]) for m in member])
            _, token = np.unique(np.concatenate([sets[m] for m in member]), return_inverse=True)
            known = np.unique(np.concatenate([sets[m] for m in member]))
            begin = np.cumsum(np.r_[0, size[:-1]])
            for f in fringe:
                marked = np.zeros(len(known) + 1, dtype=np.int64)
                place = np.searchsorted(known, sets[f])
                place[place == len(known)] = 0
                marked[place[known[place] == sets[f]]] = 1
                shared = np.add.reduceat(marked[token], begin)
                near = (100 * shared >= percent * (size + len(sets[f]) - shared)) & (root[member] != root[f])
                a += [node[f]] * int(near.sum())
                b += node[member[near]].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _family_links(large: DataFrame, texts: DataFrame, size: int, percent: int, scratch: common.Scratch) -> DataFrame:
    placed = scratch.staged(_blocks(large, scratch), "blocks")
    listed = scratch.staged(placed.select("node", F.lit(1).alias("listed")).distinct(), "listed").where("listed > 0")
    sets = common.map_batches(texts.join(listed, "node").select("node", "text"), _sets(size), "node long, shingles binary")
    met = placed.join(sets, "node").groupBy("family", "fringe_block", "member_block").applyInArrow(
        _meet(percent), "a long, b long")
    return met.distinct()


# ------------------------------------------------------------------ operator

def groups(docs: DataFrame, *, shingle: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT,
           bins: int = BINS, bands: int = BANDS) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least doc_id linked), kept."""
    common.configure(docs.sparkSession)
    scratch = common.Scratch(docs.sparkSession, "near-dedup")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = scratch.staged(common.map_batches(texts, _sign(shingle, bins, bands), SIGNED), "signed")
    named = signed.where(F.col("class").isNotNull() & F.col("doc_id").isNotNull())
    classes = scratch.staged(named.groupBy("class").agg(F.min("doc_id").alias("node")), "classes")
    # rows that share a doc_id are one document: tie their classes together
    repeated = named.join(classes, "class").groupBy("doc_id").agg(
        F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("a", "b")
    members = scratch.staged(_bucket_members(signed, classes), "buckets")
    in_buckets = scratch.staged(members.groupBy("node").agg(F.max("n").alias("n")), "listed").where("n > 0")
    held = scratch.staged(
        texts.withColumnRenamed("doc_id", "node").join(in_buckets.select("node"), "node").select("node", "text"), "texts")

    marked = scratch.staged(_centres(members.withColumn("root", F.col("node")), 1), "centres")
    roots = components(
        repeated.unionByName(_confirmed(_stars(marked, percent), held, shingle, percent, scratch)), scratch)
    as_links = lambda known: known.select(F.col("node").alias("a"), F.col("root").alias("b"))
    left = scratch.staged(_centres(_labelled(marked.where(~F.col("is_centre")).select("bucket", "node", "n"), roots),
                                   CENTRE_GROWTH), "centres")
    large = left.where(F.col("in_bucket") > SMALL_BUCKET)
    if not large.isEmpty():
        roots = components(as_links(roots).unionByName(
            _family_links(large.select("bucket", "node", "root"), held, shingle, percent, scratch)), scratch)
    members, number = left.where(F.col("in_bucket") <= SMALL_BUCKET).select("bucket", "node", "n"), CENTRE_GROWTH
    while True:
        marked = scratch.staged(_centres(_labelled(members, roots), number), "centres")
        if marked.isEmpty():
            break
        roots = components(as_links(roots).unionByName(
            _confirmed(_stars(marked, percent), held, shingle, percent, scratch)), scratch)
        members, number = marked.where(~F.col("is_centre")).select("bucket", "node", "n"), number * CENTRE_GROWTH

    labelled = _labelled(classes, roots).select("class", "root")
    by_class = apart(labelled, "class").agg(F.min("root").alias("root")).drop(APART)
    component = F.least("doc_id", "root")
    out = signed.select("doc_id", "n_shingles", "class").join(by_class, "class", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))
    rated = common.staged(out.withColumn("kept", kept()), "groups")
    scratch.remove()
    return rated


def kept() -> Column:
    return F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))


def _own_ids(docs: DataFrame) -> bool:
    """Is the doc_id a whole number that no two rows share? Reads the ids alone."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return False
    by_id = docs.groupBy("doc_id").agg(F.count("*").alias("rows"))
    return by_id.where(F.col("doc_id").isNull() | (F.col("rows") > 1)).isEmpty()


def deduplicated(docs: DataFrame, *, shingle: int = SHINGLE_WORDS, percent: int = THRESHOLD_PERCENT,
                 bins: int = BINS, bands: int = BANDS) -> DataFrame:
    """The documents with one of each group: its smallest doc_id. Rows without words stay.

    Where ids do not tell rows apart, rows are numbered in a staged copy first.
    """
    columns, row = docs.columns, "_row"
    while row in columns:
        row += "_"
    own = _own_ids(docs)
    rows = docs.withColumn(row, F.col("doc_id").cast("long")) if own else common.staged(
        docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    rated = groups(rows.select(F.col(row).alias("doc_id"), "text"), shingle=shingle, percent=percent, bins=bins, bands=bands)
    if own:
        dropped = rated.where(~F.col("kept")).select(F.col("doc_id").alias(row))
    else:
        linked = rated.where(F.col("n_shingles") > 0).select(F.col("doc_id").alias(row), F.col("component_id").alias("_group"))
        order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", row)
        ranked = linked.join(rows.select(row, order.alias("_order")), row)
        first = apart(ranked, "_group").agg(F.min("_order").alias("_first")).drop(APART)
        dropped = ranked.join(first, "_group").where(F.col("_order") != F.col("_first")).select(row)
    return rows.join(common.staged(dropped, "dropped"), row, "left_anti").select(*columns)
