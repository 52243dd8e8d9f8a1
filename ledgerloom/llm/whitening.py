"""Whitening of embeddings by a mixed-precision eigendecomposition.

1. Entries become whole numbers, floor(LEVELS * entry) + OFFSET, so that sums over any number of
   executors are exact. Spark adds up counts, sums and the products of entries centred on the
   rounded mean; only these, dimension by dimension, reach the driver.
2. The covariance, exact as a fraction, is taken to extended precision and its eigenvectors
   found in float32. Matrix-multiplication steps of Ogita and Aishima then correct them: with
   R = I - X'X and S = X'AX, X becomes X + XE, where E_ij = (S_ij + l_j R_ij) / (l_j - l_i), which
   doubles the right digits each time.
3. Where eigenvalues lie closer than the error bound of a step, or so close that rounding decides
   the quotient, it says nothing. The step then makes the cluster's vectors orthogonal only, and a
   sub-solve rotates them: the covariance is projected on the cluster with its mean eigenvalue
   taken off, so the small differences are large in the projected matrix, and its
   eigenvectors (float64) turn the cluster.
4. Each vector is centred, projected on the leading components and divided by the root of the
   eigenvalue, in batches where it is scanned.

Tasks add up what they read before Spark groups it, so no group is larger than the number of tasks,
and whatever the driver holds has the size of dimensions squared.

Defined results: vectors that are null, empty, or hold null or non-finite entries are dropped; so are those
whose length differs from the commonest one (of equally common ones, the longest). Entries beyond
2^40 levels count as 2^40. Repeated rows count as often as they come; a null vec_id stays null. Ties of
eigenvalues give any orthonormal basis of their space, the same for all rows. A component
without variance has explained 0 (null where no vector varies) and null as whitened; identity_error covers the
others, null if there is none. A deviation beyond a long is null. An empty table gives an empty
result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from ledgerloom.llm import common

LEVELS = 64
OFFSET = 1_000_000
COMPONENTS = 32
LARGEST_LEVEL = 1 << 40
MAX_STEPS = 40

EXTENDED = np.longdouble
# Eigenvalues nearer than this share of the matrix's norm are told apart by sub-solves alone: the square of a
# quotient's rounding error then stays below the last digit.
CLUSTER_GAP = float(np.sqrt(np.finfo(EXTENDED).eps))
EXACT_DOUBLE, LONG = 1 << 53, 1 << 63
_WHOLE = pa.decimal128(38, 0)


# ------------------------------------------------------------------ eigenvectors

def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One refinement step: vectors, eigenvalues, the largest correction, and the gap below which they cluster."""
    r = np.eye(len(a), dtype=EXTENDED) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2  # else rounding over a small gap leaves vectors that are not orthogonal
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    bound = 2 * (np.sqrt((off * off).sum()) + np.sqrt((a * a).sum()) * np.sqrt((r * r).sum()))
    bound = max(bound, CLUSTER_GAP * np.sqrt((a * a).sum()))
    apart = values[None, :] - values[:, None]
    wide = np.abs(apart) > bound
    e = np.where(wide, (s + values[None, :] * r) / np.where(wide, apart, 1), r / 2)
    return x + x @ e, values, np.abs(e).max(), bound


def clusters(values: np.ndarray, bound: float) -> list[np.ndarray]:
    """Places of eigenvalues that follow one another within ``bound``, two or more together."""
    order = np.argsort(values)
    breaks = np.flatnonzero(np.diff(values[order]) > bound) + 1
    return [group for group in np.split(order, breaks) if len(group) > 1]


def _sub_solve(a: np.ndarray, x: np.ndarray, group: np.ndarray, noise: float) -> bool:
    """Rotate the vectors of a cluster (in place); False where nothing but noise is left to tell them apart."""
    own = x[:, group]
    middle = np.trace(own.T @ (a @ own)) / len(group)
    small = own.T @ (a @ own - middle * own)
    small = (small + small.T) / 2
    off = np.abs(small - np.diag(np.diag(small))).max()
    if off <= noise:
        return False
    _, turn = np.linalg.eigh((small / np.abs(small).max()).astype(np.float64))
    x[:, group] = own @ turn.astype(EXTENDED)
    return True


def eigen(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision."""
    scale = np.abs(covariance).max()
    if not scale > 0:
        return np.zeros(len(covariance), EXTENDED), np.eye(len(covariance), dtype=EXTENDED)
    a = covariance.astype(EXTENDED) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(EXTENDED)
    noise = 2 * len(a) * np.finfo(EXTENDED).eps
    for _ in range(MAX_STEPS):
        x, values, moved, bound = _step(a, x)
        turned = [_sub_solve(a, x, group, noise) for group in clusters(values, bound)]
        if moved * moved <= noise and not any(turned):  # what is left is the square of the last correction
            break
    x = _step(a, x)[0]
    x /= np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(x))])
    return values[order] * scale, x * signs


# ------------------------------------------------------------------ exact sums

def levels(entries: np.ndarray) -> np.ndarray:
    """The whole numbers of entries: floor(LEVELS * entry) + OFFSET."""
    return np.clip(np.floor(entries * LEVELS), -LARGEST_LEVEL, LARGEST_LEVEL).astype(np.int64) + OFFSET


def vectors(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the batch with a sound vector of this size, and their whole numbers."""
    column = batch.column(batch.schema.get_field_index("embedding"))
    rows = np.flatnonzero(pc.list_value_length(column).fill_null(-1).to_numpy() == size)
    flat = column.take(pa.array(rows)).flatten().cast(pa.float64()).fill_null(np.nan)
    entries = flat.to_numpy(zero_copy_only=False).reshape(len(rows), size)
    sound = np.isfinite(entries).all(axis=1)
    return rows[sound], levels(entries[sound])


def blocks(whole: np.ndarray) -> Iterator[np.ndarray]:
    """Blocks of rows whose products add up exactly in float64, or single rows where none do."""
    largest = max(1, int(np.abs(whole).max(initial=0)))
    rows = max(1, EXACT_DOUBLE // (largest * largest + 1))
    for begin in range(0, len(whole), rows):
        yield whole[begin:begin + rows]


def products(block: np.ndarray) -> np.ndarray:
    """X'X of whole numbers, exact: by float64 where the sums fit, else by Python's integers."""
    largest = int(np.abs(block).max(initial=0))
    if len(block) * largest * largest < EXACT_DOUBLE:
        real = block.astype(np.float64)
        return (real.T @ real).astype(np.int64)
    own = block.astype(object)
    return own.T @ own


class WholeSum:
    """Exact sum of arrays of whole numbers: in 64 bits as long as they fit."""

    def __init__(self, shape: tuple[int, ...]):
        self.total, self.near, self.bound = np.zeros(shape, object), np.zeros(shape, np.int64), 0

    def add(self, values: np.ndarray) -> None:
        largest = int(np.abs(values).max(initial=0))
        if values.dtype == object:
            self.total = self.total + values
            return
        if self.bound + largest >= LONG:
            self.total, self.near, self.bound = self.total + self.near, np.zeros_like(self.near), 0
        self.near = self.near + values
        self.bound += largest

    def result(self) -> np.ndarray:
        return self.total + self.near


def _decimals(values: np.ndarray) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], _WHOLE)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, place, n, total) of a task, for each size of vector it meets."""
    counts: dict[int, int] = {}
    totals: dict[int, WholeSum] = {}
    for batch in batches:
        for size in pc.unique(pc.list_value_length(batch.column(0)).drop_null()).to_pylist():
            if not size:
                continue
            _, whole = vectors(batch, size)
            if len(whole):
                # a batch is far below 2^20 rows, and levels below 2^41
                totals.setdefault(size, WholeSum((size,))).add(whole.sum(axis=0))
                counts[size] = counts.get(size, 0) + len(whole)
    for size, total in totals.items():
        yield pa.RecordBatch.from_arrays([
            pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()),
            pa.array([counts[size]] * size, pa.int64()), _decimals(total.result())], names=["size", "place", "n", "total"])


def _products(size: int, centre: np.ndarray):
    """(place, other, total) of a task: sums of products of centred entries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = WholeSum((size, size))
        for batch in batches:
            for block in blocks(vectors(batch, size)[1] - centre):
                total.add(products(block))
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), _decimals(total.result()[i, j])], names=["place", "other", "total"])

    return run


# ------------------------------------------------------------------ operator

@dataclass(frozen=True)
class Whitening:
    """What a fit gives: as large as the vectors' size squared, whatever the number of rows."""

    n: int
    size: int
    centre: np.ndarray         # rounded mean, whole numbers
    rest: np.ndarray           # sum of the entries less n times the centre, Python integers
    components: np.ndarray     # (size, k), unit columns
    eigenvalues: np.ndarray    # (k,)
    explained: np.ndarray      # (k,)
    varies: np.ndarray         # (k,) booleans

    def project(self, whole: np.ndarray) -> np.ndarray:
        """Whitened rows; nan on components without variance."""
        mean = np.array([float(EXTENDED(int(r)) / self.n) for r in self.rest])
        root = np.sqrt(np.where(self.varies, self.eigenvalues, np.nan))
        return (((whole - self.centre) - mean) @ self.components) / root

    def deviations(self, whole: np.ndarray) -> list[int | None]:
        """Exact sum of (n * x - sum)^2 of each row; None beyond a long."""
        near = whole - self.centre
        bound = self.n * int(np.abs(near).max(initial=0)) + max(abs(int(r)) for r in self.rest)
        if self.size * bound * bound < LONG:
            apart = near * self.n - self.rest.astype(np.int64)
            return (apart * apart).sum(axis=1).tolist()
        apart = near.astype(object) * self.n - self.rest
        return [v if v < LONG else None for v in (apart * apart).sum(axis=1)]


def _narrow(embeddings: DataFrame) -> DataFrame:
    return embeddings.select("embedding")


def fit(embeddings: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit to all sound vectors of the column ``embedding``; None where there are none."""
    sums = common.staged(common.map_batches(_narrow(embeddings), _sums, "size int, place int, n long, total decimal(38,0)")
                         .groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")), "sums")
    found = sums.where("place = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if found is None:
        return None
    n, size = found["n"], found["size"]
    total = {r["place"]: int(r["total"]) for r in sums.where(F.col("size") == size).collect()}
    centre = [round(total[i] / n) for i in range(size)]
    rest = np.array([total[i] - n * centre[i] for i in range(size)], dtype=object)
    pairs = common.map_batches(_narrow(embeddings), _products(size, np.array(centre, np.int64)),
                               "place int, other int, total decimal(38,0)")
    gram = np.zeros((size, size), dtype=object)
    for r in pairs.groupBy("place", "other").agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect():
        gram[r["place"], r["other"]] = gram[r["other"], r["place"]] = int(r["total"])
    covariance = (gram * n - np.outer(rest, rest)).astype(EXTENDED) / EXTENDED(n) / EXTENDED(n)
    values, x = eigen(covariance)
    trace = np.trace(covariance)
    k = min(components, size)
    varies = values[:k] > size * np.finfo(np.float64).eps * values[0]
    explained = np.where(varies, values[:k] / trace, 0) if trace > 0 else np.full(k, np.nan)
    return Whitening(n, size, np.array(centre, np.int64), rest, x[:, :k].astype(np.float64), values[:k].astype(np.float64),
                     explained.astype(np.float64), np.asarray(varies, bool))


def identity_error(embeddings: DataFrame, fitted: Whitening) -> float | None:
    """The largest entry of the whitened vectors' covariance less the identity, over components that vary.

    Vectors are centred on their mean before they are multiplied.
    """
    if not fitted.varies.any():
        return None
    k = int(fitted.varies.sum())   # eigenvalues fall, so these come first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            own = fitted.project(vectors(batch, fitted.size)[1])[:, :k]
            total += own.T @ own
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])],
                                         names=["place", "other", "total"])

    sums = common.map_batches(_narrow(embeddings), run, "place int, other int, total double").groupBy("place", "other").agg(
        F.sum("total").alias("total"))
    entry = F.abs(F.col("total") / F.lit(fitted.n) - F.when(F.col("place") == F.col("other"), F.lit(1.0)).otherwise(F.lit(0.0)))
    return sums.agg(F.max(entry)).first()[0]


def _nulls(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), mask=np.isnan(values))


def whitened(embeddings: DataFrame, fitted: Whitening) -> DataFrame:
    """vec_id and ``whitened`` (array, leading components first) of each sound vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, whole = vectors(batch, fitted.size)
            own = fitted.project(whole)
            k = own.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * k, pa.int32()), _nulls(own.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), lists], names=["vec_id", "whitened"])

    schema = T.StructType([_id_field(embeddings), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return common.map_batches(embeddings.select("vec_id", "embedding"), run, schema)


def _id_field(embeddings: DataFrame) -> T.StructField:
    return T.StructField("vec_id", embeddings.schema["vec_id"].dataType)


def report(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each sound vector and component: vec_id, component, n, deviation, whitened, explained,
    identity_error."""
    schema = T.StructType([
        _id_field(embeddings), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    fitted = fit(embeddings, components)
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    error = identity_error(embeddings, fitted)
    k = len(fitted.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, whole = vectors(batch, fitted.size)
            m = len(rows)
            deviation = pa.array(fitted.deviations(whole), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, fitted.n), pa.int64()), deviation, _nulls(fitted.project(whole).ravel()),
                _nulls(np.tile(fitted.explained, m)), pa.array([error] * (m * k), pa.float64())], names=schema.names)

    return common.map_batches(embeddings.select("vec_id", "embedding"), run, schema)
