"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Each source has a target number of words. Its documents are taken for as many complete epochs
as fit; the fraction that remains is drawn without replacement: a document's key is an
exponential number, -ln(u) / quality, so better documents tend to come first, and documents
are taken in the order of their keys until the running sum of words meets the budget. A document
that would go beyond it is passed over, and the run goes on behind it with what still fits, until
nothing does: a source ends below its target by less than the size of any document that was passed
over, and never above. u is a hash of the doc_id, so reruns agree.

No source is sorted as a whole. The key up to which documents are taken is found by sums over
key ranges: each level cuts the range that holds the budget into ``RANGES`` parts and adds up
each, which Spark pre-aggregates before the shuffle, and only the last, small range is sorted.
So a source that holds a third of all rows costs no more than others. What comes out is a few
key limits for each source, and every document decides by them on its own.

Defined results: a null text has size 0; a null source is a source of its own, ordered last;
rows that share a doc_id share a key and are taken or passed over together; a source without
words has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom.llm import common

CYCLE = (1, 2, 3)
MOST_EPOCHS = 3
RANGES = 1024
LEVELS = 2
SEED = "mix"
# Sources up to which their limits are broadcast; beyond, Spark joins them by shuffle.
BROADCAST_SOURCES = 10_000
_MARKS = "#$%&*|"


def quality(text: Column, size: Column) -> Column:
    """Weight of a document in (0, 1]: low for many marks or odd word lengths."""
    chars = F.length(text)
    marks = (chars - F.length(F.translate(text, _MARKS, ""))) / F.greatest(chars, F.lit(1))
    usual = (chars >= 3 * size) & (chars <= 12 * size)
    return F.coalesce(F.greatest(F.lit(0.05), 1 - 5 * marks) * F.when(usual, 1.0).otherwise(0.25), F.lit(0.05))


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1] from a hash of the id: 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 1) / F.lit(float(1 << 52))


def sized(docs: DataFrame, weight: Column | None = None, seed: str = SEED) -> DataFrame:
    """``docs`` with ``_size`` (words) and ``_key`` (order within the source)."""
    with_size = docs.withColumn("_size", common.count_words(F.col("text")))
    weight = quality(F.col("text"), F.col("_size")) if weight is None else weight
    return with_size.withColumn("_key", -F.log(uniform(F.col("doc_id"), seed)) / weight)


# ------------------------------------------------------------------ targets

def targets(sizes: DataFrame, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, size, weight) with the target: shares of the total size, by weight.

    Targets stop at ``most`` times the source's size and the excess goes to the others by
    weight, until none is above. Two sums decide each round; a round stops at least one source.
    """
    total, weights = sizes.agg(F.sum("size"), F.sum("weight")).first()
    if not total or not weights:
        return sizes.withColumn("target", F.lit(0.0))
    unit = total / weights
    stopped = F.col("size") * most < F.lit(unit) * F.col("weight")
    while True:
        held, free = sizes.agg(F.sum(F.when(stopped, F.col("size") * most).otherwise(0)),
                               F.sum(F.when(stopped, 0).otherwise(F.col("weight")))).first()
        new = (total - held) / free if free else unit
        if new == unit:
            break
        unit = new
        stopped = F.col("size") * most < F.lit(unit) * F.col("weight")
    return sizes.withColumn("target", F.least(F.lit(unit) * F.col("weight"), (F.col("size") * most).cast("double")))


def cycled(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """Add weights that repeat over the sources in code point order, null last.

    One row for each source goes through one task, no documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    return sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int")))


# ------------------------------------------------------------------ selection

def _by_source(rows: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """Join one row for each source to all its documents."""
    side = sources.withColumnRenamed("source", "_source")
    return rows.join(F.broadcast(side) if few else side, rows["source"].eqNullSafe(side["_source"])).drop("_source")


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join two tables of one row for each source; a null source matches itself."""
    return left.join(right.withColumnRenamed("source", "_source"),
                     F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _limits(rows: DataFrame, state: DataFrame, few: bool) -> DataFrame:
    """(source, cut, used): the first key that goes beyond the budget, and the words before it.

    ``rows``: source, _size, _key. ``state``: source, floor, budget, rate. Candidates are the rows
    with keys above the floor that fit the budget by themselves. Where all fit, cut is infinite.
    """
    bracket = state.select("source", "floor", "budget", "rate", F.lit(-1.0).alias("low"),
                           F.lit(math.inf).alias("high"), F.lit(0).cast("long").alias("before"),
                           F.lit(None).cast("double").alias("cut"))

    def inside():
        key = F.col("_key")
        return _by_source(rows, bracket.where(F.col("cut").isNull()), few).where(
            (key > F.col("floor")) & (key >= F.col("low")) & (key <= F.col("high"))
            & (F.col("_size") <= F.col("budget")))

    over = F.col("sum") > F.col("budget")
    for level in range(LEVELS):
        if level == 0:  # equal shares of an exponential distribution of the source's rate
            share = 1 - F.exp(-F.col("_key") * F.col("rate"))
        else:
            share = F.try_divide(F.col("_key") - F.col("low"), F.col("high") - F.col("low"))
        part = F.coalesce(F.least(F.floor(share * RANGES), F.lit(RANGES)), F.lit(0))
        sums = inside().groupBy("source", part.alias("part")).agg(
            F.sum("_size").alias("words"), F.min("_key").alias("first"), F.max("_key").alias("last"),
            F.max("budget").alias("budget"), F.max("before").alias("start"))
        running = sums.withColumn(
            "sum", F.col("start") + F.sum("words").over(Window.partitionBy("source").orderBy("part")))
        crossed = running.groupBy("source").agg(
            F.min(F.when(over, F.struct("sum", "words", "first", "last"))).alias("c"), F.max("sum").alias("total"))
        known, everything = F.col("cut").isNotNull(), F.col("c").isNull()
        bracket = common.staged(_same_source(bracket, crossed, "left").select(
            "source", "floor", "budget", "rate",
            F.when(known | everything, F.col("low")).otherwise(F.col("c.first")).alias("low"),
            F.when(known | everything, F.col("high")).otherwise(F.col("c.last")).alias("high"),
            F.when(known, F.col("before")).when(everything, F.coalesce("total", "before")).otherwise(
                F.col("c.sum") - F.col("c.words")).alias("before"),
            F.when(known, F.col("cut")).when(everything, F.lit(math.inf)).alias("cut")), "mix-bracket")
    ordered = inside().select("source", "budget", "_key", (F.col("before") + F.sum("_size").over(
        Window.partitionBy("source").orderBy("_key"))).alias("sum"))
    last = ordered.groupBy("source").agg(
        F.min(F.when(over, F.col("_key"))).alias("found"), F.max(F.when(~over, F.col("sum"))).alias("fitting"))
    return _same_source(bracket, last, "left").select(
        "source", F.coalesce("cut", "found").alias("cut"), F.coalesce("fitting", "before").alias("used"))


def plan(rows: DataFrame, cycle: tuple[int, ...] = CYCLE, weights: DataFrame | None = None,
         most: int = MOST_EPOCHS) -> DataFrame:
    """One row for each source: source_size, target, epochs, and the limits of each pass.

    ``rows``: source, _size, _key. ``weights`` (source, weight) replaces the cycle. A pass goes up to the first
    document beyond the budget, in all sources at once; passes end when no source has such a document.
    Each leaves a budget below the size of the one passed over, so they are few: 8 over 256,410 documents.
    """
    sizes = rows.groupBy("source").agg(F.sum("_size").alias("size"), F.avg("_key").alias("mean"))
    if weights is None:
        weighted = cycled(sizes, cycle)
    else:
        weighted = _same_source(sizes, weights.select("source", "weight"), "left").fillna({"weight": 0})
    weighted = common.staged(weighted, "mix-sources")
    few = weighted.count() <= BROADCAST_SOURCES
    planned = targets(weighted, most).withColumn(
        "epochs", F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).cast("long"))
    planned = common.staged(planned.select(
        "source", F.col("size").alias("source_size"), "target", "epochs",
        (1 / F.greatest("mean", F.lit(1e-9))).alias("rate"),
        (F.col("target") - F.col("epochs") * F.col("size")).alias("budget"), F.lit(-1.0).alias("floor"),
        F.array().cast("array<struct<floor:double,cut:double,most:double>>").alias("limits")), "mix-plan")
    while True:
        found = _limits(rows, planned.select("source", "floor", "budget", "rate"), few)
        planned = common.staged(_same_source(planned, found).select(
            "source", "source_size", "target", "epochs", "rate",
            (F.col("budget") - F.col("used")).alias("budget"), F.col("cut").alias("floor"),
            F.concat("limits", F.array(F.struct("floor", "cut", F.col("budget").alias("most")))).alias("limits")),
            "mix-plan")
        if planned.where(F.col("floor") < math.inf).isEmpty():
            return F.broadcast(planned) if few else planned


def times(rows: DataFrame, planned: DataFrame, most: int = MOST_EPOCHS) -> DataFrame:
    """``rows`` (source, _size, _key and others) with ``_times``, how often each is taken.

    Adds source_size and target of the plan. Documents without words fit any budget; they too
    are taken ``most`` times at most.
    """
    side = planned.select(F.col("source").alias("_source"), "source_size", "target", "epochs", "limits")
    drawn = F.exists("limits", lambda x: (F.col("_key") > x["floor"]) & (F.col("_key") < x["cut"])
                     & (F.col("_size") <= x["most"]))
    return rows.join(side, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "_times", F.least(F.col("epochs") + drawn.cast("long"), F.lit(most))).drop("_source", "epochs", "limits")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    common.configure(docs.sparkSession)
    rows = common.staged(sized(docs).select("doc_id", "source", "_size", "_key"), "mix-rows")
    return times(rows, plan(rows)).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        (F.col("_size") * F.col("_times")).alias("taken"))


def mixed(docs: DataFrame, *, cycle: tuple[int, ...] = CYCLE, weights: DataFrame | None = None,
          quality_weight: Column | None = None) -> DataFrame:
    """The documents of the mix, each as often as it is taken, columns unchanged."""
    common.configure(docs.sparkSession)
    columns = docs.columns
    inner = docs.select(F.struct(*columns).alias("_row"), "doc_id", "text", "source")
    rated = sized(inner, quality_weight)
    planned = plan(common.staged(rated.select("source", "_size", "_key"), "mix-rows"), cycle, weights)
    taken = times(rated.select("_row", "source", "_size", "_key"), planned).where(F.col("_times") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select("_row.*")
