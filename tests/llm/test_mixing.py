import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mixing

DOCS = "doc_id long, text string, source string, _size string, target int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", None) for i, t, s in rows], DOCS)


def corpus(seed, sources, n):
    rng = random.Random(seed)
    return [(i, " ".join("word" for _ in range(int(rng.paretovariate(1.1)) % 900)), rng.choice(sources))
            for i in range(n)]


def expected_targets(rows):
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len((text or "").split())
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, free, out = sum(size.values()), set(order), {}
    while True:
        unit = (total - sum(3 * size[s] for s in order if s not in free)) / max(sum(weight[s] for s in free), 1)
        above = {s for s in free if unit * weight[s] > 3 * size[s]}
        if not above:
            break
        free -= above
    for s in order:
        out[s] = unit * weight[s] if s in free else 3.0 * size[s]
    return size, out


@pytest.mark.parametrize("sources", [["a"], ["a", "b", "c", None], ["hot"] * 20 + ["s1", "s2", "Z", "é", "tiny"]])
def test_targets_and_budgets(spark, sources):
    rows = corpus(len(sources), sources, 600) + [(9001, None, "a"), (9002, "", "b"), (9003, " \n", None)]
    size, target = expected_targets(rows)
    found = mixing.report(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {i: (t, s) for i, t, s in rows}
    taken, least = defaultdict(int), defaultdict(lambda: 10**9)
    for r in found:
        text, source = by_id[r.doc_id]
        assert r["size"] == len((text or "").split()) and r.source_size == size[source]
        assert r.target == pytest.approx(target[source])
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[source] += r.taken
    for s in size:
        assert taken[s] <= target[s] + 1e-6
        # whatever was passed over does not fit what is left
        epochs = int(target[s] // size[s]) if size[s] else 0
        over = [r["size"] for r in found if by_id[r.doc_id][1] == s and r["size"] and r.taken <= epochs * r["size"]]
        assert epochs == 3 or not over or target[s] - taken[s] < min(over) + 1e-6
    assert sorted(map(tuple, found)) == sorted(map(tuple, mixing.report(frame(spark, rows)).collect()))


def test_sizes_of_all_magnitudes(spark):
    """Many documents are passed over before the budget is met; all that fit behind them are taken."""
    rng = random.Random(9)
    rows = [(i, " ".join(["w"] * rng.choice([20_000, 5_000, 1_000, 200, 50, 7, 1])), "ab"[i % 2]) for i in range(120)]
    docs = frame(spark, rows)
    found = mixing.report(docs).collect()
    keys = {r.doc_id: r["_key"] for r in mixing.sized(docs).collect()}
    for source in "ab":
        own = sorted((r for r in found if "ab"[r.doc_id % 2] == source), key=lambda r: keys[r.doc_id])
        size = sum(r["size"] for r in own)
        epochs = int(own[0].target // size)
        budget = own[0].target - epochs * size
        for r in own:
            drawn = r["size"] <= budget
            budget -= drawn * r["size"]
            assert r.taken == (epochs + drawn) * r["size"]


def test_repeats_and_columns(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, "c d", None), (None, "e f g", "x"), (None, None, None)]
    docs = frame(spark, rows)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    counts = {tuple(r)[:3]: r["count"] for r in out.groupBy(docs.columns).count().collect()}
    report = {r.doc_id: r for r in mixing.report(docs).collect()}
    assert counts.get((2, "c d", None), 0) * 2 == report[2].taken
    assert all(r.taken <= 3 * r["size"] for r in report.values())


def test_empty(spark):
    assert mixing.report(frame(spark, [])).collect() == []
    assert mixing.mixed(frame(spark, [])).collect() == []
    assert [r.taken for r in mixing.report(frame(spark, [(1, None, None), (2, "", "a")])).collect()] == [0, 0]


def test_given_weights(spark):
    rows = corpus(3, ["a", "b"], 400)
    docs = frame(spark, rows)
    weights = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "source string, weight double")
    out = {r.source: r.n for r in mixing.mixed(docs, weights=weights).groupBy("source").agg(
        F.sum(F.size(F.split(F.col("text"), " "))).alias("n")).collect()}
    assert set(out) == {"a"}


def test_better_documents_come_first(spark):
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("w w w w").alias("text"), F.lit("s").alias("source"))
    keyed = mixing.sized(rows, F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(0.2))
    first = keyed.orderBy("_key").limit(500).where("doc_id % 2 = 0").count()
    assert first > 380
