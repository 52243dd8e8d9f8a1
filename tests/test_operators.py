import random
import time
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import lookups, merging, quality


def rows(df, *order):
    return sorted((tuple(r) for r in (df.select(*order) if order else df).collect()),
                  key=lambda r: [str(v) for v in r])


def test_lookup_default(spark):
    facts = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    dim = spark.createDataFrame([(1, "one", 5)], "k int, name string, other int")
    got = lookups.lookup(facts, dim, "k", {"name": "None"})
    assert got.columns == ["k", "v", "name"]
    assert rows(got, "v", "name") == [("x", "one"), ("y", "None"), ("z", "None")]


def test_presence(spark):
    facts = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    listed = spark.createDataFrame([(2,), (2,), (9,)], "id int")
    assert rows(lookups.keep_listed(facts, listed, "k", "id")) == [(2,), (2,)]
    assert rows(lookups.drop_listed(facts, listed, "k", "id")) == [(1,), (3,)]
    assert rows(lookups.flag_listed(facts, listed, "k", "f", "id")) == [
        (1, False), (2, True), (2, True), (3, False)]


def test_within(spark):
    df = spark.createDataFrame(
        [(date(2020, 1, d),) for d in (1, 2, 3)], "d date").withColumns(
        {"a": F.lit(date(2020, 1, 1)), "b": F.lit(date(2020, 1, 3))})
    both = lookups.within(F.col("d"), F.col("a"), F.col("b"))
    neither = lookups.within(F.col("d"), F.col("a"), F.col("b"), "neither")
    assert [tuple(r) for r in df.select(both, neither).collect()] == [
        (True, False), (True, True), (True, False)]
    with pytest.raises(ValueError):
        lookups.within(F.col("d"), F.col("a"), F.col("b"), "left")


def test_valid_attribute_with_several_intervals(spark):
    dim = spark.createDataFrame(
        [("m", "bank", date(2020, 1, 1), date(2020, 1, 10)),
         ("m", "bank", date(2020, 1, 5), date(2020, 1, 20)),
         ("m", "bank", date(2020, 3, 1), date(2020, 3, 5))],
        "id string, kind string, efctv_from_dt date, efctv_to_dt date")
    days = [date(2020, 1, 1), date(2020, 1, 7), date(2020, 1, 15), date(2020, 1, 20), date(2020, 3, 2)]
    facts = spark.createDataFrame([("m", d) for d in days] + [("q", days[1])], "id string, day date")
    got = lookups.valid_attribute(facts, dim, "id", "day", "kind", "None")
    assert rows(got, "id", "day", "kind") == [
        ("m", days[0], "None"), ("m", days[1], "bank"), ("m", days[2], "bank"),
        ("m", days[3], "None"), ("m", days[4], "bank"), ("q", days[1], "None")]


def test_one_per_key(spark):
    dim = spark.createDataFrame([(1, "a", 9), (1, "b", 2), (2, None, 1)], "k int, x string, y int")
    assert rows(lookups.one_per_key(dim, "k")) == [(1, "b", 2), (2, None, 1)]


def test_roots(spark):
    members = spark.createDataFrame([
        ("1", "R", "R"), ("2", "C", "R"), ("3", "E", ""), ("4", "D", "E"), ("5", "N", None),
        ("6", "L", "gone")], "unq_id string, member_cd string, rt_member_cd string")
    assert rows(lookups.with_root(members), "unq_id", "root_id") == [
        ("1", "1"), ("2", "1"), ("3", "3"), ("4", "3"), ("5", "5"), ("6", "None")]


def test_upsert(spark):
    old = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    new = spark.createDataFrame([(2, 21), (3, 30)], "k int, v int")
    assert rows(merging.upsert(old, new, ["k"])) == [(1, 10), (2, 21), (3, 30)]


def test_merge_partial_rows(spark):
    a = spark.createDataFrame([(1, 10)], "k int, x int")
    b = spark.createDataFrame([(1, 5), (2, 6)], "k int, y int")
    assert rows(merging.merge_partial_rows(["k"], a, b), "k", "x", "y") == [(1, 10, 5), (2, None, 6)]


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", Decimal(1)), ("a", Decimal(3)), ("b", Decimal(5))],
                               "k string, v decimal(9,2)")
    got = merging.share_of_total(df, ["k"], "v").select("k", (F.col("v") / F.col("v_total")).cast("double"))
    assert rows(got) == [("a", 0.25), ("a", 0.75), ("b", 1.0)]


def test_misses(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    dim = spark.createDataFrame([(2,)], "id int")
    assert quality.misses(facts, dim, {"k": "id"}).first().misses == 3
    assert quality.misses(facts.where("k = 2"), dim, {"k": "id"}).first().misses == 0


def test_misses_at_once(spark):
    """The same counts as one by one, with null keys, keys listed twice and rows that do not count."""
    schema = "k int, name string, ok boolean"
    data = [(1, "a", True), (1, "a", True), (2, None, True), (None, "b", True), (3, "c", False), (3, "a", None)]
    known = spark.createDataFrame([(2,), (2,), (None,)], "id int")
    pairs = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "i int, n string")
    lookups = {"key": (known, {"k": "id"}), "pair": (pairs, {"k": "i", "name": "n"})}
    conditions = {"unnamed": F.col("name").isNull(), "odd": F.col("k") % 2 == 1}
    for facts, expected in ((data, {"key": 3, "pair": 2, "unnamed": 1, "odd": 4}),
                            ([], {"key": 0, "pair": 0, "unnamed": 0, "odd": 0})):
        facts = spark.createDataFrame(facts, schema)
        got = quality.misses_at_once(facts, F.col("ok"), lookups, conditions)
        assert {r.counter: r.misses for r in got.collect()} == expected
        counted = facts.where("ok")
        assert {name: quality.misses(counted, *lookup).first().misses for name, lookup in lookups.items()} == {
            name: expected[name] for name in lookups}


def test_watched_counters(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, None), (None, "a"), (9, "c")], "k int, name string")
    known = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    watch = quality.Watch()
    out = watch.misses(watch.rows(rows, unnamed=F.col("name").isNull()), unknown=(known, {"k": "id"}),
                       unknown_name=(spark.createDataFrame([("a",)], "n string"), {"name": "n"}))
    assert out.columns == ["k", "name"] and out.count() == 5
    assert watch.values() == {"unnamed": 1, "unknown": 2, "unknown_name": 3}
    some = quality.Watch()
    some.misses(rows, where=F.col("k") > 2, unknown=(known, {"k": "id"})).collect()
    assert some.values() == {"unknown": 1}


def test_last_per_key(spark, tmp_path, monkeypatch):
    data = [(1, "b", 5), (1, "a", 7), (2, "z", 1), (None, "n", 3), (None, "m", 2), (1, "c", 6)]
    frame = spark.createDataFrame(data, "k int, v string, at long")
    expected = [(1, "a"), (2, "z"), (None, "n")]
    assert sorted((tuple(r) for r in lookups.last_per_key(frame, "k", position="at").collect()), key=str) == expected
    frame.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    for limit in (lookups.is_small, lambda df: False):
        monkeypatch.setattr(lookups, "is_small", limit)
        df = lookups.last_per_key(stored, "k", position="at")
        assert sorted((tuple(r) for r in df.collect()), key=str) == expected
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "Sort" not in plan


def test_many_intervals(spark):
    """Overlapping, touching, empty, reversed and null intervals against a look at each of them."""
    rng = random.Random(7)
    day = lambda n: date(2000, 1, 1) + timedelta(days=n)
    spans = [(1, day(s), day(s + rng.choice([-2, 0, 1, 2, 3, 9]))) for s in rng.sample(range(2000), 400)]
    spans += [(2, day(5), day(9)), (2, day(8), day(12)), (3, None, day(4)), (4, day(1), None), (5, day(3), date(9999, 12, 31)),
              (None, day(0), day(99))]
    dim = spark.createDataFrame([(k, f"n{k}", s, e) for k, s, e in spans],
                                "id int, kind string, efctv_from_dt date, efctv_to_dt date")
    asked = [(k, day(n)) for k in (1, 2, 3, 4, 5, 6) for n in range(0, 2010, 1 if k == 1 else 7)] + [(1, None), (None, day(5))]
    got = lookups.valid_attribute(spark.createDataFrame(asked, "id int, day date"), dim, "id", "day", "kind", "None")
    expected = [(k, d, f"n{k}" if k and d and any(
        o == k and s and e and s < d < e for o, s, e in spans) else "None") for k, d in asked]
    assert rows(got, "id", "day", "kind") == sorted(expected, key=lambda r: [str(v) for v in r])


def test_long_history_does_not_slow_its_rows(spark, tmp_path):
    """A key of 100,000 intervals has a list bounded by the calendar, searched in 23 steps a row."""
    spark.range(100_000).selectExpr(
        "1 id", "'a' kind", "date_add(date'1990-01-01', cast(id % 9000 as int)) efctv_from_dt",
        "date_add(date'1990-01-01', cast(id % 9000 + 2 + 3 * (id % 2) as int)) efctv_to_dt").write.parquet(str(tmp_path / "d"))
    dim = spark.read.parquet(str(tmp_path / "d"))
    (bounds,) = lookups.validity_bounds(dim, "id", "efctv_from_dt", "efctv_to_dt").collect()
    assert len(bounds["_bounds"]) <= 9002
    df = spark.range(200_000).selectExpr("cast(1 as int) id", "date_add(date'1990-01-01', cast(id % 9100 as int)) day")
    began = time.perf_counter()
    valid = lookups.valid_attribute(df, dim, "id", "day", "kind", "None").groupBy("kind").count().collect()
    assert sum(r["count"] for r in valid) == 200_000
    assert time.perf_counter() - began < 60  # a look at each interval takes 2 * 10^10 comparisons
