"""Groupings of one pass, and totals that add up over days."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from checks import bindings, queries
from ledgerloom.operators import grouping
from ledgerloom.plans import market, repo
from ledgerloom.plans.market import MarketQuery


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_ids_name_their_set(spark):
    df = spark.createDataFrame([(1, "x", None, 5), (1, None, "q", 7), (2, "x", "q", 1)], "a int, b string, c string, v int")
    sets = {"one": ["a"], "two": ["b", "c"], "three": ["c", "a"], "all": ["a", "b", "c"]}
    routed = grouping.regroup(df, sets, ["v"])
    for name, keys in sets.items():
        expected = df.groupBy(*keys).agg(F.sum("v").alias("v")).collect()
        got = grouping.of_report(routed, name, keys, ["v"]).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, expected), key=str)
    with pytest.raises(ValueError):
        grouping.regroup(df, {"one": ["a", "b"], "two": ["b", "a"]}, ["v"])


def test_ten_reports_from_two_passes(spark, sf_small):
    """Rows of each report are those of its own aggregation; the relation is read once for all."""
    t = bindings.Tables(spark, sf_small)
    inputs = bindings.repo_inputs(t)
    deals = repo.valid_deals(inputs, rating=True, line_count=True)
    lines, pledged = repo.collateral_lines(deals, inputs), repo.pledged_deals(deals)
    for reports, sets, measures, routed, legs in (
            (repo.FROM_LINE_LEGS, repo.LINE_SETS, repo.LINE_MEASURES, repo.line_sets(lines), repo.line_legs(lines)),
            (repo.FROM_PLEDGED_LEGS, repo.PLEDGED_SETS, repo.PLEDGED_MEASURES, repo.pledged_sets(pledged),
             repo.pledged_legs(pledged))):
        assert set(reports) == set(sets)
        assert plan(routed).count("Expand") >= 1
        routed = spark.createDataFrame(routed.collect(), routed.schema)
        for name, build in reports.items():
            got = build(grouping.of_report(routed, name, sets[name], measures), inputs)
            expected = build(legs, inputs)
            assert got.columns == expected.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())), name


RANGES = [queries.YEAR, queries.FILTERED, queries.ONE_ORG, queries.QUARTER, MarketQuery(date(2040, 1, 1), date(2041, 1, 1)),
          MarketQuery(date(1900, 1, 1), date(2100, 1, 1))]


@pytest.fixture(scope="module")
def days(spark, sf_small, tmp_path_factory):
    """Totals and bitmaps of two batches of days, the second with the dictionary of the first."""
    trades = bindings.trades(bindings.Tables(spark, sf_small))
    folder = tmp_path_factory.mktemp("days")
    early = F.col("deal_dt") < "1996-01-01"
    numbers = None
    for batch, part in enumerate((trades.where(early), trades.where(~early))):
        market.number_values(part, numbers).write.parquet(str(folder / f"numbers{batch}"))
        numbers = spark.read.parquet(str(folder / f"numbers{batch}"))
        market.daily_bitmaps(part, numbers).write.parquet(str(folder / f"bits/batch={batch}"))
        market.daily_sums(part).write.parquet(str(folder / f"sums/batch={batch}"))
    return trades, numbers, spark.read.parquet(str(folder / "sums")), spark.read.parquet(str(folder / "bits"))


@pytest.mark.parametrize("query", RANGES, ids=str)
def test_days_add_up(days, query):
    trades, _, sums, bits = days
    got = market.market_report_of_days(sums, bits, query)
    assert got.columns == market.market_report(trades, query).columns
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in market.market_report(trades, query).collect()]
    assert "Expand" not in plan(got)


def test_numbers_stay_and_do_not_meet(days):
    _, numbers, _, _ = days
    rows = numbers.collect()
    assert len({(r.attribute, r.number) for r in rows}) == len(rows) == len({(r.attribute, r.value) for r in rows})


def test_more_values_than_a_bucket_holds(spark):
    trades = spark.range(100_000).selectExpr(
        "date'2020-01-01' + cast(id % 10 as int) deal_dt", "concat('o', id) org_nm", "'A' player_type", "'B' bond_type",
        "cast(1 as decimal(9,2)) amount", "id deal_nmbr", "case when id % 4 > 0 then concat('b', id % 50000) end bond_id")
    bits = market.daily_bitmaps(trades, market.number_values(trades))
    query = MarketQuery(date(2020, 1, 2), date(2020, 1, 9))
    (got,) = market.market_report_of_days(market.daily_sums(trades), bits, query).collect()
    assert tuple(got) == tuple(market.market_report(trades, query).first())
    assert bits.select("bucket").distinct().count() > 1
