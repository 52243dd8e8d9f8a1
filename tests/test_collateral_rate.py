"""The collateral rate of a day: sum(ratio * amount) / sum(amount), whatever else is loaded."""

from datetime import date
from decimal import Decimal

import pytest

from ledgerloom.plans.bond import collateral_rate

DEALS = "ev_id string, deal_dt date, trade_amnt decimal(20,4)"
LINES = "ev_id string, ri_id string, cnvrsn_prprtn decimal(12,6), total_face_value decimal(20,4)"


def rates(spark, deals, lines):
    made = [(e, date(2020, 1, d), Decimal(a)) for e, d, a in deals]
    pledged = [(e, r, Decimal(str(c)), Decimal(f)) for e, r, c, f in lines]
    found = collateral_rate(spark.createDataFrame(made, DEALS), spark.createDataFrame(pledged, LINES)).collect()
    return {(r.ri_id, r.deal_dt.day): float(r.zy_rate) for r in found}


def test_other_days_do_not_matter(spark):
    deals = [("a", 1, 100), ("b", 1, 300), ("c", 2, 50), ("d", 3, 7)]
    lines = [("a", "x", 0.9, 10), ("b", "x", 0.7, 1000), ("c", "x", 0.5, 3), ("d", "x", 0.95, 8)]
    one = rates(spark, deals[:2], lines[:2])
    assert one == {("x", 1): pytest.approx(0.75)}
    every = rates(spark, deals, lines)
    assert every[("x", 1)] == one[("x", 1)]
    assert every == {("x", 1): pytest.approx(0.75), ("x", 2): 0.5, ("x", 3): 0.95}


def test_between_least_and_greatest_ratio(spark):
    deals = [(f"e{i}", 1 + i % 3, 17 * i + 1) for i in range(40)]
    lines = [(f"e{i}", f"r{i % 4}", 0.5 + (i * 7 % 13) / 26, 10 ** (i % 9)) for i in range(40)]
    found = rates(spark, deals, lines)
    for (ri, day), rate in found.items():
        own = [c for (e, r, c, _) in lines if r == ri and 1 + int(e[1:]) % 3 == day]
        assert min(own) - 1e-5 <= rate <= max(own) + 1e-5


def test_ordinary_large_values(spark):
    found = rates(spark, [("a", 1, 10**15)], [("a", "x", 100, 10**11)])
    assert found == {("x", 1): 100.0}


def test_no_amount(spark):
    assert rates(spark, [("a", 1, 0)], [("a", "x", 0.9, 5), ("a", "0", 0.9, 5)]) == {("x", 1): 0.0}
