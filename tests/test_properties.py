"""Relations between reports that must hold on any data."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from checks import bindings
from ledgerloom.plans import bond, repo
from ledgerloom.sources.tables import REPORT_TABLES

QUERIES = entry_points.queries()
REPORTS = {
    "m01_xbond_info": "XBOND_INFO", "m02_bond_bsc_info": "BOND_BSC_INFO",
    "m03_bond_turnover_rate": "BOND_TURNOVER_RATE", "m04_bond_income": "BOND_INCOME",
    "m05_bond_deal_trend": "BOND_DEAL_TREND", "m06_bond_deal_trend_org": "BOND_DEAL_TREND_ORG",
    "m07_bond_deal_orgtype": "BOND_DEAL_ORGTYPE", "m08_bond_deal_orglist": "BOND_DEAL_ORGLIST",
    "m09_bond_deal_smart": "BOND_DEAL_SMART", "m10_member_price": "MEMBER_PRICE_DEAL_INFO",
    "m11_ctgry_price": "CTGRY_PRICE_DEAL_INFO", "m12_global_price": "GLOBAL_PRICE_DEAL_INFO",
    "m13_member_bond_ctgry": "MEMBER_BOND_CTGRY_DEAL_INFO",
    "m14_ctgry_bond_ctgry": "CTGRY_BOND_CTGRY_DEAL_INFO",
    "m15_member_bond_rtng": "MEMBER_BOND_RTNG_DEAL_INFO",
    "m16_ctgry_bond_rtng": "CTGRY_BOND_RTNG_DEAL_INFO",
    "m17_member_bond_type": "MEMBER_BOND_TYPE_DEAL_INFO",
    "m18_ctgry_bond_type": "CTGRY_BOND_TYPE_DEAL_INFO",
    "m19_member_bond_issr": "MEMBER_BOND_ISSR_DEAL_INFO",
    "m20_ctgry_bond_issr": "CTGRY_BOND_ISSR_DEAL_INFO",
    "m21_member_ctgry_amount": "MEMBER_CTGRY_AMOUNT_DEAL_INFO",
    "m22_ctgry_ctgry_amount": "CTGRY_CTGRY_AMOUNT_DEAL_INFO",
    "m23_member_ctgry_number": "MEMBER_CTGRY_NUMBER_DEAL_INFO",
}


@pytest.mark.parametrize("name", list(REPORTS))
def test_columns_and_unique_key(spark, sf_small, name):
    table = REPORT_TABLES[REPORTS[name]]
    df = QUERIES[name](spark, sf_small)
    assert set(df.columns) == set(table.columns)
    counts = table.conform(df).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(*table.key)).alias("keys"),
        *[F.count_if(F.col(k).isNull()).alias(f"null_{k}") for k in table.key]).first().asDict()
    assert counts["n"] == counts["keys"] > 0
    assert all(v == 0 for k, v in counts.items() if k.startswith("null_"))


def test_groups_add_up(spark, sf_small):
    rows = QUERIES["m10_member_price"](spark, sf_small).collect()
    cells = {(r.unq_id_in_src_sys, r.pd_cd, r.deal_dt, r.join_type): r.repo_sum_amount or 0 for r in rows}
    for member, product, day, group in cells:
        get = lambda g: cells.get((member, product, day, g), 0)
        assert get("总额") == pytest.approx(get("自营") + get("产品"))
        assert get("货币市场基金") <= get("产品") + 1e-6


def test_spread_is_difference_of_prices(spark, sf_small):
    for r in QUERIES["m10_member_price"](spark, sf_small).collect():
        if r.repo_weighted_price is None or r.rvrse_weighted_price is None:
            assert r.price_difference is None and r.total_amount is None
        else:
            assert r.price_difference == pytest.approx(
                r.rvrse_weighted_price - r.repo_weighted_price, abs=2e-6)


def test_income_total_equals_deals(spark, sf_small):
    tables = bindings.Tables(spark, sf_small)
    total = bond.clean_deals(bindings.bond_inputs(tables)).agg(F.sum("dirty_amnt")).first()[0]
    income = QUERIES["m04_bond_income"](spark, sf_small).agg(
        F.sum("buy_act_all"), F.sum("sell_act_all")).first()
    assert income[0] == pytest.approx(float(total)) and income[1] == pytest.approx(float(total))


def test_line_count_equals_fan_out(spark, sf_small):
    inputs = bindings.repo_inputs(bindings.Tables(spark, sf_small))
    deals = repo.valid_deals(inputs, rating=True, line_count=True)
    short = repo.category_rating(repo.pledged_legs(repo.pledged_deals(deals)), inputs).collect()
    long = repo.category_rating(repo.summed(repo.line_legs(repo.collateral_lines(deals, inputs))), inputs).collect()
    key = lambda r: (r.ins_show_name, r.rtng_desc, r.deal_dt)
    assert sorted(map(tuple, short), key=str) == sorted(map(tuple, long), key=str)
    assert len({key(r) for r in short}) == len(short) > 0
