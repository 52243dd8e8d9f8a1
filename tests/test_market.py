from datetime import date
from decimal import Decimal

from ledgerloom.jobs import market_job, words_job
from ledgerloom.plans import market

LINES = """2018/07/16,A,自营,利率债,100,d1,,b1
2018/07/17,A,产品,利率债,200,d2,,b1
2018/7/18,A,自营,利率债,10,d3,,b1
2018/07/18,B,产品,信用债,20,d4,,b2
2018/07/19,B,产品,利率债,30,d5,,b3
2018/07/20,A,自营,利率债,40,d6,,b1
2018/07/23,C,自营,同业存单,50,d7,,b4
"""


def trades(spark, tmp_path):
    path = tmp_path / "trades.txt"
    path.write_text(LINES, encoding="utf-8")
    return market_job.trades(spark.read.text(str(path)))


def test_report_without_restriction(spark, tmp_path):
    query = market.MarketQuery(date(2018, 7, 18), date(2018, 7, 20))
    row = market.market_report(trades(spark, tmp_path), query).first().asDict()
    assert row == {"trade_amount": Decimal("100"), "deal_count": 4, "deal_days": 3,
                   "dealer_count": 2, "bond_count": 3, "work_days": 3}


def test_report_with_restrictions(spark, tmp_path):
    query = market.MarketQuery(date(2018, 7, 18), date(2018, 7, 23), "A", "自营", "利率债")
    row = market.market_report(trades(spark, tmp_path), query).first()
    assert (row.trade_amount, row.deal_count, row.deal_days, row.work_days) == (Decimal(50), 2, 2, 4)


def test_report_without_match(spark, tmp_path):
    query = market.MarketQuery(date(2019, 1, 1), date(2019, 2, 1))
    row = market.market_report(trades(spark, tmp_path), query).first()
    assert row.trade_amount == 0 and row.deal_count == 0 and row.work_days == 0


def test_comparison_days(spark, tmp_path):
    df = trades(spark, tmp_path)
    two = market.MarketQuery(date(2018, 7, 20), date(2018, 7, 23))
    assert [tuple(r) for r in market.comparison_days(df, two).orderBy("day_rank").collect()] == [
        (1, date(2018, 7, 19)), (2, date(2018, 7, 18))]
    none = market.MarketQuery(date(2019, 1, 1), date(2019, 2, 1))
    assert market.comparison_days(df, none).count() == 0


def test_jobs(spark, tmp_path):
    path = tmp_path / "trades.txt"
    path.write_text(LINES, encoding="utf-8")
    query = market.MarketQuery(date(2018, 7, 18), date(2018, 7, 20))
    market_job.run(spark, str(path), str(tmp_path / "out"), query)
    assert spark.read.parquet(str(tmp_path / "out" / "preview")).count() == 4
    assert spark.read.parquet(str(tmp_path / "out" / "comparison_days")).count() == 2
    words_job.run(spark, str(path), str(tmp_path / "words"))
    assert spark.read.text(str(tmp_path / "words")).count() == 7
