from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql.types import DateType, DecimalType, LongType

from ledgerloom.sources import sinks
from ledgerloom.sources.tables import REPORT_TABLES

TREND = REPORT_TABLES["BOND_DEAL_TREND"]


def trend(spark, *rows):
    return spark.createDataFrame(
        [(date(2020, 1, d), b, "cd", "nm", Decimal(v), Decimal(0)) for d, b, v in rows],
        "deal_dt date, bond_id string, bond_cd string, bond_nm string, "
        "dirty_price_wg_bf decimal(9,4), dirty_price_wg_af decimal(9,4)")


def stored(spark, folder):
    df = sinks.read_report(spark, TREND, folder)
    return sorted((r.deal_dt.day, r.bond_id, float(r.dirty_price_wg_bf)) for r in df.collect())


def test_overwrite_then_upsert(spark, tmp_path):
    folder = str(tmp_path / "out")
    sinks.write_report(trend(spark, (9, "X", "1")), TREND, folder)
    sinks.write_report(trend(spark, (1, "A", "1"), (1, "B", "2"), (2, "A", "3")), TREND, folder)
    assert stored(spark, folder) == [(1, "A", 1.0), (1, "B", 2.0), (2, "A", 3.0)]
    sinks.upsert_report(trend(spark, (1, "B", "7"), (3, "C", "8")), TREND, folder)
    assert stored(spark, folder) == [(1, "A", 1.0), (1, "B", 7.0), (2, "A", 3.0), (3, "C", 8.0)]


def test_late_row_writes_only_itself(spark, tmp_path):
    """A late row rewrites no date: the base's files stay, and the delta has one row."""
    folder = str(tmp_path / "out")
    sinks.write_report(trend(spark, (1, "A", "1"), (1, "B", "2"), (2, "A", "3")), TREND, folder)
    table = tmp_path / "out" / "bond_deal_trend"
    before = {p: p.stat().st_mtime_ns for p in table.rglob("*.parquet")}
    sinks.upsert_report(trend(spark, (1, "A", "5")), TREND, folder)
    after = {p: p.stat().st_mtime_ns for p in table.rglob("*.parquet")}
    assert before.items() <= after.items()
    new = [str(p) for p in set(after) - set(before)]
    assert spark.read.parquet(*new).count() == 1 and all("deal_dt=2020-01-01" in p for p in new)
    assert stored(spark, folder) == [(1, "A", 5.0), (1, "B", 2.0), (2, "A", 3.0)]


def test_table_without_date(spark, tmp_path):
    table = REPORT_TABLES["XBOND_INFO"]
    df = spark.createDataFrame([("c1", "one"), ("c2", "two")], "bond_cd string, bond_nm string")
    sinks.write_report(df, table, str(tmp_path / "out"))
    late = spark.createDataFrame([("c2", "zwei")], "bond_cd string, bond_nm string")
    sinks.upsert_report(late, table, str(tmp_path / "out"))
    got = sinks.read_report(spark, table, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in got.collect()) == [("c1", "one"), ("c2", "zwei")]


@pytest.mark.parametrize("name", list(REPORT_TABLES))
def test_contract(name):
    table = REPORT_TABLES[name]
    assert set(table.key) <= set(table.columns)
    assert set(map(type, table.columns.values())) <= {
        DateType, DecimalType, LongType, type(table.schema["bond_cd"].dataType)
        if "bond_cd" in table.columns else type(table.schema[table.key[0]].dataType)}
    assert all(not table.schema[k].nullable for k in table.key)


def test_twenty_three_tables():
    assert len(REPORT_TABLES) == 23


def test_upsert_into_missing_table(spark, tmp_path):
    folder = str(tmp_path / "out")
    sinks.upsert_report(trend(spark, (1, "A", "5"), (2, "B", "6")), TREND, folder)
    assert stored(spark, folder) == [(1, "A", 5.0), (2, "B", 6.0)]


def test_rebuild_drops_old_dates_in_any_session(spark, tmp_path):
    folder = str(tmp_path / "out")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        sinks.write_report(trend(spark, (1, "A", "1"), (2, "A", "3")), TREND, folder)
        sinks.write_report(trend(spark, (1, "A", "4")), TREND, folder)
        assert stored(spark, folder) == [(1, "A", 4.0)]
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
