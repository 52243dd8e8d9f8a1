"""Versions, deltas, compaction: what readers see."""

from datetime import date
from decimal import Decimal

import pytest

from ledgerloom.sources.store import BASE, DELTA, Store
from ledgerloom.sources.tables import REPORT_TABLES

TREND, XBOND = REPORT_TABLES["BOND_DEAL_TREND"], REPORT_TABLES["XBOND_INFO"]


def trend(spark, *rows):
    return spark.createDataFrame(
        [(date(2020, 1, d), b, "cd", "nm", Decimal(v), Decimal(0)) for d, b, v in rows],
        "deal_dt date, bond_id string, bond_cd string, bond_nm string, "
        "dirty_price_wg_bf decimal(9,4), dirty_price_wg_af decimal(9,4)")


def shown(snapshot):
    return sorted((r.deal_dt.day, r.bond_id, float(r.dirty_price_wg_bf)) for r in snapshot.read(TREND).collect())


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def put(store, kind, *rows):
    return store.publish({TREND.name: (kind, store.write(trend(store.spark, *rows), TREND))})


def test_empty_store(store):
    assert store.versions() == [] and store.snapshot().number == 0
    assert store.snapshot().read(TREND).collect() == []
    assert store.snapshot().read(TREND).columns == list(TREND.columns)
    assert store.compact() == 0 and store.vacuum() == []


def test_deltas_merge_in_order(store):
    put(store, BASE, (1, "A", "1"), (1, "B", "2"), (2, "A", "3"))
    put(store, DELTA, (1, "B", "7"), (3, "C", "8"))
    put(store, DELTA, (1, "B", "9"), (2, "A", "4"))
    assert shown(store.snapshot()) == [(1, "A", 1.0), (1, "B", 9.0), (2, "A", 4.0), (3, "C", 8.0)]
    assert shown(store.snapshot(2)) == [(1, "A", 1.0), (1, "B", 7.0), (2, "A", 3.0), (3, "C", 8.0)]
    assert shown(store.snapshot(1)) == [(1, "A", 1.0), (1, "B", 2.0), (2, "A", 3.0)]


def test_unpublished_part_is_not_seen(store):
    put(store, BASE, (1, "A", "1"))
    store.write(trend(store.spark, (1, "A", "5")), TREND)  # the run ends here
    assert shown(store.snapshot()) == [(1, "A", 1.0)]


def test_compaction_keeps_rows_and_later_deltas(store, monkeypatch):
    put(store, BASE, (1, "A", "1"), (2, "B", "2"))
    put(store, DELTA, (1, "A", "3"))
    open_reader, plain = store.snapshot(), Store.write

    def with_a_late_row(own, df, table):
        part = plain(own, df, table)
        monkeypatch.setattr(Store, "write", plain)
        put(own, DELTA, (4, "D", "4"))  # arrives while the base is written
        return part

    monkeypatch.setattr(Store, "write", with_a_late_row)
    assert store.compact() == 4
    now = store.snapshot()
    assert len(now.parts[TREND.name]) == 2
    assert shown(now) == [(1, "A", 3.0), (2, "B", 2.0), (4, "D", 4.0)]
    assert shown(open_reader) == [(1, "A", 3.0), (2, "B", 2.0)]
    assert store.compact(deltas=2) == 4  # too few deltas


def test_rebuild_during_compaction_wins(store, monkeypatch):
    put(store, BASE, (1, "A", "1"))
    put(store, DELTA, (1, "A", "2"))
    plain = Store.write

    def with_a_rebuild(own, df, table):
        part = plain(own, df, table)
        monkeypatch.setattr(Store, "write", plain)
        put(own, BASE, (9, "Z", "9"))
        return part

    monkeypatch.setattr(Store, "write", with_a_rebuild)
    store.compact()
    assert shown(store.snapshot()) == [(9, "Z", 9.0)]


def test_writers_do_not_lose_each_other(store, monkeypatch):
    """Two writers start from one version: the second sees that the number is taken and goes on top."""
    put(store, BASE, (1, "A", "1"))
    first = store.write(trend(store.spark, (2, "B", "2")), TREND)
    plain = Store._create

    def beaten_once(own, number, text):
        monkeypatch.setattr(Store, "_create", plain)
        put(own, DELTA, (3, "C", "3"))
        return plain(own, number, text)

    monkeypatch.setattr(Store, "_create", beaten_once)
    assert store.publish({TREND.name: (DELTA, first)}) == 3
    assert shown(store.snapshot()) == [(1, "A", 1.0), (2, "B", 2.0), (3, "C", 3.0)]


def test_several_tables_at_once(store):
    names = store.spark.createDataFrame([("c1", "one")], "bond_cd string, bond_nm string")
    number = store.publish({TREND.name: (BASE, store.write(trend(store.spark, (1, "A", "1")), TREND)),
                            XBOND.name: (BASE, store.write(names, XBOND))})
    assert number == 1 and store.versions() == [1]
    put(store, BASE, (2, "B", "2"))
    assert [tuple(r) for r in store.snapshot().read(XBOND).collect()] == [("c1", "one")]  # carried over


def test_vacuum_keeps_what_versions_name(store):
    for value in "123":
        put(store, BASE, (1, "A", value))
    orphan = store.write(trend(store.spark, (1, "A", "9")), TREND)
    removed = store.vacuum(keep=2)
    assert orphan in removed and len(removed) == 2 and store.versions() == [2, 3]
    assert shown(store.snapshot()) == [(1, "A", 3.0)] and shown(store.snapshot(2)) == [(1, "A", 2.0)]


def test_date_filter_prunes_base_and_deltas(store):
    put(store, BASE, (1, "A", "1"), (2, "B", "2"))
    put(store, DELTA, (1, "A", "3"))
    df = store.snapshot().read(TREND).where("deal_dt = date'2020-01-01'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(deal_dt") >= 2
    assert [float(r.dirty_price_wg_bf) for r in df.collect()] == [3.0]
