"""Both jobs from hand-made feeds to report tables."""

from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest

from ledgerloom.jobs import bond_job, common, rebuild_job, repo_job
from ledgerloom.plans import counters
from ledgerloom.sources import feeds, layouts, loaders, sinks
from ledgerloom.sources.store import Store
from ledgerloom.sources.tables import REPORT_TABLES

BOND_FEEDS = {
    "ev_cltrl_dtls": """RI_ID,EV_ID,RATIO,FACE,ID,X
B1,E1,0.9,300,1,x
B1,E2,0.5,100,2,x
B2,E1,0.8,50,3,x
0,E1,0.8,50,4,x
B1,E9,0.8,50,5,x
""",
    "bond_repo_deal": """REPO header,a,b,c,d,e,f,g,h
E1,,,,,2018-07-18,,1000,
E2,,,,,2018-07-18,,3000,
""",
    "trdx_deal_infrmn_rmv_d": "TRDX,a,b,c\n1,1,109,D9\n2,1,109,D1\n",
    "org": 'ORG,ID\n"Bank, One",C1\n',
    "bond_d": """BOND_ID,b,c,d,e,f,g,h,i,j,k,l,m,n
B1,国债,I1,MoF,"Note, 10y",CD1,K1,2018-01-02,2028-01-02,十年,C1,1000000,2018-01-05,p
B2,超短期融资券,I2,Corp,Bill,CD2,K2,2018-01-02,2018-12-02,短期,C7,500000,2018-01-05,p
""",
    "dps_v_cbt_all_txn_dtl": "DPS_ID,STRATEGY\nN1,0\nN2,3\nN3,\n",
    "after_hours_bond_type": "AFTER name,id\n大型银行,T1\n基金,T2\n",
    "member_d": """MEMBER,b,c,d,e,f,g,h,i
M1,T1,c1,Bank A,c1,Bank A,2018-01-01,2018-12-31,U1
M2,T2,c2,Fund B,c1,Bank A,2018-01-01,2018-07-18,U2
M3,T9,c3,Other,c3,Other,2018-01-01,2018-12-31,U3
""",
    "trdng_mthd_d": "trdng_id,name\nX1,匿名点击成交\nX2,协商\n",
    "bond_deal": """BOND_DEAL_ID,b,c,d,e,f,g,h,i,j,k,l,m,n,o
D1,M1,M2,N1,2018/07/18,1,B1,CNY,100,1000,900,0.5,99,3,X1
D2,M2,M1,N2,2018/07/18,1,B1,-,300,500,400,0.5,99,5,X2
D3,M1,M3,N9,2018/07/18,1,B1,CNY,100,200,100,2,99,4,X2
D4,M1,M2,N1,2018/07/18,2,B1,CNY,100,1000,900,1,99,3,X1
D5,M1,M2,N1,2018/07/18,1,B1,USD,100,1000,900,1,99,3,X1
D6,M1,M2,N1,2018/07/18,1,B7,CNY,100,1000,900,1,99,3,X1
D9,M1,M2,N1,2018/07/18,1,B1,CNY,100,1000,900,1,99,3,X1
D7,M3,M1,N3,2018/07/19,1,B2,CNY,50,60,70,12,99,2,X2
""",
}

REPO_FEEDS = {
    "pd_d": "PD,CD\nP1,R001\nP2,R007\nP3,R021\n",
    "market_close_type_i": "MARKET,b,c\n质押式回购,bank,银行\n质押式回购,fund,基金\n现券,bank,x\n",
    "member_ctgry_d": "MEMBER,n\nG1,bank\nG2,fund\nG3,other\n",
    "member_d": """MEMBER,b,c,d,e,f,g,h,i
I1,G1,c1,Bank One,,,2018/01/01,2018/12/31,U1
I2,G2,c2,某货币市场基金,c1,Bank One,2018/01/01,2018/12/31,U2
I3,G2,c3,Plain Fund,c1,Bank One,2018/01/01,2018/07/18,U3
I4,G3,c4,Broker,c4,Broker,2018/01/01,2018/12/31,U4
""",
    "bond_repo_deal": """EV,b,c,d,e,f,g,h,i,j
11002E1,I1,I4,P1,N1,S1,1,2018/07/18,2.5,100
11002E2,I2,I4,P1,N2,S2,1,2018/07/18,3.5,300
11002E3,I3,I4,P1,N3,S3,1,2018/07/18,4,100
11002E4,I4,I1,P1,N4,S1,1,2018/07/18,2,100
11002E5,I3,I4,P1,N5,S1,1,2018/07/19,9,900
11002E6,I1,I4,P1,N6,S1,2,2018/07/18,9,900
11002E7,I1,I4,P1,N7,S1,1,2018/07/18,9,900
11002E8,I1,I4,P3,N8,S1,1,2018/07/18,6,50
""",
    "trdx_deal_infrmn_rmv_d": "TRDX,b,c,d\n" + "".join(
        f"1,1,109,E{i}\n" for i in (1, 2, 3, 4, 5, 6, 8)) + "2,0,109,E7\n",
    "bond_d": "BOND,b,c,d\nB1,国债,J1,MoF\nB2,企业债,J2,Corp\n",
    "ri_credit_rtng": "RI,R\nS1,AAA\nS2,A-1+\n",
    "dps_v_cr_dep_txn_dtl": "DL,f\nN1,1\nN2,0\n",
    "ev_cltrl_dtls": "EV,b,c\nB1,11002E1,0.9\nB2,11002E1,0.7\nB9,11002E2,0.5\nB1,11002E8,1\nB1,11002E4,1\n",
}
DAY = date(2018, 7, 18)


def write(folder, feeds):
    folder.mkdir()
    for name, text in feeds.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


@pytest.fixture(scope="module")
def bond_reports(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("bond")
    bond_job.run(spark, write(base / "in", BOND_FEEDS), str(base / "out"), counts=True)
    return str(base / "out")


@pytest.fixture(scope="module")
def repo_reports(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("repo")
    repo_job.run(spark, write(base / "in", REPO_FEEDS), str(base / "out"), counts=True)
    return str(base / "out")


def report(spark, folder, name, *columns):
    df = sinks.read_report(spark, REPORT_TABLES[name], folder)
    got = [tuple(round(float(v), 6) if isinstance(v, Decimal) else v for v in r)
           for r in df.select(*columns).collect()]
    return sorted(got, key=str)


def test_all_reports_written(spark, bond_reports, repo_reports):
    for table in REPORT_TABLES.values():
        folder = bond_reports if table.name.startswith(("BOND", "XBOND")) else repo_reports
        df = sinks.read_report(spark, table, folder)
        assert df.count() > 0, table.name
        assert df.select(*table.key).distinct().count() == df.count(), table.name


def test_bond_info(spark, bond_reports):
    assert report(spark, bond_reports, "XBOND_INFO", "bond_cd", "bond_nm") == [("CD1", "Note, 10y")]
    got = report(spark, bond_reports, "BOND_BSC_INFO", "bond_id", "deal_dt", "cstdn", "bond_prd",
                 "trd_amnt", "deal_cnt", "day_turnover_rate", "issue_vlmn", "yr_of_time_to_mrty")
    assert got == [
        ("B1", DAY, "Bank, One", "十年", 1700.0, 3, 0.0014, 0.01, 0.5),
        ("B2", date(2018, 7, 19), "None", "短期", 60.0, 1, 0.00014, 0.005, 12.0)]


def test_turnover(spark, bond_reports):
    got = report(spark, bond_reports, "BOND_TURNOVER_RATE", "bond_id", "bond_prd", "bond_ctgry_nm2",
                 "day_turnover_rate", "trd_amnt_sum", "zy_rate")
    # (0.9 * 1000 + 0.5 * 3000) / 4000
    assert got == [
        ("B1", "一年以下(包括一年)", "国债", 0.0013, 1500.0, None),
        ("B1", "一年至三年(包括三年)", "国债", 0.0001, 200.0, None),
        ("B1", "全部", "国债", 0.0014, 1700.0, 0.6),
        ("B2", "全部", "短期融资券(包含超短融)", 0.00014, 60.0, 0.0),
        ("B2", "十年以上", "短期融资券(包含超短融)", 0.00014, 60.0, None)]


def test_income_and_types(spark, bond_reports):
    got = report(spark, bond_reports, "BOND_INCOME", "bond_id", "org_id", "buy_paper_all",
                 "buy_act_all", "sell_paper_all", "sell_act_all")
    assert got == [
        ("B1", "M1", 1000.0, 1200.0, 400.0, 500.0), ("B1", "M2", 400.0, 500.0, 900.0, 1000.0),
        ("B1", "M3", 0.0, 0.0, 100.0, 200.0), ("B2", "M1", 0.0, 0.0, 70.0, 60.0),
        ("B2", "M3", 70.0, 60.0, 0.0, 0.0)]
    got = report(spark, bond_reports, "BOND_DEAL_ORGTYPE", "bond_id", "ins_show_name", "trd_amnt",
                 "net_amnt")
    # the last day of M2's validity does not count, so M2 and the untyped M3 share "None"
    assert got == [("B1", "None", 1700.0, -600.0), ("B1", "大型银行", 1700.0, 600.0),
                   ("B2", "None", 60.0, 70.0), ("B2", "大型银行", 60.0, -70.0)]
    got = report(spark, bond_reports, "BOND_DEAL_ORGLIST", "bond_id", "bond_ctgry_id", "org_id",
                 "ins_show_name")
    assert ("B1", "K1", "M1", "大型银行") in got and len(got) == 5


def test_trends(spark, bond_reports):
    got = report(spark, bond_reports, "BOND_DEAL_TREND", "bond_id", "dirty_price_wg_bf",
                 "dirty_price_wg_af")
    # strategy trades D2 and D3 (no entry): (5*500 + 4*200) / 700
    assert got == [("B1", 4.714286, 3.0), ("B2", 0.0, 2.0)]
    got = report(spark, bond_reports, "BOND_DEAL_TREND_ORG", "bond_id", "org_id", "buy_ytm_rate_bf",
                 "buy_ytm_rate_af", "sell_ytm_rate_bf", "sell_ytm_rate_af")
    assert got[:3] == [("B1", "M1", 3.5, 3.0, 5.0, 0.0), ("B1", "M2", 5.0, 0.0, 3.0, 3.0),
                       ("B1", "M3", 0.0, 0.0, 4.0, 0.0)]
    got = report(spark, bond_reports, "BOND_DEAL_SMART", "bond_id", "trade_normal", "trade_smart")
    assert got == [("B1", 1, 2), ("B2", 1, 0)]


def test_member_price(spark, repo_reports):
    got = report(spark, repo_reports, "MEMBER_PRICE_DEAL_INFO", "unq_id_in_src_sys", "join_type",
                 "pd_cd", "deal_dt", "repo_weighted_price", "repo_sum_amount",
                 "rvrse_weighted_price", "rvrse_sum_amount", "price_difference", "total_amount")
    assert got == [
        ("U1", "产品", "R001", DAY, 3.625, 400.0, None, None, None, None),
        ("U1", "总额", "R001", DAY, 3.4, 500.0, 2.0, 100.0, -1.4, 600.0),
        ("U1", "自营", "R001", DAY, 2.5, 100.0, 2.0, 100.0, -0.5, 200.0),
        ("U1", "货币市场基金", "R001", DAY, 3.5, 300.0, None, None, None, None),
        ("U4", "总额", "R001", DAY, 2.0, 100.0, 3.4, 500.0, 1.4, 600.0),
        ("U4", "自营", "R001", DAY, 2.0, 100.0, 3.4, 500.0, 1.4, 600.0)]


def test_category_and_global_price(spark, repo_reports):
    got = report(spark, repo_reports, "CTGRY_PRICE_DEAL_INFO", "ins_show_name",
                 "repo_weighted_price", "repo_max_deal_repo_rate", "rvrse_min_deal_repo_rate",
                 "price_difference")
    assert got == [("None", 2.0, 2.0, 2.5, 1.4), ("基金", 3.625, 4.0, None, None),
                   ("银行", 2.5, 2.5, 2.0, -0.5)]
    got = report(spark, repo_reports, "GLOBAL_PRICE_DEAL_INFO", "pd_cd", "banks_weighted_price",
                 "market_weighted_price", "market_max_deal_repo_rate", "market_min_deal_repo_rate")
    assert got == [("R001", 2.5, 3.166667, 4.0, 2.0)]


def test_collateral_reports(spark, repo_reports):
    got = report(spark, repo_reports, "MEMBER_BOND_CTGRY_DEAL_INFO", "unq_id_in_src_sys",
                 "join_type", "bond_ctgry_nm", "repo_sum_amount", "rvrse_sum_amount")
    assert [r for r in got if r[0] == "U1"] == [
        ("U1", "产品", "None", 300.0, None), ("U1", "总额", "None", 300.0, None),
        ("U1", "总额", "信用债", 100.0, None), ("U1", "总额", "利率债", 150.0, 100.0),
        ("U1", "自营", "信用债", 100.0, None), ("U1", "自营", "利率债", 150.0, 100.0),
        ("U1", "货币市场基金", "None", 300.0, None)]
    got = report(spark, repo_reports, "CTGRY_BOND_RTNG_DEAL_INFO", "ins_show_name", "rtng_desc",
                 "repo_sum_amount", "rvrse_sum_amount")
    # E1 has two collateral lines, so its amount counts twice
    assert got == [("None", "AA+", None, 300.0), ("None", "AAA", 100.0, 250.0),
                   ("基金", "AA+", 300.0, None), ("银行", "AAA", 250.0, 100.0)]
    got = report(spark, repo_reports, "CTGRY_BOND_ISSR_DEAL_INFO", "ins_show_name", "issr_nm",
                 "repo_weighted_cnvrsn_prprtn", "rvrse_weighted_cnvrsn_prprtn")
    assert ("银行", "MoF", 0.933333, 1.0) in got and ("银行", "Corp", 0.7, None) in got


def test_counterparties(spark, repo_reports):
    got = report(spark, repo_reports, "MEMBER_CTGRY_NUMBER_DEAL_INFO", "ins_show_name",
                 "unq_id_in_src_sys", "join_type", "cou_party_ins_show_name",
                 "repo_cou_party_uniq_set", "rvrse_cou_party_uniq_set")
    assert got == [
        ("None", "U4", "总额", "基金", None, "U2"), ("None", "U4", "总额", "银行", "U1", "U1"),
        ("None", "U4", "自营", "基金", None, "U2"), ("None", "U4", "自营", "银行", "U1", "U1"),
        ("银行", "U1", "产品", "None", "U4", None), ("银行", "U1", "总额", "None", "U4", "U4"),
        ("银行", "U1", "自营", "None", "U4", "U4"), ("银行", "U1", "货币市场基金", "None", "U4", None)]
    got = report(spark, repo_reports, "CTGRY_CTGRY_AMOUNT_DEAL_INFO", "ins_show_name",
                 "cou_party_ins_show_name", "repo_sum_amount", "rvrse_sum_amount")
    assert ("银行", "None", 250.0, 100.0) in got


def counted(spark, path, value):
    return {r[0]: r[value] for r in spark.read.parquet(path).collect()}


def test_load_counts(spark, bond_reports, repo_reports):
    counts = counted(spark, f"{bond_reports}/bond_job/load_counts", "n_rows")
    assert counts["bond_deal"] == 8 and counts["member_d"] == 3
    counts = counted(spark, f"{repo_reports}/repo_job/load_counts", "n_rows")
    assert counts["member_d"] == 4 and counts["bond_repo_deal"] == 8


def test_lookup_misses(spark, bond_reports, repo_reports):
    assert counted(spark, f"{bond_reports}/bond_job/lookup_misses", "misses") == {
        "bond_custodian": 1, "institution_type": 1, "deal_date": 0, "deal_amount": 0,
        "deal_strategy": 1, "deal_buyer": 0, "deal_seller": 0, "collateral_rate": 2}
    assert counted(spark, f"{repo_reports}/repo_job/lookup_misses", "misses") == {
        "member_type": 1, "member_root": 0, "repo_deal_date": 0, "repo_deal_amount": 0,
        "deal_repo_party": 0, "deal_rvrse_party": 0,
        "deal_product": 0, "deal_rating": 1, "collateral_bond": 1}


def test_counters_equal_the_queries(spark, tmp_path):
    """What a run counts as it writes is what the counter queries count on the same inputs."""
    for job, feeds_of, make, query, source in (
            (bond_job, layouts.BOND_JOB_FEEDS, loaders.bond_inputs, counters.bond_misses, BOND_FEEDS),
            (repo_job, layouts.REPO_JOB_FEEDS, loaders.repo_inputs, counters.repo_misses, REPO_FEEDS)):
        folder, out = write(tmp_path / job.JOB, source), str(tmp_path / f"{job.JOB}_out")
        job.run(spark, folder, out, counts=True)
        run = common.Run(spark, str(tmp_path / f"{job.JOB}_again"))
        inputs = make(run.feeds(folder, feeds_of, job.JOB))
        assert counted(spark, f"{out}/{job.JOB}/lookup_misses", "misses") == {
            r["counter"]: r["misses"] for r in query(inputs).collect()}


def test_counters_add_no_scan(spark, tmp_path, monkeypatch):
    """With counts a run reads the text of each feed as often as without: once."""
    parsed = []
    reader = feeds.read_lines
    monkeypatch.setattr(feeds, "read_lines", lambda *a, **k: parsed.append(a[1]) or reader(*a, **k))
    folder = write(tmp_path / "in", REPO_FEEDS)
    for counts in (False, True):
        parsed.clear()
        repo_job.run(spark, folder, str(tmp_path / f"out{counts}"), counts=counts)
        assert sorted(parsed) == sorted(common.feed_paths(folder, layouts.REPO_JOB_FEEDS).values())


def test_rejects_are_written(spark, tmp_path):
    dirty = BOND_FEEDS["bond_deal"] + "D12,too,few\n\n"
    nameless = BOND_FEEDS["dps_v_cbt_all_txn_dtl"] + ",3\n"
    folder = write(tmp_path / "in", {**BOND_FEEDS, "bond_deal": dirty, "dps_v_cbt_all_txn_dtl": nameless})
    bond_job.run(spark, folder, str(tmp_path / "out"))
    rejects = spark.read.parquet(str(tmp_path / "out" / "bond_job" / "rejects")).collect()
    assert sorted((r.feed, r.reason, r.line) for r in rejects) == [
        ("bond_deal", "field count", "D12,too,few"), ("dps_v_cbt_all_txn_dtl", "empty field", ",3")]
    assert all(r.file.endswith(f"/{r.feed}.csv") and r.split_start == 0 for r in rejects)


def test_last_line_of_a_key_holds(spark, tmp_path):
    """Names are not the greatest text but the last one."""
    twice = BOND_FEEDS["org"] + "Zeta Bank,C2\nAlpha Bank,C2\n"
    bonds = BOND_FEEDS["bond_d"].replace(",C1,", ",C2,")
    out = str(tmp_path / "out")
    bond_job.run(spark, write(tmp_path / "in", {**BOND_FEEDS, "org": twice, "bond_d": bonds}), out)
    assert ("B1", "Alpha Bank") in report(spark, out, "BOND_BSC_INFO", "bond_id", "cstdn")


def test_reader_sees_one_set_of_tables(spark, tmp_path, monkeypatch):
    """During a rebuild, and after one that failed half-way, readers see the old tables, all of them."""
    bond_in, repo_in = write(tmp_path / "b", BOND_FEEDS), write(tmp_path / "r", REPO_FEEDS)
    out = str(tmp_path / "out")
    assert rebuild_job.run(spark, bond_in, repo_in, out) == 1
    shown = Store(spark, out).snapshot()
    assert set(shown.parts) == set(REPORT_TABLES)
    old = {name: shown.read(table).collect() for name, table in REPORT_TABLES.items()}

    other = {name: text.replace("2018/07/18", "2018/07/17") for name, text in REPO_FEEDS.items()}
    seen, plain = [], Store.write

    def fails_late(store, df, table):
        part = plain(store, df, table)
        seen.append(Store(spark, out).snapshot().number)
        if table.name == "CTGRY_BOND_ISSR_DEAL_INFO":
            raise OSError("disk lost")
        return part

    monkeypatch.setattr(Store, "write", fails_late)
    repo_other = write(tmp_path / "r2", other)
    with pytest.raises(OSError):
        rebuild_job.run(spark, bond_in, repo_other, out)
    assert len(seen) > 20 and set(seen) == {1}
    now = Store(spark, out).snapshot()
    assert now.parts == shown.parts
    assert {name: now.read(table).collect() for name, table in REPORT_TABLES.items()} == old

    monkeypatch.setattr(Store, "write", plain)
    assert rebuild_job.run(spark, bond_in, repo_other, out) == 2
    assert {name: shown.read(table).collect() for name, table in REPORT_TABLES.items()} == old  # an open reader
    newer = Store(spark, out).snapshot()
    days = {r.deal_dt for r in newer.read(REPORT_TABLES["GLOBAL_PRICE_DEAL_INFO"]).collect()}
    assert days == {date(2018, 7, 17)}


def test_dirty_deals(spark, tmp_path):
    """A bad date drops the deal, a bad number only its measure; both are counted."""
    dirty = BOND_FEEDS["bond_deal"] + (
        "D10,M1,M2,N1,2018/07/45,1,B1,CNY,100,1000,900,1,99,3,X1\n"
        "D11,M1,M2,N1,2018/07/18,1,B1,CNY,n/a,1000,900,,99,3,X1\n")
    out = str(tmp_path / "out")
    bond_job.run(spark, write(tmp_path / "in", {**BOND_FEEDS, "bond_deal": dirty}), out, counts=True)
    missed = counted(spark, f"{out}/bond_job/lookup_misses", "misses")
    assert missed["deal_date"] == 1 and missed["deal_amount"] == 1
    got = report(spark, out, "BOND_TURNOVER_RATE", "bond_id", "bond_prd", "trd_amnt_sum")
    assert ("B1", "全部", 2700.0) in got and ("B1", "None", 1000.0) in got
    got = report(spark, out, "BOND_DEAL_TREND_ORG", "bond_id", "org_id", "buy_ytm_rate_bf")
    assert ("B1", "M1", 3.5) in got


def test_late_deals_are_upserted(spark, tmp_path):
    out = str(tmp_path / "out")
    bond_job.run(spark, write(tmp_path / "in", BOND_FEEDS), out)
    header = BOND_FEEDS["bond_deal"].splitlines()[0]
    late = header + "\nD8,M1,M2,N1,2018/07/19,1,B2,CNY,100,40,30,12,99,3,X1\n"
    bond_job.run(spark, write(tmp_path / "late", {**BOND_FEEDS, "bond_deal": late}), out, upsert=True)
    got = report(spark, out, "BOND_DEAL_SMART", "bond_id", "deal_dt", "trade_normal")
    assert got == [("B1", DAY, 1), ("B2", date(2018, 7, 19), 1)]
    got = report(spark, out, "BOND_INCOME", "bond_id", "org_id", "buy_act_all")
    assert ("B1", "M1", 1200.0) in got and ("B2", "M1", 40.0) in got and ("B2", "M3", 60.0) in got
    assert report(spark, out, "XBOND_INFO", "bond_cd") == [("CD1",), ("CD2",)]


def test_staged_relations_follow_the_checkpoint_setting(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common.Run, "close", lambda run: None)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("run-*/bond_job/deals"))
    bond_job.run(spark, write(tmp_path / "in", BOND_FEEDS), str(tmp_path / "out"))
    assert len(set(shared.glob("run-*/bond_job/deals")) - before) == 1
    assert not (tmp_path / "out" / "_stage").exists()


def test_staged_relations_without_the_setting(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda spark, fallback: fallback)
    run = common.Run(spark, str(tmp_path / "out"))
    assert run.stage(spark.range(3), "numbers").count() == 3
    assert len(list((tmp_path / "out" / "_stage").glob("run-*/numbers"))) == 1


def test_stage_folder_is_removed(repo_reports, bond_reports):
    for out in (repo_reports, bond_reports):
        staged = Path(out) / "_stage"
        assert not staged.exists() or not any(staged.iterdir())


def test_fan_out_is_not_stored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_folder", lambda spark, fallback: fallback)
    monkeypatch.setattr(common.Run, "close", lambda run: None)
    repo_job.run(spark, write(tmp_path / "in", REPO_FEEDS), str(tmp_path / "out"))
    staged = {p.name for p in (tmp_path / "out" / "_stage").glob("run-*/repo_job/*")}
    assert staged == {"feeds", "deals", "line_sets", "deal_sets", "inputs", "profiles"}
