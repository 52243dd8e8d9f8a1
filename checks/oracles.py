"""SQL counterparts of the registered queries, for an independent engine.

The views repeat FIXTURES.md part B. Where the plans use one pass, the SQL uses the
long way round (full outer joins, one branch per report group, windows).
"""

from __future__ import annotations

import re

VIEWS = {
    "v_bond": """
        SELECT s_suppkey AS bond_id, s_name AS bond_nm,
               concat('CD', CAST(s_suppkey AS VARCHAR)) AS bond_cd,
               CAST(s_suppkey % 9 AS VARCHAR) AS bond_ctgry_id,
               CASE s_suppkey % 9 WHEN 0 THEN '国债' WHEN 1 THEN '政策性金融债' WHEN 2 THEN '同业存单'
                    WHEN 3 THEN '短期融资券' WHEN 4 THEN '超短期融资券' WHEN 5 THEN '地方政府债'
                    WHEN 6 THEN '企业债' WHEN 7 THEN '中期票据' ELSE '金融债' END AS bond_ctgry_nm,
               CASE s_suppkey % 9 WHEN 0 THEN '国债' WHEN 1 THEN '政策性金融债' WHEN 2 THEN '同业存单'
                    WHEN 3 THEN '短期融资券(包含超短融)' WHEN 4 THEN '短期融资券(包含超短融)'
                    WHEN 5 THEN '地方政府债' WHEN 6 THEN '企业债' WHEN 7 THEN '中期票据'
                    ELSE '其他' END AS bond_ctgry_nm2,
               DATE '1995-01-01' AS frst_value_dt, DATE '2010-01-01' AS mrty_dt,
               CASE WHEN s_acctbal >= 0 THEN DATE '1995-01-10' END AS lstng_dt,
               CASE WHEN s_acctbal < 5000 THEN '短期' ELSE '中长期' END AS scnd_blngl_desc,
               s_nationkey AS cstdtn_bank_id,
               CAST(1000000 + s_suppkey * 1000 AS DECIMAL(18,2)) AS ttl_face_value
        FROM supplier""",
    "v_org": "SELECT n_nationkey AS unq_id, n_name AS chn_full_nm FROM nation WHERE n_nationkey < 20",
    "v_inst": """
        SELECT n_nationkey AS ip_id, r_name AS ins_show_name,
               DATE '1996-01-01' AS efctv_from_dt, DATE '2000-10-01' AS efctv_to_dt
        FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey <> 24""",
    "v_strategy": """
        SELECT o_orderkey AS deal_nmbr, substr(o_orderpriority, 1, 1) AS deal_strategy
        FROM orders WHERE o_orderkey % 10 <> 9""",
    "v_removed": "SELECT o_orderkey AS deal_id FROM orders WHERE o_orderstatus = 'P'",
    "v_deal": """
        SELECT l_orderkey AS bond_deal_id, l_orderkey AS deal_nmbr, c_nationkey AS buyer_id,
               CAST(l_partkey % 25 AS INT) AS seller_id, l_suppkey AS bond_id,
               CAST(date_trunc('quarter', l_shipdate) AS DATE) AS deal_dt,
               l_returnflag AS st, l_linenumber AS trdng_mthd_id,
               CAST(l_linenumber * 2 AS DECIMAL(9,2)) AS yr_of_time_to_mrty,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS dirty_amnt,
               CAST(l_quantity AS DECIMAL(18,2)) AS face_amnt,
               CAST(l_discount AS DECIMAL(9,4)) AS ytm_rate,
               CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS trade_amnt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "v_member": """
        SELECT c_custkey AS uniq, c_custkey - c_custkey % 10 AS root_uniq, c_name AS full_nm,
               c_mktsegment AS ins_show_name, DATE '1995-03-01' AS efctv_from_dt,
               DATE '2001-06-01' AS efctv_to_dt
        FROM customer WHERE c_custkey % 50 <> 49""",
    "v_repo": """
        SELECT o_orderkey AS ev_id, o_orderkey AS deal_nmbr, o_custkey AS repo_uniq,
               o_orderkey % 97 AS rvrse_uniq, o_orderstatus AS st,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'R001' WHEN '2' THEN 'R007'
                    WHEN '3' THEN 'R014' WHEN '4' THEN 'R021' ELSE 'None' END AS pd_cd,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS deal_dt,
               CAST((100 + o_orderkey % 400) AS DECIMAL(9,4)) AS deal_repo_rate,
               CAST(o_totalprice AS DECIMAL(18,2)) AS trade_amnt
        FROM orders""",
    "v_cltrl": """
        SELECT l_orderkey AS ev_id, l_partkey AS ri_id,
               CAST(1 - l_discount AS DECIMAL(9,4)) AS cnvrsn_prprtn,
               CAST(l_quantity AS DECIMAL(18,2)) AS total_face_value
        FROM lineitem""",
    "v_cbond": """
        SELECT p_partkey AS bond_id, p_brand AS issr_nm,
               CASE WHEN p_type IN ('STANDARD', 'PROMO') THEN '利率债' WHEN p_type = 'ECONOMY'
                    THEN '同业存单' ELSE '信用债' END AS bond_class
        FROM part WHERE p_size <= 48""",
    "v_rating": """
        SELECT o_orderkey AS ri_id, CASE WHEN o_orderkey % 5 = 0 THEN 'AAA'
                    WHEN o_orderkey % 5 = 1 THEN 'AA+' ELSE 'AA及以下' END AS rtng_desc
        FROM orders WHERE o_orderkey % 5 <> 4""",
    "v_bank": "SELECT o_orderkey AS deal_nmbr FROM orders WHERE o_orderkey % 3 = 0",
    "v_trade": """
        SELECT CAST(o_orderdate AS DATE) AS deal_dt, CAST(o_custkey AS VARCHAR) AS org_nm,
               o_orderstatus AS player_type, o_orderpriority AS bond_type,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderkey AS deal_nmbr,
               concat(o_orderstatus, substr(o_orderpriority, 1, 1)) AS bond_id
        FROM orders""",
    # ---- base relations
    "t1": """
        SELECT d.*, CASE WHEN s.deal_nmbr IS NULL THEN 'None' WHEN s.deal_strategy IN ('0', '4')
                         THEN '正常' ELSE '策略性交易' END AS strategy,
               CASE WHEN yr_of_time_to_mrty <= 1 THEN '一年以下(包括一年)'
                    WHEN yr_of_time_to_mrty <= 3 THEN '一年至三年(包括三年)'
                    WHEN yr_of_time_to_mrty <= 5 THEN '三年至五年(包括五年)'
                    WHEN yr_of_time_to_mrty <= 7 THEN '五年至七年(包括七年)'
                    WHEN yr_of_time_to_mrty <= 10 THEN '七年至十年(包括十年)'
                    ELSE '十年以上' END AS tenor
        FROM v_deal d LEFT JOIN v_strategy s ON d.deal_nmbr = s.deal_nmbr
        WHERE d.st <> 'R' AND d.bond_deal_id NOT IN (SELECT deal_id FROM v_removed)
          AND d.bond_id IN (SELECT bond_id FROM v_bond)""",
    "buys": """
        SELECT deal_dt, bond_id, buyer_id AS org_id, sum(dirty_amnt) AS act, sum(face_amnt) AS paper,
               sum(ytm_rate * trade_amnt) AS w_bf, sum(trade_amnt) AS a_bf,
               sum(ytm_rate * trade_amnt) FILTER (strategy = '正常') AS w_af,
               sum(trade_amnt) FILTER (strategy = '正常') AS a_af
        FROM t1 WHERE buyer_id IS NOT NULL GROUP BY ALL""",
    "sells": """
        SELECT deal_dt, bond_id, seller_id AS org_id, sum(dirty_amnt) AS act, sum(face_amnt) AS paper,
               sum(ytm_rate * trade_amnt) AS w_bf, sum(trade_amnt) AS a_bf,
               sum(ytm_rate * trade_amnt) FILTER (strategy = '正常') AS w_af,
               sum(trade_amnt) FILTER (strategy = '正常') AS a_af
        FROM t1 WHERE seller_id IS NOT NULL GROUP BY ALL""",
    "t2": """
        SELECT deal_dt, bond_id, org_id, coalesce(b.act, 0) AS buy_act_all,
               coalesce(b.paper, 0) AS buy_paper_all, coalesce(s.act, 0) AS sell_act_all,
               coalesce(s.paper, 0) AS sell_paper_all,
               coalesce({q(b.w_bf,b.a_bf)}, 0) AS buy_ytm_rate_bf,
               coalesce({q(b.w_af,b.a_af)}, 0) AS buy_ytm_rate_af,
               coalesce({q(s.w_bf,s.a_bf)}, 0) AS sell_ytm_rate_bf,
               coalesce({q(s.w_af,s.a_af)}, 0) AS sell_ytm_rate_af,
               coalesce(i.ins_show_name, 'None') AS ins_show_name
        FROM buys b FULL JOIN sells s USING (deal_dt, bond_id, org_id)
        LEFT JOIN v_inst i ON org_id = i.ip_id AND deal_dt > i.efctv_from_dt AND deal_dt < i.efctv_to_dt""",
    "t3": """
        SELECT c.ri_id, r.deal_dt,
               coalesce({q(sum(c.cnvrsn_prprtn * r.trade_amnt),sum(r.trade_amnt))}, 0) AS zy_rate
        FROM v_cltrl c, v_repo r WHERE c.ev_id = r.ev_id AND c.ri_id <> 0
        GROUP BY c.ri_id, r.deal_dt""",
    "parties": """
        SELECT m.uniq, CAST(m.uniq AS VARCHAR) AS unq, coalesce(CAST(r.uniq AS VARCHAR), 'None') AS root,
               m.full_nm, m.ins_show_name, m.efctv_from_dt, m.efctv_to_dt
        FROM v_member m LEFT JOIN v_member r ON m.root_uniq = r.uniq""",
    "r1": """
        SELECT d.ev_id, d.deal_nmbr, d.pd_cd, d.deal_dt, d.deal_repo_rate, d.trade_amnt,
               p.unq AS repo_unq, p.root AS repo_root, p.full_nm AS repo_nm, p.ins_show_name AS repo_type,
               q.unq AS rvrse_unq, q.root AS rvrse_root, q.full_nm AS rvrse_nm,
               q.ins_show_name AS rvrse_type, coalesce(g.rtng_desc, 'None') AS rtng_desc,
               b.deal_nmbr IS NOT NULL AS is_bank_deal
        FROM v_repo d
        JOIN parties p ON d.repo_uniq = p.uniq AND d.deal_dt BETWEEN p.efctv_from_dt AND p.efctv_to_dt
        JOIN parties q ON d.rvrse_uniq = q.uniq AND d.deal_dt BETWEEN q.efctv_from_dt AND q.efctv_to_dt
        LEFT JOIN v_rating g ON d.ev_id = g.ri_id
        LEFT JOIN v_bank b ON d.deal_nmbr = b.deal_nmbr
        WHERE d.st <> 'P' AND d.ev_id IN (SELECT deal_nmbr FROM v_strategy)""",
    "r2": "SELECT * FROM r1 WHERE pd_cd IN ('R001', 'R007', 'R014')",
    "r3": """
        SELECT r1.*, c.ri_id AS bond_id, c.cnvrsn_prprtn, coalesce(k.bond_class, 'None') AS bond_class,
               coalesce(k.issr_nm, 'None') AS issr_nm
        FROM r1 JOIN v_cltrl c ON r1.ev_id = c.ev_id LEFT JOIN v_cbond k ON c.ri_id = k.bond_id""",
}


def _round(value: str) -> str:
    return f"CAST(round(round(CAST({value} AS DECIMAL(38,12)), 10), 6) AS DOUBLE)"


def _q(numerator: str, denominator: str) -> str:
    return _round(f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0)")


def _expand(sql: str) -> str:
    sql = re.sub(r"\{r\((.+?)\)\}", lambda m: _round(m[1]), sql)
    return re.sub(r"\{q\((.+?),([^,]+?)\)\}", lambda m: _q(m[1], m[2]), sql)


def _with_views(sql: str) -> str:
    """Prefix the views the statement needs, in order of dependency."""
    sql = _expand(sql)
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(_expand(body))
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({_expand(VIEWS[n])})" for n in needed) + "\n" + sql


def _dbl(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c.split('.')[-1]}" for c in columns)


# ---------------------------------------------------------------- repo report SQL

_SIDES = {"repo": ("repo", "rvrse"), "rvrse": ("rvrse", "repo")}
_GROUPS = {
    "总额": "TRUE",
    "自营": "{own}_unq = {own}_root",
    "产品": "{own}_unq <> {own}_root",
    "货币市场基金": "{own}_unq <> {own}_root AND {own}_nm LIKE '%7%'",
}


def _member_side(base: str, side: str, keys: dict[str, str], measures: dict[str, str]) -> str:
    own, other = _SIDES[side]
    names = ", ".join(f"{e.format(own=own, other=other)} AS {n}" for n, e in keys.items())
    sums = ", ".join(f"{e.format(own=own, other=other)} AS {side}_{n}" for n, e in measures.items())
    branches = [
        f"SELECT {own}_root AS unq_id_in_src_sys, '{group}' AS join_type, {names}, {sums} "
        f"FROM {base} WHERE {test.format(own=own)} GROUP BY ALL"
        for group, test in _GROUPS.items()
    ]
    return "\nUNION ALL ".join(branches)


def _category_side(base: str, side: str, keys: dict[str, str], measures: dict[str, str]) -> str:
    own, other = _SIDES[side]
    names = ", ".join(f"{e.format(own=own, other=other)} AS {n}" for n, e in keys.items())
    sums = ", ".join(f"{e.format(own=own, other=other)} AS {side}_{n}" for n, e in measures.items())
    return f"SELECT {own}_type AS ins_show_name, {names}, {sums} FROM {base} GROUP BY ALL"


def _both_sides(build, base, lead, keys, measures, output) -> str:
    using = ", ".join([*lead, *keys])
    return (
        f"SELECT {using}, {output} FROM ({build(base, 'repo', keys, measures)}) a "
        f"FULL JOIN ({build(base, 'rvrse', keys, measures)}) b USING ({using})"
    )


_ROOT = ["unq_id_in_src_sys", "join_type"]
_TYPE = ["ins_show_name"]
_AMOUNTS = {"amount": "sum(trade_amnt)"}
_PRICES = {"weighted": "sum(deal_repo_rate * trade_amnt)", "amount": "sum(trade_amnt)"}
_RATIOS = {"weighted": "sum(cnvrsn_prprtn * trade_amnt)", "amount": "sum(trade_amnt)"}
_OUT_AMOUNTS = ("CAST(repo_amount AS DOUBLE) AS repo_sum_amount, "
                "CAST(rvrse_amount AS DOUBLE) AS rvrse_sum_amount")
_OUT_RATIOS = ("{q(repo_weighted,repo_amount)} AS repo_weighted_cnvrsn_prprtn, "
               "{q(rvrse_weighted,rvrse_amount)} AS rvrse_weighted_cnvrsn_prprtn")
_OUT_PRICES = ("{q(repo_weighted,repo_amount)} AS repo_weighted_price, "
               "{q(rvrse_weighted,rvrse_amount)} AS rvrse_weighted_price")
_SPREAD = _round("CAST(rvrse_weighted AS DOUBLE) / CAST(rvrse_amount AS DOUBLE) "
                 "- CAST(repo_weighted AS DOUBLE) / CAST(repo_amount AS DOUBLE)") + " AS price_difference"


def _plain(*columns: str) -> dict[str, str]:
    return {c: c for c in columns}


_CLASS = {"bond_ctgry_nm": "bond_class", "deal_dt": "deal_dt"}
_RATING = _plain("rtng_desc", "deal_dt")
_CLASS_RATING = {"bond_ctgry_nm": "bond_class", "rtng_desc": "rtng_desc", "deal_dt": "deal_dt"}
_ISSUER = _plain("issr_nm", "deal_dt")
_OTHER_TYPE = {"cou_party_ins_show_name": "{other}_type", "deal_dt": "deal_dt"}


def _repo_reports() -> dict[str, str]:
    def member(base, keys, measures, output):
        return _both_sides(_member_side, base, _ROOT, keys, measures, output)

    def category(base, keys, measures, output):
        return _both_sides(_category_side, base, _TYPE, keys, measures, output)

    extremes = {**_PRICES, "max": "max(deal_repo_rate)", "min": "min(deal_repo_rate)"}
    out_extremes = ", ".join(
        f"CAST({s}_{m} AS DOUBLE) AS {s}_{m}_deal_repo_rate" for s in _SIDES for m in ("max", "min"))
    sets = {"cou_party_uniq_set": "string_agg(DISTINCT {other}_unq, ',' ORDER BY {other}_unq)"}
    numbers = member("r3", _OTHER_TYPE, sets, "repo_cou_party_uniq_set, rvrse_cou_party_uniq_set")
    return {
        "m10_member_price": member(
            "r2", _plain("pd_cd", "deal_dt"), _PRICES,
            f"{_OUT_PRICES}, {_OUT_AMOUNTS}, {_SPREAD}, "
            "CAST(repo_amount + rvrse_amount AS DOUBLE) AS total_amount"),
        "m11_ctgry_price": category(
            "r2", _plain("pd_cd", "deal_dt"), extremes, f"{_OUT_PRICES}, {out_extremes}, {_SPREAD}"),
        "m12_global_price": """
            SELECT m.pd_cd, m.deal_dt, {q(b.w,b.a)} AS banks_weighted_price,
                   CAST(b.hi AS DOUBLE) AS banks_max_deal_repo_rate,
                   CAST(b.lo AS DOUBLE) AS banks_min_deal_repo_rate,
                   {q(m.w,m.a)} AS market_weighted_price,
                   CAST(m.hi AS DOUBLE) AS market_max_deal_repo_rate,
                   CAST(m.lo AS DOUBLE) AS market_min_deal_repo_rate
            FROM (SELECT pd_cd, deal_dt, sum(deal_repo_rate * trade_amnt) AS w, sum(trade_amnt) AS a,
                         max(deal_repo_rate) AS hi, min(deal_repo_rate) AS lo
                  FROM r2 GROUP BY ALL) m
            LEFT JOIN (SELECT pd_cd, deal_dt, sum(deal_repo_rate * trade_amnt) AS w,
                              sum(trade_amnt) AS a, max(deal_repo_rate) AS hi,
                              min(deal_repo_rate) AS lo
                       FROM r2 WHERE is_bank_deal GROUP BY ALL) b
              ON m.pd_cd = b.pd_cd AND m.deal_dt = b.deal_dt""",
        "m13_member_bond_ctgry": member("r3", _CLASS, _AMOUNTS, _OUT_AMOUNTS),
        "m14_ctgry_bond_ctgry": category("r3", _CLASS, _AMOUNTS, _OUT_AMOUNTS),
        "m15_member_bond_rtng": member("r3", _RATING, _AMOUNTS, _OUT_AMOUNTS),
        "m16_ctgry_bond_rtng": category("r3", _RATING, _AMOUNTS, _OUT_AMOUNTS),
        "m17_member_bond_type": member(
            "r3", _CLASS_RATING, _RATIOS, f"{_OUT_RATIOS}, {_OUT_AMOUNTS}"),
        "m18_ctgry_bond_type": category("r3", _CLASS_RATING, _RATIOS, _OUT_RATIOS),
        "m19_member_bond_issr": member("r3", _ISSUER, _RATIOS, f"{_OUT_RATIOS}, {_OUT_AMOUNTS}"),
        "m20_ctgry_bond_issr": category("r3", _ISSUER, _RATIOS, _OUT_RATIOS),
        "m21_member_ctgry_amount": member("r3", _OTHER_TYPE, _AMOUNTS, _OUT_AMOUNTS),
        "m22_ctgry_ctgry_amount": category("r3", _OTHER_TYPE, _AMOUNTS, _OUT_AMOUNTS),
        "m23_member_ctgry_number": f"""
            SELECT coalesce(p.ins_show_name, 'None') AS ins_show_name, n.*
            FROM ({numbers}) n LEFT JOIN parties p ON n.unq_id_in_src_sys = p.unq""",
    }


# ---------------------------------------------------------------- bond report SQL

_BOND_REPORTS = {
    "m01_xbond_info": """
        SELECT b.bond_cd, min(b.bond_nm) AS bond_nm FROM t1 JOIN v_bond b ON t1.bond_id = b.bond_id
        WHERE t1.trdng_mthd_id IN (1, 2) GROUP BY b.bond_cd""",
    "m02_bond_bsc_info": f"""
        SELECT t1.deal_dt, t1.bond_id, b.bond_cd, b.bond_nm, b.bond_ctgry_nm,
               CAST(min(t1.yr_of_time_to_mrty) AS DOUBLE) AS yr_of_time_to_mrty,
               b.frst_value_dt, b.mrty_dt, b.scnd_blngl_desc AS bond_prd,
               {_q('b.ttl_face_value', '100000000')} AS issue_vlmn,
               coalesce(o.chn_full_nm, 'None') AS cstdn,
               CAST(sum(t1.dirty_amnt) AS DOUBLE) AS trd_amnt,
               count(DISTINCT t1.bond_deal_id) AS deal_cnt,
               {_q('sum(t1.face_amnt)', 'b.ttl_face_value')} AS day_turnover_rate
        FROM t1 JOIN v_bond b ON t1.bond_id = b.bond_id LEFT JOIN v_org o ON b.cstdtn_bank_id = o.unq_id
        WHERE b.lstng_dt IS NOT NULL
        GROUP BY t1.deal_dt, t1.bond_id, b.bond_cd, b.bond_nm, b.bond_ctgry_nm, b.frst_value_dt,
                 b.mrty_dt, b.scnd_blngl_desc, b.ttl_face_value, o.chn_full_nm""",
    "m03_bond_turnover_rate": f"""
        SELECT f.deal_dt, f.bond_id, f.bond_prd, b.bond_ctgry_nm2, b.bond_cd, b.bond_nm,
               {_q('f.face_sum', 'b.ttl_face_value')} AS day_turnover_rate,
               CAST(f.trd_amnt_sum AS DOUBLE) AS trd_amnt_sum,
               CASE WHEN f.bond_prd = '全部' THEN coalesce(t3.zy_rate, 0) END AS zy_rate
        FROM (SELECT deal_dt, bond_id, '全部' AS bond_prd, sum(face_amnt) AS face_sum,
                     sum(dirty_amnt) AS trd_amnt_sum FROM t1 GROUP BY ALL
              UNION ALL
              SELECT deal_dt, bond_id, tenor, sum(face_amnt), sum(dirty_amnt) FROM t1
              GROUP BY deal_dt, bond_id, tenor) f
        JOIN v_bond b ON f.bond_id = b.bond_id
        LEFT JOIN t3 ON f.bond_id = t3.ri_id AND f.deal_dt = t3.deal_dt""",
    "m04_bond_income": f"""
        SELECT t2.deal_dt, t2.bond_id, t2.org_id, b.bond_cd, b.bond_nm,
               {_dbl('buy_paper_all', 'buy_act_all', 'sell_paper_all', 'sell_act_all')}
        FROM t2 JOIN v_bond b ON t2.bond_id = b.bond_id""",
    "m05_bond_deal_trend": f"""
        SELECT t1.deal_dt, t1.bond_id, b.bond_cd, b.bond_nm,
               coalesce({_q("sum(ytm_rate * dirty_amnt) FILTER (strategy <> '正常')",
                            "sum(dirty_amnt) FILTER (strategy <> '正常')")}, 0) AS dirty_price_wg_bf,
               coalesce({_q("sum(ytm_rate * dirty_amnt) FILTER (strategy = '正常')",
                            "sum(dirty_amnt) FILTER (strategy = '正常')")}, 0) AS dirty_price_wg_af
        FROM t1 JOIN v_bond b ON t1.bond_id = b.bond_id
        GROUP BY t1.deal_dt, t1.bond_id, b.bond_cd, b.bond_nm""",
    "m06_bond_deal_trend_org": """
        SELECT t2.deal_dt, t2.bond_id, t2.org_id, b.bond_cd, b.bond_nm, ins_show_name,
               buy_ytm_rate_bf, buy_ytm_rate_af, sell_ytm_rate_bf, sell_ytm_rate_af
        FROM t2 JOIN v_bond b ON t2.bond_id = b.bond_id""",
    "m07_bond_deal_orgtype": """
        SELECT t2.deal_dt, t2.bond_id, ins_show_name, b.bond_cd, b.bond_nm,
               CAST(sum(buy_act_all + sell_act_all) AS DOUBLE) AS trd_amnt,
               CAST(sum(buy_paper_all - sell_paper_all) AS DOUBLE) AS net_amnt
        FROM t2 JOIN v_bond b ON t2.bond_id = b.bond_id
        GROUP BY t2.deal_dt, t2.bond_id, ins_show_name, b.bond_cd, b.bond_nm""",
    "m08_bond_deal_orglist": """
        SELECT DISTINCT t2.deal_dt, t2.bond_id, b.bond_ctgry_id, t2.org_id, ins_show_name, b.bond_cd,
               b.bond_nm
        FROM t2 JOIN v_bond b ON t2.bond_id = b.bond_id""",
    "m09_bond_deal_smart": """
        SELECT t1.deal_dt, t1.bond_id, b.bond_cd, b.bond_nm, b.bond_ctgry_nm2,
               sum(CASE WHEN strategy = '正常' THEN 1 ELSE 0 END)::BIGINT AS trade_normal,
               sum(CASE WHEN strategy = '正常' THEN 0 ELSE 1 END)::BIGINT AS trade_smart
        FROM t1 JOIN v_bond b ON t1.bond_id = b.bond_id
        GROUP BY t1.deal_dt, t1.bond_id, b.bond_cd, b.bond_nm, b.bond_ctgry_nm2""",
}

# ---------------------------------------------------------------- operators

_ORG_FIELDS = """
    SELECT CASE s_suppkey % 7 WHEN 0 THEN s_name || ', Ltd' WHEN 3 THEN s_name || ' BORG'
                WHEN 4 THEN 'a""' || s_name WHEN 5 THEN '' ELSE s_name END AS chn_full_nm,
           CAST(s_suppkey AS VARCHAR) AS unq_id_in_src_sys
    FROM supplier WHERE s_suppkey % 7 NOT IN (2, 3)"""
_WORDS = """
    SELECT unnest(string_split(rtrim(line, ' '), ' ')) AS word
    FROM (SELECT unnest(regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\r|\\n)$', ''),
                                              '\\r\\n|\\r|\\n')) AS line
          FROM documents WHERE length(text) > 0) lines
    WHERE length(line) = 0 OR length(rtrim(line, ' ')) > 0"""
_MARKET = """
    SELECT CAST(coalesce(sum(CASE WHEN {w} THEN amount END), 0) AS DOUBLE) AS trade_amount,
           count(CASE WHEN {w} THEN 1 END) AS deal_count,
           count(DISTINCT CASE WHEN {w} THEN deal_dt END) AS deal_days,
           count(DISTINCT CASE WHEN {w} THEN org_nm END) AS dealer_count,
           count(DISTINCT CASE WHEN {w} THEN bond_id END) AS bond_count,
           count(DISTINCT deal_dt) AS work_days
    FROM v_trade WHERE deal_dt BETWEEN DATE '{b}' AND DATE '{e}'"""
_DAYS = """
    SELECT row_number() OVER (ORDER BY deal_dt DESC)::INT AS day_rank, deal_dt
    FROM (SELECT DISTINCT deal_dt FROM v_trade WHERE deal_dt < DATE '{b}') d
    QUALIFY row_number() OVER (ORDER BY deal_dt DESC) <=
            (SELECT count(DISTINCT deal_dt) FROM v_trade WHERE deal_dt BETWEEN DATE '{b}' AND DATE '{e}')"""
_CLEAN = ("(SELECT * FROM v_deal WHERE st <> 'R' "
          "AND bond_deal_id NOT IN (SELECT deal_id FROM v_removed)) d")
_CONFIRMED = ("(SELECT * FROM v_repo WHERE st <> 'P' "
              "AND ev_id IN (SELECT deal_nmbr FROM v_strategy)) d")
_FILTER = "player_type = 'F' AND bond_type = '1-URGENT'"


def _miss(name: str, fact: str, column: str, known: str) -> str:
    return (f"SELECT '{name}' AS counter, count(*) AS misses FROM {fact} "
            f"WHERE {column} NOT IN ({known})")


def _empty(name: str, fact: str, column: str) -> str:
    return f"SELECT '{name}' AS counter, count(*) AS misses FROM {fact} WHERE {column} IS NULL"


_OPERATORS = {
    "scan_feed_clean": _ORG_FIELDS,
    "scan_feed_required": f"SELECT * FROM ({_ORG_FIELDS}) f WHERE chn_full_nm <> ''",
    "scan_feed_first_line": _ORG_FIELDS.replace("NOT IN (2, 3)", "<> 2"),
    "scan_feed_rejects": """
        SELECT CASE s_suppkey % 7 WHEN 2 THEN 'field count' WHEN 3 THEN 'header tag' ELSE 'kept' END AS reason,
               count(*) AS n_lines FROM supplier GROUP BY 1""",
    "split_records": """
        SELECT strftime(o_orderdate, '%Y/%m/%d') AS deal_dt, CAST(o_custkey AS VARCHAR) AS org_nm,
               o_orderstatus AS player_type, o_orderpriority AS bond_type,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount,
               CAST(o_orderkey AS VARCHAR) AS deal_nmbr, '' AS field_6,
               substr(o_orderpriority, 1, 1) AS bond_id
        FROM orders""",
    "filter_product_in": """
        SELECT ev_id, pd_cd, CAST(trade_amnt AS DOUBLE) AS trade_amnt FROM v_repo
        WHERE pd_cd = 'R001' OR pd_cd = 'R007' OR pd_cd = 'R014'""",
    "filter_contains": "SELECT c_custkey AS unq_id, c_name AS full_nm FROM customer WHERE c_name LIKE '%7%'",
    "filter_status": "SELECT ev_id, st FROM v_repo WHERE st <> 'P'",
    "filter_date_range": """
        SELECT deal_nmbr, deal_dt FROM v_trade
        WHERE deal_dt >= DATE '1997-01-01' AND deal_dt <= DATE '1997-12-31'""",
    "filter_optional": f"""
        SELECT deal_dt, org_nm, player_type, bond_type, CAST(amount AS DOUBLE) AS amount, deal_nmbr,
               bond_id
        FROM v_trade WHERE deal_dt BETWEEN DATE '1996-03-01' AND DATE '1998-08-31' AND {_FILTER}""",
    "filter_one_org": """
        SELECT deal_nmbr, org_nm, CAST(amount AS DOUBLE) AS amount FROM v_trade
        WHERE org_nm = '7' AND deal_dt BETWEEN DATE '1995-01-01' AND DATE '2000-12-31'""",
    "case_strategy": """
        SELECT o_orderkey AS deal_nmbr, CASE WHEN substr(o_orderpriority, 1, 1) IN ('0', '4') THEN '正常'
               ELSE '策略性交易' END AS strategy
        FROM orders""",
    "case_bond_category": "SELECT bond_id, bond_ctgry_nm2 FROM v_bond",
    "case_bond_class": """
        SELECT bond_id, CASE WHEN bond_ctgry_nm IN ('国债', '政策性金融债') THEN '利率债'
                             WHEN bond_ctgry_nm = '同业存单' THEN '同业存单' ELSE '信用债' END AS bond_class
        FROM v_bond""",
    "case_rating": """
        SELECT o_orderkey AS ri_id, CASE o_orderkey % 5 WHEN 0 THEN 'AAA' WHEN 4 THEN 'AA及以下'
                                         ELSE 'AA+' END AS rtng_desc
        FROM orders""",
    "bucket_tenor": """
        SELECT CAST(l_linenumber * 2 AS DOUBLE) AS yr_of_time_to_mrty,
               CASE l_linenumber WHEN 1 THEN '一年至三年(包括三年)' WHEN 2 THEN '三年至五年(包括五年)'
                    WHEN 3 THEN '五年至七年(包括七年)' WHEN 4 THEN '七年至十年(包括十年)'
                    WHEN 5 THEN '七年至十年(包括十年)' ELSE '十年以上' END AS tenor,
               count(*) AS n
        FROM lineitem GROUP BY ALL""",
    "lookup_default": """
        SELECT bond_id, coalesce(chn_full_nm, 'None') AS cstdn, bond_ctgry_nm2
        FROM v_bond LEFT JOIN v_org ON cstdtn_bank_id = unq_id""",
    "lookup_inner": """
        SELECT bond_deal_id, buyer_id, bond_id, ins_show_name, CAST(dirty_amnt AS DOUBLE) AS dirty_amnt
        FROM v_deal JOIN v_inst ON buyer_id = ip_id""",
    "snowflake_lookup": """
        SELECT coalesce(o.chn_full_nm, 'None') AS cstdn, coalesce(i.ins_show_name, 'None') AS buyer_type,
               coalesce(j.ins_show_name, 'None') AS seller_type, count(*) AS n_deals,
               CAST(sum(t1.dirty_amnt) AS DOUBLE) AS dirty_amnt
        FROM t1 JOIN v_bond b ON t1.bond_id = b.bond_id
        LEFT JOIN v_org o ON b.cstdtn_bank_id = o.unq_id
        LEFT JOIN v_inst i ON t1.buyer_id = i.ip_id LEFT JOIN v_inst j ON t1.seller_id = j.ip_id
        GROUP BY ALL""",
    "semi_confirmed": """
        SELECT ev_id, CAST(trade_amnt AS DOUBLE) AS trade_amnt FROM v_repo
        WHERE deal_nmbr IN (SELECT deal_nmbr FROM v_bank)""",
    "semi_prefixed": """
        SELECT '11002' || CAST(r.ev_id AS VARCHAR) AS ev_id, CAST(r.trade_amnt AS DOUBLE) AS trade_amnt
        FROM v_repo r JOIN v_bank b ON r.ev_id = b.deal_nmbr""",
    "dictionary_one_per_key": """
        SELECT l_orderkey, l_returnflag, l_linestatus, l_suppkey FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_returnflag DESC, l_linestatus DESC, l_suppkey DESC) = 1""",
    "parse_dates": """
        SELECT o_orderkey, CASE WHEN year(o_orderdate) <> 1996 THEN CAST(o_orderdate AS DATE) END AS deal_dt
        FROM orders""",
    "zero_weight_guard": """
        SELECT pd_cd, CASE WHEN pd_cd <> 'R001' THEN {q(sum(deal_repo_rate * trade_amnt),sum(trade_amnt))}
                      END AS weighted_rate
        FROM v_repo GROUP BY pd_cd""",
    "anti_removed": """
        SELECT bond_deal_id, bond_id, CAST(dirty_amnt AS DOUBLE) AS dirty_amnt FROM v_deal
        WHERE bond_deal_id NOT IN (SELECT deal_id FROM v_removed)""",
    "valid_both_parties": """
        SELECT d.ev_id, d.deal_dt, p.unq AS repo_unq_id, q.unq AS rvrse_unq_id,
               p.root AS repo_root_id, q.root AS rvrse_root_id,
               CASE WHEN p.unq = p.root THEN 'own' WHEN p.full_nm LIKE '%7%' THEN 'fund'
                    ELSE 'product' END AS repo_kind,
               CASE WHEN q.unq = q.root THEN 'own' WHEN q.full_nm LIKE '%7%' THEN 'fund'
                    ELSE 'product' END AS rvrse_kind
        FROM v_repo d
        JOIN parties p ON d.repo_uniq = p.uniq AND d.deal_dt BETWEEN p.efctv_from_dt AND p.efctv_to_dt
        JOIN parties q ON d.rvrse_uniq = q.uniq AND d.deal_dt BETWEEN q.efctv_from_dt AND q.efctv_to_dt""",
    "valid_at_exclusive": """
        SELECT DISTINCT buyer_id AS ip_id, bond_id, deal_dt, coalesce(ins_show_name, 'None') AS ins_show_name
        FROM v_deal LEFT JOIN v_inst
          ON buyer_id = ip_id AND deal_dt > efctv_from_dt AND deal_dt < efctv_to_dt""",
    "root_rollup": """
        SELECT coalesce(CAST(r.c_custkey AS VARCHAR), 'None') AS root_id, count(*) AS n_members
        FROM customer m LEFT JOIN customer r ON m.c_custkey - m.c_custkey % 10 = r.c_custkey GROUP BY 1""",
    "tag_expand_totals": "SELECT root_id, join_type, CAST(sum(trade_amnt) AS DOUBLE) AS amount, "
                         "count(*) AS n_deals FROM (" + " UNION ALL ".join(
        f"SELECT root AS root_id, '{group}' AS join_type, trade_amnt FROM v_repo "
        f"JOIN parties ON repo_uniq = uniq WHERE {test}" for group, test in {
            "总额": "TRUE", "自营": "unq = root", "产品": "unq <> root",
            "货币市场基金": "unq <> root AND full_nm LIKE '%7%'"}.items()) + ") x GROUP BY ALL",
    "deal_collateral_fanout": """
        SELECT d.ev_id, c.ri_id AS bond_id, coalesce(k.bond_class, 'None') AS bond_class,
               coalesce(k.issr_nm, 'None') AS issr_nm, CAST(c.cnvrsn_prprtn AS DOUBLE) AS cnvrsn_prprtn,
               CAST(d.trade_amnt AS DOUBLE) AS trade_amnt
        FROM v_repo d JOIN v_cltrl c ON d.ev_id = c.ev_id LEFT JOIN v_cbond k ON c.ri_id = k.bond_id
        WHERE d.st <> 'P' AND d.ev_id IN (SELECT deal_nmbr FROM v_strategy)""",
    "side_spread": """
        SELECT a.g AS party_group, a.pd_cd, {r(b.p / CAST(b.s AS DOUBLE) - a.p / CAST(a.s AS DOUBLE))} AS price_difference,
               CAST(a.s + b.s AS DOUBLE) AS total_amount
        FROM (SELECT repo_uniq % 10 AS g, pd_cd,
                     CAST(sum(deal_repo_rate * trade_amnt) AS DOUBLE) AS p, sum(trade_amnt) AS s
              FROM v_repo WHERE pd_cd IN ('R001', 'R007', 'R014') GROUP BY ALL) a
        JOIN (SELECT rvrse_uniq % 10 AS g, pd_cd,
                     CAST(sum(deal_repo_rate * trade_amnt) AS DOUBLE) AS p, sum(trade_amnt) AS s
              FROM v_repo WHERE pd_cd IN ('R001', 'R007', 'R014') GROUP BY ALL) b
          ON a.g = b.g AND a.pd_cd = b.pd_cd""",
    "buy_sell_full_outer": "SELECT deal_dt, bond_id, org_id, " + _dbl(
        "buy_act_all", "buy_paper_all", "sell_act_all", "sell_paper_all") + " FROM t2",
    "share_of_total": f"""
        SELECT ev_id, ri_id, CAST(total_face_value AS DOUBLE) AS total_face_value,
               {_q('total_face_value', 'sum(total_face_value) OVER (PARTITION BY ri_id)')} AS share
        FROM v_cltrl""",
    "collateral_rate": "SELECT ri_id, deal_dt, zy_rate FROM t3",
    "small_ratio": """
        SELECT s_suppkey, CAST((50 + s_suppkey % 7) / CAST(1000000000 AS DOUBLE) AS DECIMAL(20,10))::DOUBLE AS turnover
        FROM supplier""",
    "wavg_rate": f"""
        SELECT pd_cd, deal_dt, {_q('sum(deal_repo_rate * trade_amnt)', 'sum(trade_amnt)')} AS weighted_rate,
               CAST(sum(trade_amnt) AS DOUBLE) AS amount
        FROM v_repo GROUP BY pd_cd, deal_dt""",
    "wavg_conditional": f"""
        SELECT bond_id,
               {_q("sum(CASE WHEN strategy = '正常' THEN ytm_rate * trade_amnt END)",
                   "sum(CASE WHEN strategy = '正常' THEN trade_amnt END)")} AS normal_rate,
               {_q("sum(CASE WHEN strategy <> '正常' THEN ytm_rate * trade_amnt END)",
                   "sum(CASE WHEN strategy <> '正常' THEN trade_amnt END)")} AS other_rate
        FROM t1 GROUP BY bond_id""",
    "minmax_rate": """
        SELECT pd_cd, deal_dt, CAST(max(deal_repo_rate) AS DOUBLE) AS max_rate,
               CAST(min(deal_repo_rate) AS DOUBLE) AS min_rate
        FROM v_repo GROUP BY pd_cd, deal_dt""",
    "distinct_deals": """
        SELECT bond_id, deal_dt, count(DISTINCT bond_deal_id) AS deal_cnt, count(*) AS n_rows
        FROM v_deal GROUP BY bond_id, deal_dt""",
    "trade_kind_counts": """
        SELECT strategy, count(*) FILTER (strategy = '正常') AS trade_normal,
               count(*) FILTER (strategy <> '正常') AS trade_smart
        FROM t1 GROUP BY strategy""",
    "any_attr": """
        SELECT bond_id, buyer_id AS first_buyer FROM v_deal
        QUALIFY row_number() OVER (PARTITION BY bond_id ORDER BY bond_deal_id) = 1""",
    "counterparty_set": """
        SELECT repo_uniq AS repo_pty_id,
               string_agg(DISTINCT CAST(rvrse_uniq AS VARCHAR), ',' ORDER BY CAST(rvrse_uniq AS VARCHAR))
               AS parties
        FROM v_repo GROUP BY repo_uniq""",
    "global_summary": _MARKET.format(w="TRUE", b="1997-01-01", e="1997-12-31"),
    "last_n_trading_days": _DAYS.format(b="1998-01-01", e="1998-03-31"),
    "limit_sorted": """
        SELECT deal_dt, org_nm, player_type, bond_type, CAST(amount AS DOUBLE) AS amount, deal_nmbr,
               bond_id
        FROM v_trade WHERE deal_dt BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
        ORDER BY deal_dt, deal_nmbr LIMIT 14""",
    "distinct_dates": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS deal_dt FROM orders",
    "word_count": f"SELECT word, count(*) AS n FROM ({_WORDS}) w GROUP BY word",
    "event_expand": """
        SELECT CAST(user_id AS VARCHAR) || ' login ' || CAST(event_id AS VARCHAR) AS value
        FROM events, range(2) WHERE event_type = 'signup'
        UNION ALL
        SELECT concat_ws(',', CAST(user_id AS VARCHAR), event_type, CAST(event_id AS VARCHAR))
        FROM events WHERE event_type <> 'signup'""",
    "load_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS feed, count(*) AS n_rows FROM {view}" for name, view in {
            "bond_deal": "v_deal", "bond_d": "v_bond", "org": "v_org",
            "dps_v_cbt_all_txn_dtl": "v_strategy", "trdx_deal_infrmn_rmv_d": "v_removed",
            "member_d": "v_inst", "ev_cltrl_dtls": "v_cltrl", "bond_repo_deal": "v_repo",
            "repo_member_d": "v_member", "ri_credit_rtng": "v_rating",
            "dps_v_cr_dep_txn_dtl": "v_bank", "repo_bond_d": "v_cbond"}.items()),
    "lookup_miss_counts": " UNION ALL ".join([
        _miss("bond_custodian", "v_bond", "cstdtn_bank_id", "SELECT unq_id FROM v_org"),
        _miss("institution_type", "v_inst", "ip_id", "SELECT ip_id FROM v_inst"),
        _empty("deal_date", "v_deal", "deal_dt"),
        _empty("deal_amount", "v_deal", "trade_amnt"),
        _empty("repo_deal_date", "v_repo", "deal_dt"),
        _empty("repo_deal_amount", "v_repo", "trade_amnt"),
        _miss("deal_strategy", _CLEAN, "deal_nmbr", "SELECT deal_nmbr FROM v_strategy"),
        _miss("deal_buyer", _CLEAN, "buyer_id", "SELECT ip_id FROM v_inst"),
        _miss("deal_seller", _CLEAN, "seller_id", "SELECT ip_id FROM v_inst"),
        f"SELECT 'collateral_rate' AS counter, count(*) AS misses FROM {_CLEAN} LEFT JOIN t3 "
        "ON d.bond_id = t3.ri_id AND d.deal_dt = t3.deal_dt WHERE t3.ri_id IS NULL",
        _miss("member_type", "v_member", "uniq", "SELECT uniq FROM v_member"),
        _miss("member_root", "v_member", "root_uniq", "SELECT uniq FROM v_member"),
        _miss("deal_repo_party", _CONFIRMED, "repo_uniq", "SELECT uniq FROM v_member"),
        _miss("deal_rvrse_party", _CONFIRMED, "rvrse_uniq", "SELECT uniq FROM v_member"),
        f"SELECT 'deal_product' AS counter, count(*) AS misses FROM {_CONFIRMED} WHERE pd_cd = 'None'",
        _miss("deal_rating", _CONFIRMED, "ev_id", "SELECT ri_id FROM v_rating"),
        _miss("collateral_bond", "v_cltrl", "ri_id", "SELECT bond_id FROM v_cbond"),
    ]),
    "upsert_merge": """
        SELECT deal_dt, bond_id, CAST(coalesce(n.s, o.s) AS DOUBLE) AS trd_amnt
        FROM (SELECT deal_dt, bond_id, sum(dirty_amnt) AS s FROM v_deal WHERE st <> 'R' GROUP BY ALL) o
        FULL JOIN (SELECT deal_dt, bond_id, sum(dirty_amnt) AS s FROM v_deal
                   WHERE deal_dt >= DATE '2000-01-01' GROUP BY ALL) n USING (deal_dt, bond_id)""",
    "upsert_deltas": """
        SELECT deal_dt, CAST(bond_id AS VARCHAR) AS bond_id, CAST(coalesce(r.s, n.s, o.s) AS DOUBLE) AS trd_amnt
        FROM (SELECT deal_dt, bond_id, sum(dirty_amnt) AS s FROM v_deal WHERE st <> 'R' GROUP BY ALL) o
        FULL JOIN (SELECT deal_dt, bond_id, sum(dirty_amnt) AS s FROM v_deal
                   WHERE deal_dt >= DATE '2000-01-01' GROUP BY ALL) n USING (deal_dt, bond_id)
        FULL JOIN (SELECT deal_dt, bond_id, sum(dirty_amnt) AS s FROM v_deal
                   WHERE deal_dt >= DATE '2000-01-01' AND st = 'R' GROUP BY ALL) r USING (deal_dt, bond_id)""",
    "rebuild_versions": """
        SELECT 1 AS version, deal_dt, CAST(bond_id AS VARCHAR) AS bond_id, CAST(sum(dirty_amnt) AS DOUBLE) AS trd_amnt
        FROM v_deal GROUP BY ALL
        UNION ALL
        SELECT 2, deal_dt, CAST(bond_id AS VARCHAR), CAST(sum(dirty_amnt) AS DOUBLE)
        FROM v_deal WHERE st = 'R' GROUP BY ALL""",
    "text_sink": f"""
        SELECT '(' || word || ',' || CAST(count(*) AS VARCHAR) || ')' AS value
        FROM ({_WORDS}) w GROUP BY word""",
    "feed_intake": f"""
        SELECT chn_full_nm, unq_id_in_src_sys, CAST(NULL AS VARCHAR) AS reason FROM ({_ORG_FIELDS}) f
        UNION ALL
        SELECT NULL, NULL, CASE s_suppkey % 7 WHEN 2 THEN 'field count' ELSE 'header tag' END
        FROM supplier WHERE s_suppkey % 7 IN (2, 3)""",
    "dictionary_last_line": """
        SELECT user_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value
        FROM events GROUP BY user_id""",
    "grouping_sets": """
        SELECT CASE WHEN grouping(repo_uniq) = 0 THEN 'party' WHEN grouping(st) = 0 THEN 'status' ELSE 'product'
               END AS report, pd_cd, deal_dt, repo_uniq AS repo_pty_id, st, CAST(sum(trade_amnt) AS DOUBLE) AS trade_amnt
        FROM v_repo GROUP BY GROUPING SETS ((pd_cd, deal_dt), (repo_uniq), (st, pd_cd))""",
    "market_of_days": _MARKET.format(w=_FILTER, b="1996-03-01", e="1998-08-31"),
    "merge_partial_columns": f"""
        SELECT m.pd_cd, m.deal_dt, m.market_price, m.market_max, b.banks_price
        FROM (SELECT pd_cd, deal_dt, {_q('sum(deal_repo_rate * trade_amnt)', 'sum(trade_amnt)')}
                     AS market_price, CAST(max(deal_repo_rate) AS DOUBLE) AS market_max
              FROM v_repo WHERE pd_cd IN ('R001', 'R007', 'R014') GROUP BY ALL) m
        LEFT JOIN (SELECT pd_cd, deal_dt,
                          {_q('sum(deal_repo_rate * trade_amnt)', 'sum(trade_amnt)')} AS banks_price
                   FROM v_repo WHERE pd_cd IN ('R001', 'R007', 'R014')
                     AND deal_nmbr IN (SELECT deal_nmbr FROM v_bank) GROUP BY ALL) b
          ON m.pd_cd = b.pd_cd AND m.deal_dt = b.deal_dt""",
    "append_row_families": """
        SELECT bond_id, CASE WHEN grouping(tenor) = 1 THEN '全部' ELSE tenor END AS bond_prd,
               CAST(sum(dirty_amnt) AS DOUBLE) AS amount
        FROM (SELECT *, CASE WHEN yr_of_time_to_mrty <= 3 THEN '一年至三年(包括三年)'
                             WHEN yr_of_time_to_mrty <= 5 THEN '三年至五年(包括五年)'
                             WHEN yr_of_time_to_mrty <= 7 THEN '五年至七年(包括七年)'
                             WHEN yr_of_time_to_mrty <= 10 THEN '七年至十年(包括十年)'
                             ELSE '十年以上' END AS tenor FROM v_deal) d
        GROUP BY GROUPING SETS ((bond_id, tenor), (bond_id))""",
    "base_t1": f"""
        SELECT t1.bond_deal_id, t1.bond_id, t1.deal_dt, b.bond_cd, b.bond_ctgry_nm2,
               coalesce(o.chn_full_nm, 'None') AS cstdn, t1.strategy, t1.tenor,
               coalesce(i.ins_show_name, 'None') AS buyer_type,
               coalesce(j.ins_show_name, 'None') AS seller_type,
               {_dbl('t1.dirty_amnt', 't1.trade_amnt', 't1.ytm_rate')}
        FROM t1 JOIN v_bond b ON t1.bond_id = b.bond_id
        LEFT JOIN v_org o ON b.cstdtn_bank_id = o.unq_id
        LEFT JOIN v_inst i ON t1.buyer_id = i.ip_id LEFT JOIN v_inst j ON t1.seller_id = j.ip_id""",
    "base_t2": "SELECT deal_dt, bond_id, org_id, " + _dbl(
        "buy_act_all", "buy_paper_all", "sell_act_all", "sell_paper_all")
        + ", buy_ytm_rate_bf, buy_ytm_rate_af, sell_ytm_rate_bf, sell_ytm_rate_af FROM t2",
    "base_t3": "SELECT ri_id, deal_dt, zy_rate FROM t3",
    "base_r2": f"""
        SELECT ev_id, pd_cd, deal_dt, repo_unq AS repo_unq_id, rvrse_unq AS rvrse_unq_id,
               {_dbl('deal_repo_rate', 'trade_amnt')} FROM r2""",
    "base_r3": f"""
        SELECT ev_id, pd_cd, deal_dt, repo_unq AS repo_unq_id, rvrse_unq AS rvrse_unq_id, rtng_desc,
               bond_id, bond_class, issr_nm, {_dbl('cnvrsn_prprtn', 'trade_amnt')} FROM r3""",
    "base_r1": f"""
        SELECT ev_id, pd_cd, deal_dt, repo_unq AS repo_unq_id, rvrse_unq AS rvrse_unq_id, rtng_desc,
               is_bank_deal, coalesce(n, 0) AS n_lines, {_dbl('deal_repo_rate', 'trade_amnt')}
        FROM r1 LEFT JOIN (SELECT ev_id AS k, count(*) AS n FROM v_cltrl GROUP BY ev_id) c ON ev_id = k""",
    "m24_market_report": _MARKET.format(w=_FILTER, b="1996-03-01", e="1998-08-31"),
    "m25_comparison_days": _DAYS.format(b="1997-01-01", e="1997-12-31"),
    "m26_word_count_text": f"""
        SELECT '(' || word || ',' || CAST(count(*) AS VARCHAR) || ')' AS value
        FROM ({_WORDS}) w GROUP BY word""",
    "m27_event_counts": """
        SELECT count(*) AS n_before,
               CAST(count(*) + count(*) FILTER (event_type = 'signup') AS BIGINT) AS n_after
        FROM events""",
}


_OPERATORS["observed_misses"] = _OPERATORS["lookup_miss_counts"]


def registered() -> dict[str, str]:
    statements = {**_OPERATORS, **_BOND_REPORTS, **_repo_reports()}
    return {name: _with_views(sql) for name, sql in statements.items()}
