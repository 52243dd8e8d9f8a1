"""Input frames of the two jobs, with the columns the plans use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class BondInputs:
    """Bond job.

    deals       bond_deal_id, buyer_id, seller_id, deal_nmbr, deal_dt, st, bond_id,
                instmt_crncy, trade_amnt, dirty_amnt, face_amnt, yr_of_time_to_mrty,
                ytm_rate, trdng_mthd_id
    bonds       bond_id, bond_nm, bond_cd, bond_ctgry_id, bond_ctgry_nm, frst_value_dt,
                mrty_dt, lstng_dt, scnd_blngl_desc, cstdtn_bank_id, ttl_face_value
    orgs        unq_id, chn_full_nm
    strategies  deal_nmbr, deal_strategy
    removed     deal_id
    members     ip_id, ins_show_name, efctv_from_dt, efctv_to_dt
    methods     trdng_mthd_id, trdng_mthd_blngl_nm
    repo_deals  ev_id, deal_dt, trade_amnt
    collateral  ri_id, ev_id, cnvrsn_prprtn, total_face_value
    rates       T3 where a job has it staged: ri_id, deal_dt, zy_rate
    withdrawn   status of a withdrawn deal
    """

    deals: DataFrame
    bonds: DataFrame
    orgs: DataFrame
    strategies: DataFrame
    removed: DataFrame
    members: DataFrame
    methods: DataFrame
    repo_deals: DataFrame
    collateral: DataFrame
    rates: DataFrame | None = None
    withdrawn: str = "2"


@dataclass(frozen=True)
class RepoInputs:
    """Pledged-repo job.

    deals       ev_id, repo_pty_id, rvrse_repo_pty_id, pd_cd, deal_nmbr, trdng_ri_id, st,
                deal_dt, deal_repo_rate, trade_amnt
    members     ip_id, unq_id, member_cd, rt_member_cd, full_nm, ins_show_name,
                efctv_from_dt, efctv_to_dt
    confirmed   ev_id
    ratings     trdng_ri_id, rtng_desc
    banks       deal_nmbr of bank-to-bank deals
    bonds       bond_id, bond_class, issr_nm
    collateral  ev_id, bond_id, cnvrsn_prprtn
    profiles    members with root and kind, where a job has them staged
    withdrawn   status of a withdrawn deal
    fund_marker text in the full name of a money market fund
    """

    deals: DataFrame
    members: DataFrame
    confirmed: DataFrame
    ratings: DataFrame
    banks: DataFrame
    bonds: DataFrame
    collateral: DataFrame
    profiles: DataFrame | None = None
    withdrawn: str = "2"
    fund_marker: str = "货币市场基金"
