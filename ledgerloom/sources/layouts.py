"""Layouts of the positional feeds: column order is the contract.

Every field arrives as text. A line is dropped if it is the header (the first line of a
file, or by option any line that holds the header tag), if its field count differs from the
layout, or if a required field is empty.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class FeedLayout:
    name: str
    header_tag: str
    columns: tuple[str, ...]
    required: tuple[str, ...] = ()
    exact_arity: bool = True


def _all_required(name, header_tag, columns, optional=()):
    required = tuple(c for c in columns if c not in optional)
    return FeedLayout(name, header_tag, columns, required)


# Header tags, column names and their order are those of the feeds.
_MEMBER_COLUMNS = (
    "ip_id", "member_ctgry_id", "member_cd", "full_nm", "rt_member_cd",
    "rt_member_full_nm", "efctv_from_dt", "efctv_to_dt", "unq_id_in_src_sys",
)
_REMOVAL_COLUMNS = ("dir_oprtn_type_indc", "dir_rmv_status_indc", "mkt_id", "deal_id")

# Bond job. Fields the job does not read are named by position.
BOND_COLLATERAL = FeedLayout(
    "ev_cltrl_dtls", "EV",
    ("ri_id", "ev_id", "cnvrsn_prprtn", "total_face_value", "field_4", "field_5"),
)
BOND_REPO_DEAL = FeedLayout(
    "bond_repo_deal", "REPO",
    ("ev_id", "field_1", "field_2", "field_3", "field_4", "deal_dt", "field_6", "trade_amnt",
     "field_8"),
)
BOND_REMOVAL = FeedLayout("trdx_deal_infrmn_rmv_d", "TRDX", _REMOVAL_COLUMNS)
BOND_ORG = FeedLayout("org", "ORG", ("chn_full_nm", "unq_id_in_src_sys"))
BOND_DETAIL = FeedLayout(
    "bond_d", "BOND",
    ("bond_id", "bond_ctgry_nm", "issr_id", "issr_nm", "bond_nm", "bond_cd", "bond_ctgry_id",
     "frst_value_dt", "mrty_dt", "scnd_blngl_desc", "cstdtn_bank_id", "ttl_face_value",
     "lstng_dt", "bond_prnt_tp_nm"),
)
BOND_STRATEGY = FeedLayout(
    "dps_v_cbt_all_txn_dtl", "DPS", ("dbd_deal_deal_idnty", "deal_strategy"),
    required=("dbd_deal_deal_idnty",), exact_arity=False,
)
BOND_MEMBER_TYPE = FeedLayout("after_hours_bond_type", "AFTER", ("ins_show_name", "member_ctgry_id"))
BOND_MEMBER = FeedLayout("member_d", "MEMBER", _MEMBER_COLUMNS)
BOND_METHOD = FeedLayout("trdng_mthd_d", "trdng", ("trdng_mthd_id", "trdng_mthd_blngl_nm"))
BOND_DEAL = FeedLayout(
    "bond_deal", "BOND",
    ("bond_deal_id", "buyer_id", "seller_id", "deal_nmbr", "deal_dt", "st", "trdng_ri_id",
     "instmt_crncy", "trade_amnt", "dirty_amnt", "ttl_face_value", "yr_of_time_to_mrty",
     "dirty_price", "ytm_rate", "trdng_mthd_id"),
)
BOND_JOB_FEEDS = (
    BOND_COLLATERAL, BOND_REPO_DEAL, BOND_REMOVAL, BOND_ORG, BOND_DETAIL, BOND_STRATEGY,
    BOND_MEMBER_TYPE, BOND_MEMBER, BOND_METHOD, BOND_DEAL,
)

# Repo job: an empty field rejects the row, but a root member has no parent fields.
REPO_PRODUCT = _all_required("pd_d", "PD", ("pd_id", "pd_cd"))
REPO_CLOSE_TYPE = _all_required(
    "market_close_type_i", "MARKET", ("market_nm", "ctgry_nm", "ins_show_name"))
REPO_MEMBER_CATEGORY = _all_required("member_ctgry_d", "MEMBER", ("member_ctgry_id", "ctgry_nm"))
REPO_MEMBER = _all_required(
    "member_d", "MEMBER", _MEMBER_COLUMNS, optional=("rt_member_cd", "rt_member_full_nm"))
REPO_DEAL = _all_required(
    "bond_repo_deal", "EV",
    ("ev_id", "repo_pty_id", "rvrse_repo_pty_id", "trdng_pd_id", "deal_nmbr", "trdng_ri_id", "st",
     "deal_dt", "deal_repo_rate", "trade_amnt"),
)
REPO_CONFIRMED = _all_required("trdx_deal_infrmn_rmv_d", "TRDX", _REMOVAL_COLUMNS)
REPO_BOND = _all_required("bond_d", "BOND", ("bond_id", "bond_ctgry_nm", "issr_id", "issr_nm"))
REPO_RATING = _all_required("ri_credit_rtng", "RI", ("ri_id", "rtng_desc"))
REPO_BANK_FLAG = _all_required(
    "dps_v_cr_dep_txn_dtl", "DL", ("deal_number", "dpst_instn_trdng_indctr"))
REPO_COLLATERAL = _all_required("ev_cltrl_dtls", "EV", ("ri_id", "ev_id", "cnvrsn_prprtn"))
REPO_JOB_FEEDS = (
    REPO_PRODUCT, REPO_CLOSE_TYPE, REPO_MEMBER_CATEGORY, REPO_MEMBER, REPO_DEAL, REPO_CONFIRMED,
    REPO_BOND, REPO_RATING, REPO_BANK_FLAG, REPO_COLLATERAL,
)

# Trade file of the market report: plain commas, no header, no quotes.
TRADE_COLUMNS = (
    "deal_dt", "org_nm", "player_type", "bond_type", "amount", "deal_nmbr", "field_6", "bond_id",
)
