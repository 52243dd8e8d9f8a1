"""From feeds to the inputs of the two jobs.

``raw`` maps layout names to the rows of staged feeds, with their position: of several lines with
a key a dictionary holds the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import labels
from ledgerloom.functions.text import blank_to_null, parse_date, parse_decimal
from ledgerloom.operators.lookups import last_per_key, lookup
from ledgerloom.plans.inputs import BondInputs, RepoInputs
from ledgerloom.sources.intake import POSITION

# Digits of amounts and of rates: wide enough that feeds lose none, narrow enough that sums of
# amount times rate stay exact in 38 digits.
MONEY, RATE = (24, 6), (14, 8)

# Date patterns, codes and the identifier prefix of the feeds. One-letter
# month and day accept one or two digits.
DASHED, SLASHED = "yyyy-M-d", "yyyy/M/d"
REMOVE, ACTIVE, REPO_MARKET = "2", "1", "109"
DEAL_ID_PREFIX = "11002"
BANK_FLAG = "1"


def dictionary(feed: DataFrame, key: str, *columns: Column | str) -> DataFrame:
    """Key and columns of a feed; the last line of a key holds."""
    return last_per_key(feed.select(*columns, POSITION), key, position=POSITION)


def bond_inputs(raw: dict[str, DataFrame]) -> BondInputs:
    types = dictionary(raw["after_hours_bond_type"], "member_ctgry_id", "member_ctgry_id", "ins_show_name")
    members = lookup(raw["member_d"], types, "member_ctgry_id", {"ins_show_name": labels.MISSING})
    return BondInputs(
        deals=raw["bond_deal"].select(
            "bond_deal_id", _id("buyer_id"), _id("seller_id"), "deal_nmbr",
            _date("deal_dt", SLASHED), "st", F.col("trdng_ri_id").alias("bond_id"),
            "instmt_crncy", _money("trade_amnt"), _money("dirty_amnt"),
            _money("ttl_face_value").alias("face_amnt"), _rate("yr_of_time_to_mrty"),
            _rate("ytm_rate"), "trdng_mthd_id",
        ),
        bonds=dictionary(
            raw["bond_d"], "bond_id", "bond_id", "bond_nm", "bond_cd", "bond_ctgry_id", "bond_ctgry_nm",
            _date("frst_value_dt", DASHED), _date("mrty_dt", DASHED), _date("lstng_dt", DASHED),
            "scnd_blngl_desc", "cstdtn_bank_id", _money("ttl_face_value")),
        orgs=dictionary(raw["org"], "unq_id", F.col("unq_id_in_src_sys").alias("unq_id"), "chn_full_nm"),
        strategies=dictionary(raw["dps_v_cbt_all_txn_dtl"], "deal_nmbr",
                              F.col("dbd_deal_deal_idnty").alias("deal_nmbr"), "deal_strategy"),
        removed=raw["trdx_deal_infrmn_rmv_d"].where(
            ~((F.col("dir_oprtn_type_indc") == REMOVE) & (F.col("dir_rmv_status_indc") == ACTIVE))
        ).select("deal_id"),
        members=members.select("ip_id", "ins_show_name", *_validity(DASHED)),
        methods=raw["trdng_mthd_d"].drop(POSITION),
        repo_deals=dictionary(raw["bond_repo_deal"], "ev_id", "ev_id", _date("deal_dt", DASHED), _money("trade_amnt")),
        collateral=raw["ev_cltrl_dtls"].select(
            "ri_id", "ev_id", _rate("cnvrsn_prprtn"), _money("total_face_value")),
    )


def repo_inputs(raw: dict[str, DataFrame]) -> RepoInputs:
    members = lookup(
        dictionary(raw["member_d"], "ip_id", "ip_id", F.col("unq_id_in_src_sys").alias("unq_id"), "member_cd",
                   "rt_member_cd", "full_nm", "member_ctgry_id", *_validity(SLASHED)),
        member_show_names(raw), "member_ctgry_id", {"ins_show_name": labels.MISSING})
    products = dictionary(raw["pd_d"], "trdng_pd_id", F.col("pd_id").alias("trdng_pd_id"), "pd_cd")
    deals = lookup(raw["bond_repo_deal"], products, "trdng_pd_id", {"pd_cd": labels.MISSING})
    removal = raw["trdx_deal_infrmn_rmv_d"]
    superseded = (
        (F.col("dir_oprtn_type_indc") == REMOVE) & (F.col("dir_rmv_status_indc") != ACTIVE)
        & (F.col("mkt_id") == REPO_MARKET)
    )
    return RepoInputs(
        deals=deals.select(
            "ev_id", "repo_pty_id", "rvrse_repo_pty_id", "pd_cd", "deal_nmbr", "trdng_ri_id", "st",
            _date("deal_dt", SLASHED), _rate("deal_repo_rate"), _money("trade_amnt"),
        ),
        members=members.select("ip_id", "unq_id", "member_cd", "rt_member_cd", "full_nm", "ins_show_name",
                               "efctv_from_dt", "efctv_to_dt"),
        confirmed=prefixed(removal.where(~superseded), "deal_id", "ev_id"),
        ratings=dictionary(raw["ri_credit_rtng"], "trdng_ri_id", F.col("ri_id").alias("trdng_ri_id"),
                           labels.rating_bucket(F.col("rtng_desc")).alias("rtng_desc")),
        banks=raw["dps_v_cr_dep_txn_dtl"].where(
            F.col("dpst_instn_trdng_indctr") == BANK_FLAG
        ).select(F.col("deal_number").alias("deal_nmbr")),
        bonds=dictionary(raw["bond_d"], "bond_id", "bond_id",
                         labels.bond_class(F.col("bond_ctgry_nm")).alias("bond_class"), "issr_nm"),
        collateral=raw["ev_cltrl_dtls"].select(
            "ev_id", F.col("ri_id").alias("bond_id"), _rate("cnvrsn_prprtn")),
    )


def member_show_names(raw: dict[str, DataFrame]) -> DataFrame:
    """Member category and its display name: market close type -> category."""
    close_types = dictionary(raw["market_close_type_i"].where(F.col("market_nm") == labels.PLEDGED_REPO),
                             "ctgry_nm", "ctgry_nm", "ins_show_name")
    categories = dictionary(raw["member_ctgry_d"], "member_ctgry_id", "member_ctgry_id", "ctgry_nm")
    return lookup(categories, close_types, "ctgry_nm", {"ins_show_name": labels.MISSING}).select(
        "member_ctgry_id", "ins_show_name")


def prefixed(listed: DataFrame, column: str, name: str) -> DataFrame:
    """Identifiers of a list in the form the deal feed uses."""
    return listed.select(F.concat(F.lit(DEAL_ID_PREFIX), column).alias(name))


def _id(column: str) -> Column:
    return blank_to_null(F.col(column)).alias(column)


def _date(column: str, pattern: str) -> Column:
    return parse_date(F.col(column), pattern).alias(column)


def _money(column: str) -> Column:
    return parse_decimal(F.col(column), *MONEY).alias(column)


def _rate(column: str) -> Column:
    return parse_decimal(F.col(column), *RATE).alias(column)


def _validity(pattern: str) -> list[Column]:
    return [_date("efctv_from_dt", pattern), _date("efctv_to_dt", pattern)]
