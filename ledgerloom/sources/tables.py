"""Contract of the report tables: key and typed columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DataType, DateType, DecimalType, LongType, StringType, StructField, StructType,
)

AMOUNT = DecimalType(38, 10)


@dataclass(frozen=True)
class ReportTable:
    name: str
    key: tuple[str, ...]
    columns: dict[str, DataType]

    @property
    def schema(self) -> StructType:
        return StructType([
            StructField(name, kind, name not in self.key) for name, kind in self.columns.items()
        ])

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the table's columns in order and cast them to the table's types."""
        return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in self.columns.items()])


def _table(name: str, key: str, text: str = "", dates: str = "", amounts: str = "",
           counts: str = "") -> ReportTable:
    """Key columns are text, but for the deal date; the rest is listed by type."""
    columns: dict[str, DataType] = {}
    for column in key.split():
        columns[column] = DateType() if column == "deal_dt" else StringType()
    for names, kind in ((text, StringType()), (dates, DateType()), (amounts, AMOUNT),
                        (counts, LongType())):
        columns.update({column: kind for column in names.split()})
    return ReportTable(name, tuple(key.split()), columns)


# Table names, keys and columns are those of the report store.
_BOTH_AMOUNTS = "repo_sum_amount rvrse_sum_amount"
_BOTH_RATIOS = "repo_weighted_cnvrsn_prprtn rvrse_weighted_cnvrsn_prprtn"
_MEMBER = "unq_id_in_src_sys join_type"

REPORT_TABLES = {table.name: table for table in (
    _table("BOND_BSC_INFO", "deal_dt bond_id",
           text="bond_cd bond_nm bond_ctgry_nm bond_prd cstdn", dates="frst_value_dt mrty_dt",
           amounts="yr_of_time_to_mrty issue_vlmn trd_amnt day_turnover_rate", counts="deal_cnt"),
    _table("BOND_TURNOVER_RATE", "deal_dt bond_id bond_prd bond_ctgry_nm2",
           text="bond_cd bond_nm", amounts="day_turnover_rate trd_amnt_sum zy_rate"),
    _table("BOND_INCOME", "deal_dt bond_id org_id", text="bond_cd bond_nm",
           amounts="buy_paper_all buy_act_all sell_paper_all sell_act_all"),
    _table("BOND_DEAL_TREND", "deal_dt bond_id", text="bond_cd bond_nm",
           amounts="dirty_price_wg_bf dirty_price_wg_af"),
    _table("BOND_DEAL_TREND_ORG", "deal_dt bond_id org_id", text="bond_cd bond_nm ins_show_name",
           amounts="buy_ytm_rate_bf buy_ytm_rate_af sell_ytm_rate_bf sell_ytm_rate_af"),
    _table("BOND_DEAL_ORGTYPE", "deal_dt bond_id ins_show_name", text="bond_cd bond_nm",
           amounts="trd_amnt net_amnt"),
    _table("BOND_DEAL_ORGLIST", "deal_dt bond_id bond_ctgry_id org_id ins_show_name",
           text="bond_cd bond_nm"),
    _table("BOND_DEAL_SMART", "deal_dt bond_id", text="bond_cd bond_nm bond_ctgry_nm2",
           counts="trade_normal trade_smart"),
    _table("XBOND_INFO", "bond_cd", text="bond_nm"),
    _table("MEMBER_PRICE_DEAL_INFO", f"{_MEMBER} pd_cd deal_dt",
           amounts="repo_weighted_price repo_sum_amount rvrse_weighted_price rvrse_sum_amount "
                   "price_difference total_amount"),
    _table("CTGRY_PRICE_DEAL_INFO", "ins_show_name pd_cd deal_dt",
           amounts="repo_weighted_price rvrse_weighted_price repo_max_deal_repo_rate "
                   "repo_min_deal_repo_rate rvrse_max_deal_repo_rate rvrse_min_deal_repo_rate "
                   "price_difference"),
    _table("GLOBAL_PRICE_DEAL_INFO", "pd_cd deal_dt",
           amounts="banks_weighted_price banks_max_deal_repo_rate banks_min_deal_repo_rate "
                   "market_weighted_price market_max_deal_repo_rate market_min_deal_repo_rate"),
    _table("MEMBER_BOND_CTGRY_DEAL_INFO", f"{_MEMBER} bond_ctgry_nm deal_dt",
           amounts=_BOTH_AMOUNTS),
    _table("CTGRY_BOND_CTGRY_DEAL_INFO", "ins_show_name bond_ctgry_nm deal_dt",
           amounts=_BOTH_AMOUNTS),
    _table("MEMBER_BOND_RTNG_DEAL_INFO", f"{_MEMBER} rtng_desc deal_dt", amounts=_BOTH_AMOUNTS),
    _table("CTGRY_BOND_RTNG_DEAL_INFO", "ins_show_name rtng_desc deal_dt", amounts=_BOTH_AMOUNTS),
    _table("MEMBER_BOND_TYPE_DEAL_INFO", f"{_MEMBER} bond_ctgry_nm rtng_desc deal_dt",
           amounts=f"{_BOTH_RATIOS} {_BOTH_AMOUNTS}"),
    _table("CTGRY_BOND_TYPE_DEAL_INFO", "ins_show_name bond_ctgry_nm rtng_desc deal_dt",
           amounts=_BOTH_RATIOS),
    _table("MEMBER_BOND_ISSR_DEAL_INFO", f"{_MEMBER} issr_nm deal_dt",
           amounts=f"{_BOTH_RATIOS} {_BOTH_AMOUNTS}"),
    _table("CTGRY_BOND_ISSR_DEAL_INFO", "ins_show_name issr_nm deal_dt", amounts=_BOTH_RATIOS),
    _table("MEMBER_CTGRY_AMOUNT_DEAL_INFO", f"{_MEMBER} cou_party_ins_show_name deal_dt",
           amounts=_BOTH_AMOUNTS),
    _table("CTGRY_CTGRY_AMOUNT_DEAL_INFO", "ins_show_name cou_party_ins_show_name deal_dt",
           amounts=_BOTH_AMOUNTS),
    _table("MEMBER_CTGRY_NUMBER_DEAL_INFO",
           f"ins_show_name {_MEMBER} cou_party_ins_show_name deal_dt",
           text="repo_cou_party_uniq_set rvrse_cou_party_uniq_set"),
)}
