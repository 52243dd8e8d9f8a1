"""The job inputs bound onto the test tables (FIXTURES.md part B).

Orders play repo deals, line items bond deals and collateral, customers members,
suppliers and parts bonds. Some reference rows are left out so that lookups miss; the
deals themselves are whole. The list of confirmed repo deals is the strategy feed, so
that it differs from the bank flag.
"""

from __future__ import annotations

from dataclasses import fields
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom.plans.inputs import BondInputs, RepoInputs
from ledgerloom.session import broadcast_if_small, tune

BOND_CATEGORIES = (
    "国债", "政策性金融债", "同业存单", "短期融资券", "超短期融资券", "地方政府债", "企业债", "中期票据",
)


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


class Tables:
    """Parquet tables of one folder; remembers which ones a query reads.

    Declared schemas save a job per table that would only look at file footers.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.read = spark, folder.rstrip("/"), {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        if name not in self.read:
            reader = self.spark.read.schema(SCHEMAS[name])
            self.read[name] = reader.parquet(f"{self.folder}/{name}.parquet")
        return self.read[name]

    def tune(self) -> None:
        tune(self.spark, *self.read.values())


def decimal(column: str, precision: int, scale: int) -> Column:
    return F.col(column).cast(f"decimal({precision},{scale})")


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def first_day(unit: str, column: str) -> Column:
    return F.trunc(F.col(column).cast("date"), unit)


def bonds(t: Tables) -> DataFrame:
    category = F.lit("金融债")
    for code, label in enumerate(BOND_CATEGORIES):
        category = F.when(F.col("s_suppkey") % 9 == code, label).otherwise(category)
    return t.supplier.select(
        F.col("s_suppkey").alias("bond_id"),
        F.col("s_name").alias("bond_nm"),
        F.concat(F.lit("CD"), "s_suppkey").alias("bond_cd"),
        (F.col("s_suppkey") % 9).cast("string").alias("bond_ctgry_id"),
        category.alias("bond_ctgry_nm"),
        day("1995-01-01").alias("frst_value_dt"),
        day("2010-01-01").alias("mrty_dt"),
        F.when(F.col("s_acctbal") >= 0, day("1995-01-10")).alias("lstng_dt"),
        F.when(F.col("s_acctbal") < 5000, "短期").otherwise("中长期").alias("scnd_blngl_desc"),
        F.col("s_nationkey").alias("cstdtn_bank_id"),
        (1000000 + F.col("s_suppkey") * 1000).cast("decimal(18,2)").alias("ttl_face_value"),
    )


def orgs(t: Tables) -> DataFrame:
    return t.nation.where("n_nationkey < 20").select(
        F.col("n_nationkey").alias("unq_id"), F.col("n_name").alias("chn_full_nm"))


def institutions(t: Tables) -> DataFrame:
    return (
        t.nation.where("n_nationkey <> 24")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.col("n_nationkey").alias("ip_id"), F.col("r_name").alias("ins_show_name"),
                day("1996-01-01").alias("efctv_from_dt"), day("2000-10-01").alias("efctv_to_dt"))
    )


def strategies(t: Tables, missing: bool = True) -> DataFrame:
    """Strategy of the orders; every tenth has none, so that lookups miss."""
    orders = t.orders.where("o_orderkey % 10 <> 9") if missing else t.orders
    return orders.select(
        F.col("o_orderkey").alias("deal_nmbr"),
        F.substring("o_orderpriority", 1, 1).alias("deal_strategy"))


def removed(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("deal_id"))


def methods(t: Tables) -> DataFrame:
    return t.nation.where("n_nationkey BETWEEN 1 AND 7").select(
        F.col("n_nationkey").alias("trdng_mthd_id"),
        F.when(F.col("n_nationkey").isin(1, 2), "X-匿名点击").otherwise("协商")
        .alias("trdng_mthd_blngl_nm"))


def bond_deals(t: Tables) -> DataFrame:
    # the buyer joins the orders first: line items are shuffled once, by order
    buyers = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_nationkey")
    # and as narrow as the deals are, since all of them travel
    deals = t.lineitem.select(
        "l_orderkey",
        (F.col("l_partkey") % 25).cast("int").alias("seller_id"),
        F.col("l_suppkey").alias("bond_id"),
        first_day("quarter", "l_shipdate").alias("deal_dt"),
        F.col("l_returnflag").alias("st"),
        F.col("l_linenumber").alias("trdng_mthd_id"),
        decimal("l_extendedprice", 18, 2).alias("dirty_amnt"),
        decimal("l_quantity", 18, 2).alias("face_amnt"),
        decimal("l_discount", 9, 4).alias("ytm_rate"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
        .alias("trade_amnt"),
    ).join(broadcast_if_small(buyers), F.col("l_orderkey") == F.col("o_orderkey"))
    return deals.select(
        F.col("l_orderkey").alias("bond_deal_id"),
        F.col("l_orderkey").alias("deal_nmbr"),
        F.col("c_nationkey").alias("buyer_id"),
        "seller_id", "bond_id", "deal_dt", "st",
        F.lit("CNY").alias("instmt_crncy"),
        "trdng_mthd_id",
        (F.col("trdng_mthd_id") * 2).cast("decimal(9,2)").alias("yr_of_time_to_mrty"),
        "dirty_amnt", "face_amnt", "ytm_rate", "trade_amnt",
    )


def repo_members(t: Tables, missing: bool = True) -> DataFrame:
    """Customers as members; every fiftieth is left out, so that lookups miss."""
    key = F.col("c_custkey")
    customers = t.customer.where("c_custkey % 50 <> 49") if missing else t.customer
    return customers.select(
        key.alias("ip_id"), key.alias("unq_id"), key.alias("member_cd"),
        (key - key % 10).alias("rt_member_cd"),
        F.col("c_name").alias("full_nm"), F.col("c_mktsegment").alias("ins_show_name"),
        day("1995-03-01").alias("efctv_from_dt"), day("2001-06-01").alias("efctv_to_dt"))


def repo_deals(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    priority = F.substring("o_orderpriority", 1, 1)
    return t.orders.select(
        key.alias("ev_id"), key.alias("deal_nmbr"), key.alias("trdng_ri_id"),
        F.col("o_custkey").alias("repo_pty_id"), (key % 97).alias("rvrse_repo_pty_id"),
        F.col("o_orderstatus").alias("st"),
        F.when(priority == "1", "R001").when(priority == "2", "R007").when(priority == "3", "R014")
        .when(priority == "4", "R021").otherwise("None").alias("pd_cd"),
        first_day("month", "o_orderdate").alias("deal_dt"),
        (100 + key % 400).cast("decimal(9,4)").alias("deal_repo_rate"),
        decimal("o_totalprice", 18, 2).alias("trade_amnt"),
    )


def collateral(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("ev_id"), F.col("l_partkey").alias("ri_id"),
        (1 - F.col("l_discount")).cast("decimal(9,4)").alias("cnvrsn_prprtn"),
        decimal("l_quantity", 18, 2).alias("total_face_value"))


def raw_collateral_bonds(t: Tables) -> DataFrame:
    return t.part.where("p_size <= 48").select(
        F.col("p_partkey").alias("bond_id"), F.col("p_brand").alias("issr_nm"),
        F.when(F.col("p_type").isin("STANDARD", "PROMO"), "利率债")
        .when(F.col("p_type") == "ECONOMY", "同业存单").otherwise("信用债").alias("bond_class"))


def ratings(t: Tables) -> DataFrame:
    code = F.col("o_orderkey") % 5
    return t.orders.where("o_orderkey % 5 <> 4").select(
        F.col("o_orderkey").alias("trdng_ri_id"),
        F.when(code == 0, "AAA").when(code == 1, "AA+").otherwise("AA及以下").alias("rtng_desc"))


def bank_deals(t: Tables) -> DataFrame:
    return t.orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("deal_nmbr"))


def trades(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderdate").cast("date").alias("deal_dt"),
        F.col("o_custkey").cast("string").alias("org_nm"),
        F.col("o_orderstatus").alias("player_type"), F.col("o_orderpriority").alias("bond_type"),
        decimal("o_totalprice", 18, 2).alias("amount"), F.col("o_orderkey").alias("deal_nmbr"),
        F.concat("o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias("bond_id"))


class BoundBondInputs:
    """BondInputs over the test tables; a frame is built when a plan first asks for it."""

    withdrawn, rates = "R", None

    def __init__(self, t: Tables):
        self.tables = t

    deals = cached_property(lambda self: bond_deals(self.tables))
    bonds = cached_property(lambda self: bonds(self.tables))
    orgs = cached_property(lambda self: orgs(self.tables))
    strategies = cached_property(lambda self: strategies(self.tables))
    removed = cached_property(lambda self: removed(self.tables))
    members = cached_property(lambda self: institutions(self.tables))
    methods = cached_property(lambda self: methods(self.tables))
    repo_deals = cached_property(
        lambda self: repo_deals(self.tables).select("ev_id", "deal_dt", "trade_amnt"))
    collateral = cached_property(lambda self: collateral(self.tables))


class BoundRepoInputs:
    """RepoInputs over the test tables, built on demand."""

    withdrawn, profiles = "P", None
    fund_marker = "7"

    def __init__(self, t: Tables):
        self.tables = t

    deals = cached_property(lambda self: repo_deals(self.tables))
    members = cached_property(lambda self: repo_members(self.tables))
    confirmed = cached_property(
        lambda self: strategies(self.tables).select(F.col("deal_nmbr").alias("ev_id")))
    ratings = cached_property(lambda self: ratings(self.tables))
    banks = cached_property(lambda self: bank_deals(self.tables))
    bonds = cached_property(lambda self: raw_collateral_bonds(self.tables))
    collateral = cached_property(
        lambda self: collateral(self.tables).withColumnRenamed("ri_id", "bond_id"))


def bond_inputs(t: Tables) -> BondInputs:
    return BoundBondInputs(t)


def repo_inputs(t: Tables) -> RepoInputs:
    return BoundRepoInputs(t)


def every_input(bound, kind):
    """All frames of the bound inputs as ``BondInputs`` or ``RepoInputs``."""
    return kind(**{field.name: getattr(bound, field.name) for field in fields(kind)})


def event_lines(t: Tables) -> DataFrame:
    """Events as comma text: user, event, suffix."""
    return t.events.select(F.concat_ws(",", "user_id", "event_type", "event_id").alias("value"))


def trade_lines(t: Tables) -> DataFrame:
    """Orders in the layout of the trade file."""
    return t.orders.select(F.concat_ws(
        ",", F.date_format("o_orderdate", "yyyy/MM/dd"), "o_custkey", "o_orderstatus",
        "o_orderpriority", F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        "o_orderkey", F.lit(""), F.substring("o_orderpriority", 1, 1)).alias("value"))


def org_lines(t: Tables) -> DataFrame:
    """Suppliers as lines of the ORG feed: quoted, with blanks, and partly malformed."""
    shape = F.col("s_suppkey") % 7
    name, key = F.col("s_name"), F.col("s_suppkey").cast("string")
    line = (
        F.when(shape == 0, F.concat(F.lit('"'), name, F.lit(', Ltd",'), key))
        .when(shape == 1, F.concat(F.lit('" '), name, F.lit(' " ,  "'), key, F.lit('"')))
        .when(shape == 2, F.concat(name, F.lit(","), key, F.lit(",extra")))
        .when(shape == 3, F.concat(name, F.lit(" BORG,"), key))
        .when(shape == 4, F.concat(F.lit('"a""'), name, F.lit('",'), key))
        .when(shape == 5, F.concat(F.lit('"",'), key))
        .otherwise(F.concat(name, F.lit(" , "), key))
    )
    return t.supplier.select(line.alias("value"))
