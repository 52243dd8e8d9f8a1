"""Registered queries: one per operator, base relation and report."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, StringType

from checks import bindings as b
from checks.bindings import Tables
from ledgerloom.functions import labels
from ledgerloom.functions.measures import extremes, ratio, weighted_average
from ledgerloom.functions.text import parse_date, set_text
from ledgerloom.jobs.common import write_counters
from ledgerloom.operators import expansion, merging, quality
from ledgerloom.operators.grouping import REPORT, regroup
from ledgerloom.operators.lookups import (
    drop_listed, enrich, keep_listed, last_per_key, one_per_key, valid_attribute, with_root,
)
from ledgerloom.plans import bond, counters, market, repo, words
from ledgerloom.plans.inputs import BondInputs, RepoInputs
from ledgerloom.plans.market import MarketQuery
from ledgerloom.session import shared_folder
from ledgerloom.sources import feeds, intake, layouts, loaders, sinks
from ledgerloom.sources.store import BASE, DELTA, Store
from ledgerloom.sources.tables import AMOUNT, ReportTable

YEAR = MarketQuery(date(1997, 1, 1), date(1997, 12, 31))
FILTERED = MarketQuery(date(1996, 3, 1), date(1998, 8, 31), player_type="F", bond_type="1-URGENT")
ONE_ORG = MarketQuery(date(1995, 1, 1), date(2000, 12, 31), org="7")
QUARTER = MarketQuery(date(1998, 1, 1), date(1998, 3, 31))
LATE = date(2000, 1, 1)

_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    _QUERIES[build.__name__] = build
    return build


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(build) for name, build in _QUERIES.items()}


def _runner(build):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = Tables(spark, sf_dir)
        result = _decimals_as_double(build(tables))
        tables.tune()
        return result
    return run


def _decimals_as_double(df: DataFrame) -> DataFrame:
    """Decimals as double of six digits, so that both engines hand over the same number."""
    return df.select(*[
        F.round(f.name, 6).cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
        else F.col(f.name) for f in df.schema.fields
    ])


# ---------------------------------------------------------------- scans and filters

@query
def scan_feed_clean(t):
    return feeds.parse_feed(b.org_lines(t), layouts.BOND_ORG)


@query
def scan_feed_required(t):
    layout = layouts.FeedLayout("org", "ORG", layouts.BOND_ORG.columns, layouts.BOND_ORG.columns)
    return feeds.parse_feed(b.org_lines(t), layout)


@query
def scan_feed_first_line(t):
    """Lines that hold the header tag in their data are kept."""
    return feeds.parse_feed(b.org_lines(t), layouts.BOND_ORG, header=feeds.FIRST_LINE)


@query
def scan_feed_rejects(t):
    return feeds.rejects(b.org_lines(t), layouts.BOND_ORG)


@query
def split_records(t):
    return feeds.split_record(b.trade_lines(t), layouts.TRADE_COLUMNS)


@query
def filter_product_in(t):
    return repo.reported_products(b.repo_deals(t)).select("ev_id", "pd_cd", "trade_amnt")


@query
def filter_contains(t):
    return b.repo_members(t, missing=False).where(repo.is_money_fund("7")).select("unq_id", "full_nm")


@query
def filter_status(t):
    return repo.not_withdrawn(b.repo_deals(t), "P").select("ev_id", "st")


@query
def filter_date_range(t):
    return b.trades(t).where(market.in_range(YEAR)).select("deal_nmbr", "deal_dt")


@query
def filter_optional(t):
    return market.matching_trades(b.trades(t), FILTERED)


@query
def filter_one_org(t):
    return market.matching_trades(b.trades(t), ONE_ORG).select("deal_nmbr", "org_nm", "amount")


# ---------------------------------------------------------------- labels

@query
def case_strategy(t):
    return b.strategies(t, missing=False).select(
        "deal_nmbr", labels.strategy_label(F.col("deal_strategy")).alias("strategy"))


@query
def case_bond_category(t):
    return b.bonds(t).select(
        "bond_id", labels.bond_category(F.col("bond_ctgry_nm")).alias("bond_ctgry_nm2"))


@query
def case_bond_class(t):
    return b.bonds(t).select(
        "bond_id", labels.bond_class(F.col("bond_ctgry_nm")).alias("bond_class"))


@query
def case_rating(t):
    code = F.col("o_orderkey") % 5
    raw = (F.when(code == 0, "AAA").when(code == 1, "AA+").when(code == 2, "A-1+")
           .when(code == 3, "AA＋").otherwise("AA-"))
    return t.orders.select(F.col("o_orderkey").alias("ri_id"),
                           labels.rating_bucket(raw).alias("rtng_desc"))


@query
def bucket_tenor(t):
    return b.bond_deals(t).groupBy(
        "yr_of_time_to_mrty", bond.tenor().alias("tenor")
    ).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- joins

@query
def lookup_default(t):
    return bond.bond_attributes(b.bond_inputs(t)).select("bond_id", "cstdn", "bond_ctgry_nm2")


@query
def lookup_inner(t):
    buyers = b.institutions(t).select(F.col("ip_id").alias("buyer_id"), "ins_show_name")
    return enrich(b.bond_deals(t), buyers, "buyer_id", "ins_show_name").select(
        "bond_deal_id", "buyer_id", "bond_id", "ins_show_name", "dirty_amnt")


@query
def snowflake_lookup(t):
    deals = bond.enriched_deals(b.bond_inputs(t))
    return deals.groupBy("cstdn", "buyer_type", "seller_type").agg(
        F.count(F.lit(1)).alias("n_deals"), F.sum("dirty_amnt").alias("dirty_amnt"))


@query
def semi_confirmed(t):
    return keep_listed(b.repo_deals(t), b.bank_deals(t), "deal_nmbr").select("ev_id", "trade_amnt")


@query
def semi_prefixed(t):
    """Confirmed identifiers carry a prefix in the deal feed."""
    deals = b.repo_deals(t).select(
        F.concat(F.lit(loaders.DEAL_ID_PREFIX), "ev_id").alias("ev_id"), "trade_amnt")
    listed = b.bank_deals(t).select(F.col("deal_nmbr").cast("string").alias("deal_id"))
    return keep_listed(deals, loaders.prefixed(listed, "deal_id", "ev_id"), "ev_id")


@query
def dictionary_one_per_key(t):
    """A feed with repeated keys as a dictionary."""
    return one_per_key(
        t.lineitem.select("l_orderkey", "l_returnflag", "l_linestatus", "l_suppkey"), "l_orderkey")


@query
def parse_dates(t):
    """Dates with one-digit months and days; every order of 1996 is dirty."""
    text = F.when(F.year("o_orderdate") == 1996, "1996/13/45").otherwise(
        F.concat_ws("/", F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate")))
    return t.orders.select("o_orderkey", parse_date(text, loaders.SLASHED).alias("deal_dt"))


@query
def zero_weight_guard(t):
    """Groups whose weights add up to zero have no average."""
    weight = F.when(F.col("pd_cd") == "R001", 0).otherwise(F.col("trade_amnt"))
    return b.repo_deals(t).groupBy("pd_cd").agg(
        weighted_average(F.col("deal_repo_rate"), weight).alias("weighted_rate"))


@query
def anti_removed(t):
    return drop_listed(b.bond_deals(t), b.removed(t), "bond_deal_id", "deal_id").select(
        "bond_deal_id", "bond_id", "dirty_amnt")


@query
def valid_both_parties(t):
    return repo.with_valid_parties(b.repo_deals(t), b.repo_inputs(t)).select(
        "ev_id", "deal_dt", "repo_unq_id", "rvrse_unq_id", "repo_root_id", "rvrse_root_id",
        "repo_kind", "rvrse_kind")


@query
def valid_at_exclusive(t):
    deals = b.bond_deals(t).select("bond_id", "deal_dt", F.col("buyer_id").alias("ip_id")).distinct()
    return valid_attribute(deals, b.institutions(t), "ip_id", "deal_dt", "ins_show_name",
                           labels.MISSING)


@query
def root_rollup(t):
    members = b.repo_members(t, missing=False)
    text = members.withColumn("unq_id", F.col("unq_id").cast("string"))
    return with_root(text).groupBy("root_id").agg(F.count(F.lit(1)).alias("n_members"))


@query
def tag_expand_totals(t):
    inputs = b.repo_inputs(t)
    profiles = repo.member_profiles(inputs).select(
        F.col("ip_id").alias("repo_pty_id"), "root_id", "kind")
    amounts = inputs.deals.groupBy("repo_pty_id").agg(
        F.sum("trade_amnt").alias("amount"), F.count(F.lit(1)).alias("n_deals"))
    per_kind = amounts.join(profiles, "repo_pty_id").groupBy("root_id", "kind").agg(
        F.sum("amount").alias("amount"), F.sum("n_deals").alias("n_deals"))
    return expansion.expand_join_types(per_kind).groupBy("root_id", "join_type").agg(
        F.sum("amount").alias("amount"), F.sum("n_deals").alias("n_deals"))


@query
def deal_collateral_fanout(t):
    inputs = b.repo_inputs(t)
    return repo.collateral_lines(repo.confirmed_deals(inputs), inputs).select(
        "ev_id", "bond_id", "bond_class", "issr_nm", "cnvrsn_prprtn", "trade_amnt")


@query
def side_spread(t):
    deals = repo.reported_products(b.repo_deals(t)).withColumn(
        "weighted", F.col("deal_repo_rate") * F.col("trade_amnt"))

    def side(party, name):
        return deals.groupBy((F.col(party) % 10).alias("party_group"), "pd_cd").agg(
            F.sum("weighted").alias(f"{name}_weighted"), F.sum("trade_amnt").alias(f"{name}_sum_amount"))

    both = side("repo_pty_id", repo.REPO).join(side("rvrse_repo_pty_id", repo.REVERSE), ["party_group", "pd_cd"])
    total = F.col(f"{repo.REPO}_sum_amount") + F.col(f"{repo.REVERSE}_sum_amount")
    return both.select("party_group", "pd_cd", repo.spread(), total.alias("total_amount"))


@query
def buy_sell_full_outer(t):
    deals = bond.clean_deals(b.bond_inputs(t))
    return bond.positions(deals).select(
        *bond.POSITION_KEYS, "buy_act_all", "buy_paper_all", "sell_act_all", "sell_paper_all")


@query
def share_of_total(t):
    lines = merging.share_of_total(b.collateral(t), ["ri_id"], "total_face_value")
    share = ratio(F.col("total_face_value"), F.col("total_face_value_total"))
    return lines.select("ev_id", "ri_id", "total_face_value", share.alias("share"))


@query
def collateral_rate(t):
    return bond.collateral_rate(b.repo_deals(t), b.collateral(t))


@query
def small_ratio(t):
    """A turnover of some 5e-8 keeps the digits that the report tables hold."""
    return t.supplier.select("s_suppkey", ratio(
        (50 + F.col("s_suppkey") % 7).cast("decimal(18,2)"),
        F.lit(1_000_000_000).cast("decimal(18,2)")).cast("double").alias("turnover"))


# ---------------------------------------------------------------- aggregations

@query
def wavg_rate(t):
    return b.repo_deals(t).groupBy("pd_cd", "deal_dt").agg(
        weighted_average(F.col("deal_repo_rate"), F.col("trade_amnt")).alias("weighted_rate"),
        F.sum("trade_amnt").alias("amount"))


def _labelled_deals(t: Tables) -> DataFrame:
    inputs = b.bond_inputs(t)
    return bond.with_strategy(bond.clean_deals(inputs), inputs)


@query
def wavg_conditional(t):
    deals = _labelled_deals(t)
    rate, weight = F.col("ytm_rate"), F.col("trade_amnt")
    return deals.groupBy("bond_id").agg(
        weighted_average(rate, weight, bond.is_normal()).alias("normal_rate"),
        weighted_average(rate, weight, ~bond.is_normal()).alias("other_rate"))


@query
def minmax_rate(t):
    return b.repo_deals(t).groupBy("pd_cd", "deal_dt").agg(*extremes(F.col("deal_repo_rate"), "", "_rate"))


@query
def distinct_deals(t):
    return b.bond_deals(t).groupBy("bond_id", "deal_dt").agg(
        bond.deal_count(), F.count(F.lit(1)).alias("n_rows"))


@query
def trade_kind_counts(t):
    return _labelled_deals(t).groupBy("strategy").agg(
        F.count_if(bond.is_normal()).alias("trade_normal"),
        F.count_if(~bond.is_normal()).alias("trade_smart"))


@query
def any_attr(t):
    return b.bond_deals(t).groupBy("bond_id").agg(
        F.min_by("buyer_id", "bond_deal_id").alias("first_buyer"))


@query
def counterparty_set(t):
    deals = b.repo_deals(t).select("repo_pty_id", F.col("rvrse_repo_pty_id").cast("string").alias("p"))
    return deals.distinct().groupBy("repo_pty_id").agg(
        set_text(F.collect_set("p")).alias("parties"))


@query
def global_summary(t):
    return market.market_report(b.trades(t), YEAR)


@query
def last_n_trading_days(t):
    return market.comparison_days(b.trades(t), QUARTER)


@query
def limit_sorted(t):
    return market.preview(b.trades(t), YEAR)


@query
def distinct_dates(t):
    return market.trading_days(b.trades(t))


# ---------------------------------------------------------------- text

@query
def word_count(t):
    return words.word_count(words.text_lines(t.documents))


@query
def event_expand(t):
    return words.expand_events(b.event_lines(t), "signup")


# ---------------------------------------------------------------- counters and merges

@query
def load_counts(t):
    bonds_in, repo_in = b.bond_inputs(t), b.repo_inputs(t)
    return quality.load_counts({
        "bond_deal": bonds_in.deals, "bond_d": bonds_in.bonds, "org": bonds_in.orgs,
        "dps_v_cbt_all_txn_dtl": bonds_in.strategies, "trdx_deal_infrmn_rmv_d": bonds_in.removed,
        "member_d": bonds_in.members, "ev_cltrl_dtls": bonds_in.collateral,
        "bond_repo_deal": repo_in.deals, "repo_member_d": repo_in.members,
        "ri_credit_rtng": repo_in.ratings, "dps_v_cr_dep_txn_dtl": repo_in.banks,
        "repo_bond_d": repo_in.bonds,
    })


@query
def lookup_miss_counts(t):
    return merging.append_families(
        counters.bond_misses(b.bond_inputs(t)), counters.repo_misses(b.repo_inputs(t)))


def _daily_amounts(deals: DataFrame) -> DataFrame:
    return deals.groupBy("deal_dt", "bond_id").agg(F.sum("dirty_amnt").alias("trd_amnt"))


@query
def upsert_merge(t):
    deals = b.bond_deals(t)
    existing = _daily_amounts(deals.where(F.col("st") != "R"))
    arriving = _daily_amounts(deals.where(F.col("deal_dt") >= F.lit(LATE)))
    return merging.upsert(existing, arriving, ["deal_dt", "bond_id"])


def _shared(t: Tables, name: str) -> str:
    """A new folder that driver and executors share."""
    shared = shared_folder(t.spark, t.spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


DAILY_AMOUNT = ReportTable("DAILY_AMOUNT", ("deal_dt", "bond_id"),
                           {"deal_dt": DateType(), "bond_id": StringType(), "trd_amnt": AMOUNT})


def _published(t: Tables, *parts: tuple[str, DataFrame]) -> Store:
    """A new store with a version for each part."""
    store = Store(t.spark, _shared(t, "store"), {DAILY_AMOUNT.name: DAILY_AMOUNT})
    for kind, rows in parts:
        store.publish({DAILY_AMOUNT.name: (kind, store.write(rows, DAILY_AMOUNT))})
    return store


@query
def upsert_deltas(t):
    """Late rows as deltas over a base, merged on read, and compacted in between."""
    deals = b.bond_deals(t)
    late = deals.where(F.col("deal_dt") >= F.lit(LATE))
    store = _published(t, (BASE, _daily_amounts(deals.where(F.col("st") != "R"))), (DELTA, _daily_amounts(late)))
    store.compact()
    store.publish({DAILY_AMOUNT.name: (DELTA, store.write(_daily_amounts(late.where(F.col("st") == "R")), DAILY_AMOUNT))})
    return store.snapshot().read(DAILY_AMOUNT)


@query
def rebuild_versions(t):
    """A reader of the first version, and one of the rebuilt table."""
    deals = b.bond_deals(t)
    store = _published(t, (BASE, _daily_amounts(deals)))
    before = store.snapshot()
    store.publish({DAILY_AMOUNT.name: (BASE, store.write(_daily_amounts(deals.where(F.col("st") == "R")), DAILY_AMOUNT))})
    return merging.append_families(*[
        snapshot.read(DAILY_AMOUNT).withColumn("version", F.lit(snapshot.number))
        for snapshot in (before, store.snapshot())])


@query
def text_sink(t):
    path = _shared(t, "words")
    sinks.write_text(words.as_text(words.word_count(words.text_lines(t.documents))), path)
    return t.spark.read.text(path)


@query
def feed_intake(t):
    """A feed written as text and taken in again: good rows, and rejects with their reason."""
    folder = _shared(t, "feed")
    sinks.write_text(b.org_lines(t), f"{folder}/org.csv")
    taken = intake.taken_in(t.spark, f"{folder}/org.csv", layouts.BOND_ORG, f"{folder}/staged", header=feeds.TAG)
    return merging.append_families(
        taken.rows.select(*layouts.BOND_ORG.columns, F.lit(None).cast("string").alias("reason")),
        taken.rejects.select(*[F.lit(None).cast("string").alias(c) for c in layouts.BOND_ORG.columns], "reason"))


@query
def dictionary_last_line(t):
    """Of several lines with a key the last holds."""
    return last_per_key(t.events.select("user_id", "event_type", "value", "event_id"), "user_id", position="event_id")


@query
def observed_misses(t):
    """The miss counters, taken while the relations of both jobs are written."""
    folder = _shared(t, "observed")
    watch = quality.Watch()
    bond_in = counters.watch_bond(b.every_input(b.bond_inputs(t), BondInputs), watch)
    bond_in = replace(bond_in, **{
        name: sinks.stage(getattr(bond_in, name), f"{folder}/bond_{name}") for name in ("bonds", "members")})
    bond_in = replace(bond_in, rates=bond.collateral_rate(bond_in.repo_deals, bond_in.collateral))
    sinks.stage(counters.watch_clean_deals(bond.clean_deals(bond_in), bond_in, watch), f"{folder}/bond_deals")
    repo_in = counters.watch_repo(b.every_input(b.repo_inputs(t), RepoInputs), watch)
    repo_in = replace(repo_in, members=sinks.stage(repo_in.members, f"{folder}/repo_members"))
    sinks.stage(counters.watch_profiles(repo_in.members, repo_in, watch), f"{folder}/profiles")
    sinks.stage(counters.watch_confirmed(repo.confirmed_deals(repo_in), repo_in, watch), f"{folder}/repo_deals")
    sinks.stage(counters.watch_collateral(repo_in, watch).collateral, f"{folder}/collateral")
    write_counters(t.spark, watch.values(), "counter", "misses", f"{folder}/misses")
    return t.spark.read.parquet(f"{folder}/misses")


@query
def grouping_sets(t):
    """Amounts by three sets of columns in one pass."""
    sets = {"product": ["pd_cd", "deal_dt"], "party": ["repo_pty_id"], "status": ["st", "pd_cd"]}
    return regroup(b.repo_deals(t), sets, ["trade_amnt"]).withColumnRenamed(REPORT, "report")


@query
def market_of_days(t):
    """The market report from daily totals and bitmaps; dictionary and totals of later days are added."""
    trades = b.trades(t)
    early = F.col("deal_dt") < F.lit(date(1997, 1, 1))
    numbers = market.number_values(trades.where(early))
    numbers = sinks.stage(market.number_values(trades.where(~early), numbers), _shared(t, "numbers"))
    bits = merging.append_families(*[market.daily_bitmaps(trades.where(c), numbers) for c in (early, ~early)])
    return market.market_report_of_days(market.daily_sums(trades), bits, FILTERED)


@query
def merge_partial_columns(t):
    deals = repo.reported_products(b.repo_deals(t))
    price = weighted_average(F.col("deal_repo_rate"), F.col("trade_amnt"))
    banks = keep_listed(deals, b.bank_deals(t), "deal_nmbr")
    return merging.merge_partial_rows(
        ["pd_cd", "deal_dt"],
        deals.groupBy("pd_cd", "deal_dt").agg(price.alias("market_price")),
        deals.groupBy("pd_cd", "deal_dt").agg(F.max("deal_repo_rate").alias("market_max")),
        banks.groupBy("pd_cd", "deal_dt").agg(price.alias("banks_price")))


@query
def append_row_families(t):
    deals = b.bond_deals(t).select("bond_id", "dirty_amnt", bond.tenor().alias("bond_prd"))
    by_tenor = deals.groupBy("bond_id", "bond_prd").agg(F.sum("dirty_amnt").alias("amount"))
    whole = by_tenor.groupBy("bond_id").agg(F.sum("amount").alias("amount")).withColumn(
        "bond_prd", F.lit(labels.ALL_TENORS))
    return merging.append_families(by_tenor, whole)


# ---------------------------------------------------------------- base relations

@query
def base_t1(t):
    return bond.enriched_deals(b.bond_inputs(t)).select(
        "bond_deal_id", "bond_id", "deal_dt", "bond_cd", "bond_ctgry_nm2", "cstdn", "strategy",
        "tenor", "buyer_type", "seller_type", "dirty_amnt", "trade_amnt", "ytm_rate")


@query
def base_t2(t):
    inputs = b.bond_inputs(t)
    deals = bond.with_strategy(bond.clean_deals(inputs), inputs)
    return bond.positions(deals).join(bond.position_yields(deals), bond.POSITION_KEYS)


@query
def base_t3(t):
    inputs = b.bond_inputs(t)
    return bond.collateral_rate(inputs.repo_deals, inputs.collateral)


@query
def base_r2(t):
    return repo.reported_products(repo.valid_deals(b.repo_inputs(t))).select(
        "ev_id", "pd_cd", "deal_dt", "repo_unq_id", "rvrse_unq_id", "deal_repo_rate", "trade_amnt")


@query
def base_r3(t):
    inputs = b.repo_inputs(t)
    return repo.collateral_lines(repo.valid_deals(inputs, rating=True), inputs).select(
        "ev_id", "pd_cd", "deal_dt", "repo_unq_id", "rvrse_unq_id", "rtng_desc", "bond_id",
        "bond_class", "issr_nm", "cnvrsn_prprtn", "trade_amnt")


@query
def base_r1(t):
    return repo.valid_deals(b.repo_inputs(t), rating=True, bank_flag=True, line_count=True).select(
        "ev_id", "pd_cd", "deal_dt", "repo_unq_id", "rvrse_unq_id", "rtng_desc", "is_bank_deal",
        F.col("n_lines").cast("bigint").alias("n_lines"), "deal_repo_rate", "trade_amnt")


# ---------------------------------------------------------------- bond reports

def _bond_report(name: str, build, *steps) -> None:
    """Register a report; each step turns the deals into the relation it starts from."""
    def report(t):
        inputs = b.bond_inputs(t)
        relation = bond.clean_deals(inputs)
        for step in steps:
            relation = step(relation, inputs)
        return build(relation, inputs)

    report.__name__ = name
    query(report)


def _positions(deals, inputs):
    return bond.positions(deals)


def _yields(deals, inputs):
    return bond.position_yields(deals)


_bond_report("m01_xbond_info", bond.xbond_info)
_bond_report("m02_bond_bsc_info", bond.bond_bsc_info)
_bond_report("m03_bond_turnover_rate", bond.bond_turnover_rate)
_bond_report("m04_bond_income", bond.bond_income, _positions)
_bond_report("m05_bond_deal_trend", bond.bond_deal_trend, bond.with_strategy)
_bond_report("m06_bond_deal_trend_org", bond.bond_deal_trend_org, bond.with_strategy, _yields)
_bond_report("m07_bond_deal_orgtype", bond.bond_deal_orgtype, _positions)
_bond_report("m08_bond_deal_orglist", bond.bond_deal_orglist, _positions)
_bond_report("m09_bond_deal_smart", bond.bond_deal_smart, bond.with_strategy)


# ---------------------------------------------------------------- repo reports

def _repo_report(name: str, build, base=None, **attributes) -> None:
    def report(t):
        inputs = b.repo_inputs(t)
        deals = repo.valid_deals(inputs, **attributes)
        return build(base(deals, inputs) if base else deals, inputs)

    report.__name__ = name
    query(report)


def _pledged(deals, inputs):
    return repo.pledged_deals(deals)


def _pledged_legs(deals, inputs):
    return repo.pledged_legs(repo.pledged_deals(deals))


def _line_legs(deals, inputs):
    return repo.line_legs(repo.collateral_lines(deals, inputs))


_RATED, _COUNTED = {"rating": True}, {"line_count": True}

_repo_report("m10_member_price", repo.member_price)
_repo_report("m11_ctgry_price", repo.category_price)
_repo_report("m12_global_price", repo.global_price, bank_flag=True)
_repo_report("m13_member_bond_ctgry", repo.member_bond_class, _line_legs)
_repo_report("m14_ctgry_bond_ctgry", repo.category_bond_class, _line_legs)
_repo_report("m15_member_bond_rtng", repo.member_rating, _pledged_legs, **_RATED, **_COUNTED)
_repo_report("m16_ctgry_bond_rtng", repo.category_rating, _pledged_legs, **_RATED, **_COUNTED)
_repo_report("m17_member_bond_type", repo.member_bond_type, _line_legs, **_RATED)
_repo_report("m18_ctgry_bond_type", repo.category_bond_type, _line_legs, **_RATED)
_repo_report("m19_member_bond_issr", repo.member_issuer, _line_legs)
_repo_report("m20_ctgry_bond_issr", repo.category_issuer, _line_legs)
_repo_report("m21_member_ctgry_amount", repo.member_counterparty_amount, _pledged_legs, **_COUNTED)
_repo_report("m22_ctgry_ctgry_amount", repo.category_counterparty_amount, _pledged_legs, **_COUNTED)
_repo_report("m23_member_ctgry_number", repo.member_counterparty_set, _pledged, **_COUNTED)


# ---------------------------------------------------------------- other reports

@query
def m24_market_report(t):
    return market.market_report(b.trades(t), FILTERED)


@query
def m25_comparison_days(t):
    return market.comparison_days(b.trades(t), YEAR)


@query
def m26_word_count_text(t):
    return words.as_text(words.word_count(words.text_lines(t.documents)))


@query
def m27_event_counts(t):
    return words.expansion_counts(b.event_lines(t), "signup")
