"""Plans: what is shuffled, what is broadcast, what happens to a hot key."""

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from checks import bindings, queries
from ledgerloom import session
from ledgerloom.operators import lookups, merging
from ledgerloom.plans import repo

QUERIES = queries.registered()


@pytest.fixture
def settings(spark):
    """Set session values for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_python_and_no_cross_join(spark, sf_small, name):
    plan = physical(QUERIES[name](spark, sf_small))
    assert not re.search(r"Python|ArrowEval|CartesianProduct|BroadcastNestedLoopJoin|RDDScan", plan)


def test_filter_and_columns_reach_the_scan(spark, sf_small):
    plan = physical(QUERIES["m04_bond_income"](spark, sf_small))
    scan = next(line for line in plan.splitlines() if "l_returnflag" in line and "FileScan" in line)
    assert "Not(EqualTo(l_returnflag,R))" in scan
    assert "l_tax" not in scan and "l_linestatus" not in scan and "l_discount" not in scan


def test_reports_share_one_scan_of_the_deals(spark, sf_small):
    """Both sides come from one pass: no second scan of the line items."""
    for name in ("m04_bond_income", "m06_bond_deal_trend_org", "m13_member_bond_ctgry"):
        plan = physical(QUERIES[name](spark, sf_small))
        assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1, name


def test_large_reference_data_is_not_broadcast(spark, sf_small, settings, monkeypatch):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    with_hint = physical(QUERIES["m10_member_price"](spark, sf_small))
    assert "BroadcastHashJoin" in with_hint
    monkeypatch.setattr(session, "BROADCAST_LIMIT", 0)
    without = physical(QUERIES["m10_member_price"](spark, sf_small))
    assert "Broadcast" not in without


def test_small_file_of_many_rows_is_not_broadcast(spark, tmp_path, monkeypatch):
    """Dictionary encoding packs rows into few bytes; the rows count."""
    spark.range(300_000, numPartitions=1).select((F.col("id") % 5).alias("k")).write.parquet(str(tmp_path / "packed"))
    packed = spark.read.parquet(str(tmp_path / "packed"))
    assert session.input_bytes(packed) < 1_000_000 and session.input_rows(packed) == 300_000
    assert session.is_small(packed)
    monkeypatch.setattr(session, "BROADCAST_ROWS", 100_000)
    assert not session.is_small(packed.groupBy("k").count())
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.csv").write_text("h\nx\ny\n")
    assert session.input_rows(spark.read.text(str(tmp_path / "lines"))) == 3


def test_replaced_feed_is_counted_again(spark, tmp_path):
    """A file of the same name with other content has its own number of rows."""
    feed = tmp_path / "a b%.csv"
    feed.write_text("x\n" * 3)
    assert session.input_rows(spark.read.text(str(feed))) == 3
    feed.write_text("x\n" * 7)
    assert session.input_rows(spark.read.text(str(feed))) == 7


def test_deals_stay_distributed_by_deal(spark, sf_small, settings, monkeypatch):
    """Shuffle joins on the deal key share one exchange of the line items."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    monkeypatch.setattr(session, "BROADCAST_LIMIT", 0)
    plan = physical(QUERIES["m05_bond_deal_trend"](spark, sf_small))
    plan = re.sub(r"#\d+L?", "", plan)
    fact_side = [line for line in plan.splitlines() if "Exchange hashpartitioning(l_orderkey" in line]
    assert len(fact_side) == 1
    # the exchanges by deal below are those of the lists, straight from an aggregate or a scan
    assert not re.search(r"Exchange hashpartitioning\(deal_nmbr.*\n.*SortMergeJoin", plan)


@pytest.fixture
def shuffle_joins(settings, monkeypatch):
    """No broadcasts, and thresholds low enough for test data to count as skewed."""
    monkeypatch.setattr(session, "BROADCAST_LIMIT", 0)
    settings(spark__sql__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
             spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
             spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
             spark__sql__adaptive__advisoryPartitionSizeInBytes="10KB",
             spark__sql__adaptive__coalescePartitions__enabled="false")


def hot_rows(spark, folder, n=30_000):
    """Rows in several files with key 7 in a third of them."""
    spark.range(n, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint").alias("k"),
        F.col("id").cast("decimal(18,2)").alias("v")).write.parquet(folder)
    return spark.read.parquet(folder)


def test_hot_group_total_is_split(spark, shuffle_joins, tmp_path):
    df = merging.share_of_total(hot_rows(spark, str(tmp_path / "rows")), ["k"], "v")
    assert "skew=true" in executed(df)
    assert df.agg(F.sum("v"), F.count(F.lit(1))).first()[1] == 30_000
    hot = sum(i for i in range(30_000) if i % 3 == 0 or i % 500 == 7)
    assert {int(r[0]) for r in df.where("k = 7").select("v_total").distinct().collect()} == {hot}


def test_hot_lookup_key_is_split(spark, shuffle_joins, tmp_path):
    rows = hot_rows(spark, str(tmp_path / "rows"))
    twice = spark.range(500).select(F.col("id").alias("k"), F.lit("a").alias("name"))
    twice.union(twice).write.parquet(str(tmp_path / "names"))
    names = spark.read.parquet(str(tmp_path / "names"))
    for df in (lookups.lookup(rows, lookups.one_per_key(names, "k"), "k", {"name": "None"}),
               lookups.flag_listed(rows, names, "k", "known")):
        assert "skew=true" in executed(df)
        assert df.count() == 30_000


def test_hot_key_in_rows_and_list(spark, shuffle_joins, tmp_path):
    """Copies of one key on both sides of a semi and an anti join."""
    rows = hot_rows(spark, str(tmp_path / "rows"))
    listed = hot_rows(spark, str(tmp_path / "list")).where("k < 250").select(F.col("k").alias("id"))
    kept, dropped = lookups.keep_listed(rows, listed, "k", "id"), lookups.drop_listed(rows, listed, "k", "id")
    want = sum(1 for i in range(30_000) if i % 3 == 0 or i % 500 < 250)
    for df, n in ((kept, want), (dropped, 30_000 - want)):
        assert df.count() == n
    assert "skew=true" in executed(kept) and "skew=true" in executed(dropped)


def test_hot_member_is_split(spark, shuffle_joins, tmp_path):
    """A member in a third of all deals: AQE splits it, and the sums are exact."""
    # deals lie in several files, so that a hot partition has several map outputs to split
    n = 30_000
    deal = spark.range(n, numPartitions=16).select(
        F.col("id").alias("ev_id"), F.col("id").alias("deal_nmbr"), F.col("id").alias("trdng_ri_id"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint").alias("repo_pty_id"),
        (F.col("id") % 11).alias("rvrse_repo_pty_id"), F.lit("1").alias("st"),
        F.lit("R001").alias("pd_cd"), F.lit("2020-01-01").cast("date").alias("deal_dt"),
        (F.col("id") % 5).cast("decimal(9,4)").alias("deal_repo_rate"),
        (F.col("id") % 100 + 1).cast("decimal(18,2)").alias("trade_amnt"))
    deal.write.parquet(str(tmp_path / "deals"))
    member = spark.range(500).select(
        F.col("id").alias("ip_id"), F.col("id").alias("unq_id"), F.col("id").alias("member_cd"),
        (F.col("id") - F.col("id") % 10).alias("rt_member_cd"), F.lit("x").alias("full_nm"),
        F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("ins_show_name"),
        F.lit("2019-01-01").cast("date").alias("efctv_from_dt"),
        F.lit("2021-01-01").cast("date").alias("efctv_to_dt"))
    member.write.parquet(str(tmp_path / "members"))

    inputs = bindings.BoundRepoInputs(None)
    inputs.deals = spark.read.parquet(str(tmp_path / "deals"))
    inputs.members = spark.read.parquet(str(tmp_path / "members"))
    inputs.withdrawn = "2"
    session.tune(spark)

    plan = executed(repo.with_valid_parties(inputs.deals, inputs))
    assert "skew=true" in plan

    got = {r.ins_show_name: (r.repo_sum_amount, r.rvrse_sum_amount)
           for r in repo.category_rating(
               repo.pledged_legs(repo.with_valid_parties(
                   inputs.deals.withColumn("rtng_desc", F.lit("AAA")), inputs)),
               inputs).collect()}
    want = defaultdict(lambda: [0, 0])
    for i in range(n):
        repo_party = 7 if i % 3 == 0 else i % 500
        want[f"t{repo_party % 3}"][0] += i % 100 + 1
        want[f"t{i % 11 % 3}"][1] += i % 100 + 1
    assert {k: (int(a), int(b)) for k, (a, b) in got.items()} == {k: tuple(v) for k, v in want.items()}


def test_tune_raises_partitions_only(spark, settings):
    settings(spark__sql__shuffle__partitions="8")
    session.tune(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert session.shuffle_partitions(0) == 1
    assert session.shuffle_partitions(100 * 2**30) == 800
    assert session.shuffle_partitions(100 * 2**40) == session.MAX_SHUFFLE_PARTITIONS


def test_shuffles_are_cut_finer_than_scans(spark, settings, tmp_path):
    """Rows take many times the bytes of the files they come from, and a task may hold a whole partition's."""
    settings(spark__sql__shuffle__partitions="2", spark__sql__adaptive__advisoryPartitionSizeInBytes="64MB")
    spark.range(500_000, numPartitions=1).select(F.rand(1).alias("a"), F.rand(2).alias("b")).write.parquet(
        str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    session.tune(spark, *[rows] * 8)
    merged = session.byte_size(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    assert merged == 8 * 2**20
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) >= 8 * session.input_bytes(rows) / merged


def test_tune_lowers_the_merged_size_only(spark, settings):
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="1m")
    session.tune(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "1m"
    assert [session.byte_size(x) for x in ("7", "7b", "2k", "64MB", "1g", "67108864b")] == [
        7, 7, 2048, 64 * 2**20, 2**30, 2**26]


@pytest.mark.parametrize("name", ["distinct_deals", "m02_bond_bsc_info", "m19_member_bond_issr"])
def test_reports_read_small_partitions(spark, settings, sf_small, name):
    """Tasks that join and group the deals hold rows of some 8 MB of shuffled blocks, not of 64 MB."""
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="64MB")
    QUERIES[name](spark, sf_small)
    assert session.byte_size(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")) == 8 * 2**20


def test_misses_read_the_deals_once(spark, sf_small):
    """All counters over bond deals come from one scan; the collateral and its daily rates are two more."""
    plan = physical(QUERIES["lookup_miss_counts"](spark, sf_small))
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 3


def test_input_bytes_add_up(spark, sf_small):
    tables = bindings.Tables(spark, sf_small)
    one = session.input_bytes(tables.customer)
    joined = tables.customer.join(tables.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    assert one < session.input_bytes(joined) < 2 * one
