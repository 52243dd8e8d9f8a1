from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.functions import labels, measures, text
from ledgerloom.operators import expansion
from ledgerloom.plans import words


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_tenor_limits_are_inclusive(spark):
    got = values(spark, labels.tenor_bucket, [
        Decimal(v) for v in ("0", "1", "1.0001", "3", "5", "5.1", "7", "10", "10.01")],
        "decimal(9,4)")
    names = [label for _, label in labels.TENOR_LIMITS] + [labels.LONGEST_TENOR]
    assert got == [names[i] for i in (0, 0, 1, 1, 2, 3, 3, 4, 5)]
    assert values(spark, labels.tenor_bucket, [None], "decimal(9,4)") == [labels.MISSING]


def test_strategy(spark):
    got = values(spark, labels.strategy_label, ["0", "4", None, "", "None", "1", "11"])
    assert got == [labels.NORMAL] * 5 + [labels.STRATEGY] * 2


def test_category_class_rating(spark):
    assert values(spark, labels.bond_category, ["国债", "超短期融资券", "金融债", None]) == [
        "国债", "短期融资券(包含超短融)", "其他", "其他"]
    assert values(spark, labels.bond_class, ["国债", "政策性金融债", "同业存单", "x"]) == [
        "利率债", "利率债", "同业存单", "信用债"]
    assert values(spark, labels.rating_bucket, ["AAA", "AA+", "A-1+", "AA＋", "AA-"]) == [
        "AAA", "AA+", "AA+", "AA+", "AA及以下"]


def test_weighted_average(spark):
    df = spark.createDataFrame(
        [("a", Decimal("1.5"), Decimal("10"), True), ("a", Decimal("3"), Decimal("30"), False),
         ("z", Decimal("2"), Decimal("0"), True)],
        "k string, x decimal(9,4), w decimal(18,2), c boolean")
    got = df.groupBy("k").agg(
        measures.weighted_average(F.col("x"), F.col("w")).alias("a"),
        measures.weighted_average(F.col("x"), F.col("w"), F.col("c")).alias("b"),
        measures.weighted_average(F.col("x"), F.col("w"), ~F.col("c")).alias("d"))
    rows = {r.k: (r.a, r.b, r.d) for r in got.collect()}
    assert rows["a"] == (Decimal("2.625"), Decimal("1.5"), Decimal("3"))
    assert rows["z"] == (None, None, None)


def test_halves_round_up(spark):
    got = spark.range(1).select(measures.ratio(F.lit(1), F.lit(2048)), measures.ratio(F.lit(-1), F.lit(2048)))
    assert tuple(got.first()) == (Decimal("0.0004882813"), Decimal("-0.0004882813"))


def test_small_ratios_are_not_zero(spark):
    got = spark.range(1).select(measures.ratio(F.lit(50), F.lit(1_000_000_000)))
    assert got.first()[0] == Decimal("0.0000000500")


def test_dates(spark):
    got = values(spark, lambda c: text.parse_date(c, "yyyy/M/d"),
                 ["2018/07/05", "2018/7/5", "2018/13/01", "x", ""])
    assert got == [date(2018, 7, 5), date(2018, 7, 5), None, None, None]


def test_lines_and_words(spark):
    assert values(spark, text.lines_of, ["a\nb", "a\r\nb\n", "a\rb", "\n", "a\n\nb"]) == [
        ["a", "b"], ["a", "b"], ["a", "b"], [""], ["a", "", "b"]]
    assert values(spark, text.words_of, ["a b", "a  b ", "", " a"]) == [
        ["a", "b"], ["a", "", "b"], [""], ["", "a"]]
    assert values(spark, text.has_words, ["a", "", "  "]) == [True, True, False]


def test_text_lines(spark):
    documents = spark.createDataFrame([("a b\n\n  \nc",), ("",), (None,)], "text string")
    lines = words.text_lines(documents)
    assert [r.value for r in lines.collect()] == ["a b", "", "  ", "c"]
    assert {r.word: r.n for r in words.word_count(lines).collect()} == {"a": 1, "b": 1, "": 1, "c": 1}
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_word_count(spark):
    lines = spark.createDataFrame(
        [("this is a test",), ("how are you",), ("do you love me",), ("can you tell me",)], "value string")
    got = {r.word: r.n for r in words.word_count(lines).collect()}
    assert got["you"] == 3 and got["me"] == 2 and sum(got.values()) == 15
    as_text = {r.value for r in words.as_text(words.word_count(lines)).collect()}
    assert "(you,3)" in as_text


def test_events(spark):
    lines = spark.createDataFrame([("u,new_tweet,7",), ("v,login,8",)], "value string")
    got = [r.value for r in words.expand_events(lines, "new_tweet").collect()]
    assert got == ["u login 7", "u login 7", "v,login,8"]
    assert tuple(words.expansion_counts(lines, "new_tweet").first()) == (2, 3)
    assert tuple(words.expansion_counts(lines.limit(0), "new_tweet").first()) == (0, 0)


def test_join_types(spark):
    assert values(spark, expansion.join_types, ["own", "product", "fund"]) == [
        ["总额", "自营"], ["总额", "产品"], ["总额", "产品", "货币市场基金"]]
