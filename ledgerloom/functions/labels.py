"""Label columns: business codes turned into report categories."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels and codes as they appear in the feeds and report tables.
MISSING = "None"
NORMAL = "正常"
STRATEGY = "策略性交易"
NORMAL_STRATEGY_CODES = ("0", "4", "None", "")
KEPT_BOND_CATEGORIES = ("国债", "政策性金融债", "同业存单", "地方政府债", "企业债", "中期票据")
SHORT_TERM_CATEGORIES = ("短期融资券", "超短期融资券")
SHORT_TERM_LABEL = "短期融资券(包含超短融)"
OTHER_CATEGORY = "其他"
RATE_BOND_CATEGORIES = ("国债", "政策性金融债")
RATE_BOND = "利率债"
INTERBANK_DEPOSIT = "同业存单"
CREDIT_BOND = "信用债"
TOP_RATING = "AAA"
AA_PLUS_CODES = ("AA+", "A-1+", "AA＋")
AA_PLUS = "AA+"
AA_AND_BELOW = "AA及以下"
TENOR_LIMITS = (
    (1, "一年以下(包括一年)"),
    (3, "一年至三年(包括三年)"),
    (5, "三年至五年(包括五年)"),
    (7, "五年至七年(包括七年)"),
    (10, "七年至十年(包括十年)"),
)
LONGEST_TENOR = "十年以上"
ALL_TENORS = "全部"
ALL_VALUES = "全部"
TOTAL = "总额"
OWN_ACCOUNT = "自营"
PRODUCT = "产品"
MONEY_FUND = "货币市场基金"
PLEDGED_REPO = "质押式回购"
ANONYMOUS_CLICK = "匿名点击"
REPORTED_PRODUCTS = ("R001", "R007", "R014")


def strategy_label(code: Column) -> Column:
    """Normal or strategy trade. A missing code is normal; an empty field is a missing code."""
    return F.when(code.isNull() | code.isin(*NORMAL_STRATEGY_CODES), NORMAL).otherwise(STRATEGY)


def bond_category(name: Column) -> Column:
    """Report category of the bond job."""
    return (
        F.when(name.isin(*KEPT_BOND_CATEGORIES), name)
        .when(name.isin(*SHORT_TERM_CATEGORIES), SHORT_TERM_LABEL)
        .otherwise(OTHER_CATEGORY)
    )


def bond_class(name: Column) -> Column:
    """Collateral class of the repo job."""
    return (
        F.when(name.isin(*RATE_BOND_CATEGORIES), RATE_BOND)
        .when(name == INTERBANK_DEPOSIT, INTERBANK_DEPOSIT)
        .otherwise(CREDIT_BOND)
    )


def rating_bucket(description: Column) -> Column:
    """Rating of the repo job in three buckets."""
    return (
        F.when(description == TOP_RATING, TOP_RATING)
        .when(description.isin(*AA_PLUS_CODES), AA_PLUS)
        .otherwise(AA_AND_BELOW)
    )


def tenor_bucket(years: Column) -> Column:
    """Years to maturity in six buckets; a bucket includes its upper limit."""
    bucket = F.when(years.isNull(), MISSING)
    for limit, label in TENOR_LIMITS:
        bucket = bucket.when(years <= limit, label)
    return bucket.otherwise(LONGEST_TENOR)
