r"""Parametric market report over a trade file.

    spark-submit --py-files ledgerloom.zip ledgerloom/jobs/market_job.py <trades> <result> \
        2018/07/18 2018/07/23 --org null --player-type 全部 --bond-type 全部
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.functions.labels import ALL_VALUES
from ledgerloom.functions.text import parse_date, parse_decimal
from ledgerloom.jobs import common
from ledgerloom.plans import market
from ledgerloom.session import tune
from ledgerloom.sources.feeds import read_lines, split_record
from ledgerloom.sources.layouts import TRADE_COLUMNS
from ledgerloom.sources.loaders import MONEY, SLASHED


def trades(lines: DataFrame) -> DataFrame:
    """Typed trades; lines without a date are dropped."""
    records = split_record(lines, TRADE_COLUMNS)
    typed = records.withColumns({
        "deal_dt": parse_date(F.col("deal_dt"), SLASHED),
        "amount": parse_decimal(F.col("amount"), *MONEY),
    })
    return typed.where(F.col("deal_dt").isNotNull())


def run(spark: SparkSession, path: str, output: str, query: market.MarketQuery) -> None:
    lines = read_lines(spark, path)
    tune(spark, lines)
    records = trades(lines)
    results = {
        "summary": market.market_report(records, query),
        "comparison_days": market.comparison_days(records, query),
        "preview": market.preview(records, query),
    }
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{output.rstrip('/')}/{name}")


def main() -> None:
    parser = common.parser(__doc__)
    parser.add_argument("begin")
    parser.add_argument("end")
    parser.add_argument("--org", default="")
    parser.add_argument("--player-type", default=ALL_VALUES)
    parser.add_argument("--bond-type", default=ALL_VALUES)
    args = parser.parse_args()
    begin, end = (datetime.strptime(text, "%Y/%m/%d").date() for text in (args.begin, args.end))
    query = market.MarketQuery(
        begin, end, None if args.org == "null" else args.org, args.player_type, args.bond_type)
    run(common.session("market-report"), args.input, args.output, query)


if __name__ == "__main__":
    main()
