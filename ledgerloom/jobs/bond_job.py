"""Bond job: feeds to the nine bond report tables.

    spark-submit --py-files ledgerloom.zip ledgerloom/jobs/bond_job.py <feeds> <reports>
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession

from ledgerloom.jobs import common
from ledgerloom.plans import bond, counters
from ledgerloom.sources import layouts, loaders

JOB = "bond_job"


def write_reports(this_run: common.Run, feed_folder: str) -> None:
    """Stage the feeds and write the nine reports; the run publishes them."""
    inputs = loaders.bond_inputs(this_run.feeds(feed_folder, layouts.BOND_JOB_FEEDS, JOB))
    watch = this_run.watch()
    if watch:
        inputs = counters.watch_bond(inputs, watch)
    inputs = this_run.stage_inputs(inputs, JOB, "bonds", "members")
    rates = this_run.stage(bond.collateral_rate(inputs.repo_deals, inputs.collateral), f"{JOB}/rates")
    inputs = replace(inputs, rates=rates)
    clean = bond.clean_deals(inputs)
    if watch:
        clean = counters.watch_clean_deals(clean, inputs, watch)
    deals = this_run.stage(bond.with_strategy(clean, inputs), f"{JOB}/deals")
    held = this_run.stage(bond.positions(deals), f"{JOB}/positions")
    this_run.write(bond.FROM_DEALS, deals, inputs)
    this_run.write(bond.FROM_LABELLED_DEALS, deals, inputs)
    this_run.write(bond.FROM_POSITIONS, held, inputs)
    this_run.write(bond.FROM_YIELDS, bond.position_yields(deals), inputs)
    if watch:
        this_run.write_misses(JOB, watch)


def run(spark: SparkSession, feed_folder: str, output: str, upsert: bool = False,
        counts: bool = False) -> None:
    this_run = common.Run(spark, output, upsert, counts)
    write_reports(this_run, feed_folder)
    this_run.publish()
    this_run.close()


def main() -> None:
    args = common.report_parser(__doc__).parse_args()
    run(common.session("bond-reports"), args.input, args.output, args.upsert, args.counts)


if __name__ == "__main__":
    main()
