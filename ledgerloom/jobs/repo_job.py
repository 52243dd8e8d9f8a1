"""Pledged-repo job: feeds to the fourteen repo report tables.

    spark-submit --py-files ledgerloom.zip ledgerloom/jobs/repo_job.py <feeds> <reports>
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession

from ledgerloom.jobs import common
from ledgerloom.plans import counters, repo
from ledgerloom.sources import layouts, loaders

JOB = "repo_job"


def write_reports(this_run: common.Run, feed_folder: str) -> None:
    """Stage the feeds and write the fourteen reports; the run publishes them."""
    inputs = loaders.repo_inputs(this_run.feeds(feed_folder, layouts.REPO_JOB_FEEDS, JOB))
    watch = this_run.watch()
    if watch:
        inputs = counters.watch_repo(inputs, watch)
    inputs = this_run.stage_inputs(inputs, JOB, "bonds", "members")
    profiled = inputs
    if watch:
        profiled = replace(inputs, members=counters.watch_profiles(inputs.members, inputs, watch))
    inputs = replace(inputs, profiles=this_run.stage(repo.member_profiles(profiled), f"{JOB}/profiles"))
    confirmed = repo.confirmed_deals(inputs)
    if watch:
        confirmed = counters.watch_confirmed(confirmed, inputs, watch)
    deals = this_run.stage(
        repo.valid_deals(inputs, rating=True, bank_flag=True, line_count=True, confirmed=confirmed), f"{JOB}/deals")
    pledged = repo.pledged_deals(deals)
    this_run.write(repo.FROM_DEALS, deals, inputs)
    this_run.write(repo.FROM_PLEDGED_DEALS, pledged, inputs)
    this_run.write_routed(repo.FROM_PLEDGED_LEGS, repo.PLEDGED_SETS, repo.PLEDGED_MEASURES,
                          repo.pledged_sets(pledged), inputs, f"{JOB}/deal_sets")
    # the fan-out is read once and never stored: six reports get its sums in one pass
    lined = counters.watch_collateral(inputs, watch) if watch else inputs
    this_run.write_routed(repo.FROM_LINE_LEGS, repo.LINE_SETS, repo.LINE_MEASURES,
                          repo.line_sets(repo.collateral_lines(deals, lined)), inputs, f"{JOB}/line_sets")
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
    run(common.session("repo-reports"), args.input, args.output, args.upsert, args.counts)


if __name__ == "__main__":
    main()
