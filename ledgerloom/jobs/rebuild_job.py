"""Rebuild of all twenty-three report tables as one: readers see the old set or the new one.

    spark-submit --py-files ledgerloom.zip ledgerloom/jobs/rebuild_job.py <bond feeds> <repo feeds> <reports>
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ledgerloom.jobs import bond_job, common, repo_job


def run(spark: SparkSession, bond_feeds: str, repo_feeds: str, output: str, counts: bool = False) -> int:
    this_run = common.Run(spark, output, counts=counts)
    bond_job.write_reports(this_run, bond_feeds)
    repo_job.write_reports(this_run, repo_feeds)
    version = this_run.publish()
    this_run.close()
    return version


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    for name in ("bond_feeds", "repo_feeds", "output"):
        parser.add_argument(name)
    parser.add_argument("--counts", action="store_true")
    args = parser.parse_args()
    run(common.session("rebuild-reports"), args.bond_feeds, args.repo_feeds, args.output, args.counts)


if __name__ == "__main__":
    main()
