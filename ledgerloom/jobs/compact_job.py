"""Fold late rows into the report tables and remove what no kept version names.

    spark-submit --py-files ledgerloom.zip ledgerloom/jobs/compact_job.py <reports> [--deltas 8] [--keep 2]
"""

from __future__ import annotations

import argparse

from ledgerloom.jobs import common
from ledgerloom.sources.store import Store


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("reports")
    parser.add_argument("--deltas", type=int, default=8, help="compact tables with so many deltas or more")
    parser.add_argument("--keep", type=int, default=2, help="versions to keep for readers that are at work")
    args = parser.parse_args()
    store = Store(common.session("compact-reports"), args.reports)
    store.compact(args.deltas)
    store.vacuum(args.keep)


if __name__ == "__main__":
    main()
