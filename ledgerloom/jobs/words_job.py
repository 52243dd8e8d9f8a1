"""Word count of a text file or folder, written as text.

    spark-submit --py-files ledgerloom.zip ledgerloom/jobs/words_job.py <text> <result>
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerloom.jobs import common
from ledgerloom.plans import words
from ledgerloom.session import tune
from ledgerloom.sources.feeds import read_lines
from ledgerloom.sources.sinks import write_text


def run(spark: SparkSession, path: str, output: str) -> None:
    lines = read_lines(spark, path)
    tune(spark, lines)
    write_text(words.as_text(words.word_count(lines)), output)


def main() -> None:
    args = common.parser(__doc__).parse_args()
    run(common.session("word-count"), args.input, args.output)


if __name__ == "__main__":
    main()
