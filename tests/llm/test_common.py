from pathlib import Path

from pyspark.sql import functions as F

from ledgerloom.llm import common


def test_scratch_is_removed(spark):
    scratch = common.Scratch(spark, "scratch")
    first, second = scratch.staged(spark.range(5), "a"), scratch.staged(spark.range(7), "b")
    assert (first.count(), second.count()) == (5, 7)
    folder = Path(scratch.folder.removeprefix("file:"))
    scratch.remove(first)
    assert [p.name for p in folder.iterdir()] == ["1-b"] and second.count() == 7
    scratch.remove()
    assert not folder.exists()


def test_staged_tables_lie_in_the_shared_folder(spark):
    staged = common.staged(spark.range(5), "numbers")
    assert staged.count() == 5
    assert all(common.shared_folder(spark).rstrip("/") in f for f in staged.inputFiles())


def test_word_count(spark):
    df = spark.createDataFrame([("a b\tc\n",), ("",), (None,), (" \x0b ",), ("é x",)], "text string")
    assert [r[0] for r in df.select(common.count_words(F.col("text"))).collect()] == [3, 0, 0, 0, 2]
