"""One scan of a feed: rows, rejects, counts, positions."""

from ledgerloom.sources import feeds, intake
from ledgerloom.sources.layouts import FeedLayout

LAYOUT = FeedLayout("t", "EV", ("k", "v"), required=("k",))


def take(spark, tmp_path, path, header=feeds.FIRST_LINE, layout=LAYOUT):
    return intake.taken_in(spark, str(path), layout, str(tmp_path / "staged"), header)


def test_counts_equal_rejects(spark, tmp_path):
    text = "k,v\n1,a\n,b\n2\n\n3,c,d\n4,EVER\n5,\n"
    (tmp_path / "in.csv").write_text(text)
    for header in (feeds.FIRST_LINE, feeds.TAG):
        got = intake.taken_in(spark, str(tmp_path / "in.csv"), LAYOUT, str(tmp_path / header), header)
        lines = feeds.read_lines(spark, str(tmp_path / "in.csv"), header)
        expected = {r.reason: r.n_lines for r in feeds.rejects(lines, LAYOUT, header=header).collect()}
        assert {k: v for k, v in got.counts.items() if v} == expected
        parsed = feeds.read_feed(spark, str(tmp_path / "in.csv"), LAYOUT, header)
        assert sorted(tuple(r)[:2] for r in got.rows.collect()) == sorted(tuple(r) for r in parsed.collect())
        assert got.rejects.count() == sum(expected.values()) - expected["kept"]


def test_place_of_a_reject(spark, tmp_path):
    (tmp_path / "in.csv").write_text("k,v\n1,a\nbad\n2,b\n")
    got = take(spark, tmp_path, tmp_path / "in.csv")
    (row,) = got.rejects.collect()
    assert (row.reason, row.line, row.split_start) == ("field count", "bad", 0)
    assert row.file.endswith("/in.csv")


def test_positions_follow_files_and_lines(spark, tmp_path):
    """Many small splits and several files, one of a name that a URI escapes."""
    folder = tmp_path / "feed"
    folder.mkdir()
    names = ["a.csv", "b 1.csv", "c.csv"]
    for f, name in enumerate(names):
        (folder / name).write_text("k,v\n" + "".join(f"{f}-{i},{'x' * (i % 50)}\n" for i in range(400)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        rows = take(spark, tmp_path, folder).rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    found = [r.k for r in rows.orderBy(intake.POSITION).collect()]
    assert found == [f"{f}-{i}" for f in range(3) for i in range(400)]
    assert rows.select(intake.POSITION).distinct().count() == 1200


def test_empty_feed(spark, tmp_path):
    (tmp_path / "in.csv").write_text("k,v\n")
    got = take(spark, tmp_path, tmp_path / "in.csv")
    assert got.rows.collect() == [] and got.rejects.collect() == [] and got.counts[feeds.KEPT] == 0
