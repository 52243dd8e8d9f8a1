import random

from pyspark.sql import functions as F

from ledgerloom.sources import feeds, layouts
from ledgerloom.sources.layouts import FeedLayout


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def fields(spark, line):
    return lines(spark, line).select(feeds.split_fields(F.col("value"))).first()[0]


def test_split_edge_rows(spark):
    assert fields(spark, 'a,"b, x",3') == ["a", "b, x", "3"]
    assert fields(spark, "a,,") == ["a", "", ""]
    assert fields(spark, ",b") == ["", "b"]
    assert fields(spark, '"x", "",  " z "') == ["x", "", "z"]
    assert fields(spark, '"a""b",q') == ['a""b', "q"]
    assert fields(spark, '"p"zz,q') == ["p", "q"]
    assert fields(spark, 'w,"u" ,2') == ["w", "u", "2"]
    assert fields(spark, '"one, ""two"", three",x') == ['one, ""two"", three', "x"]
    assert fields(spark, " a\t, b \r") == ["a", "b"]
    assert fields(spark, '"",""') == ["", ""]
    assert fields(spark, "x") == ["x"]


def test_split_sample_line(spark):
    line = '" a","32.23fsd,32232", "adfb,\'"", ","",  "中国人民银行",  "2018/12/7",12'
    assert fields(spark, line) == [
        "a", "32.23fsd,32232", "adfb,'\"\",", "", "中国人民银行", "2018/12/7", "12"]


def test_long_field_needs_no_deep_recursion(spark):
    long = "字," * 200_000
    assert fields(spark, f'"{long}",2') == [long, "2"]
    quotes = '""x' * 100_000
    assert fields(spark, f'"{quotes}",2') == [quotes, "2"]


def test_unclosed_quote_takes_the_rest_of_the_line(spark):
    assert fields(spark, 'a,"b,c') == ["a", "b,c"]


LAYOUT = FeedLayout("t", "EV", ("a", "b", "c"), required=("a",))


def test_bad_lines_are_dropped(spark):
    got = feeds.parse_feed(lines(
        spark, "EV_ID,B,C", "", "1,2,3", "1,2", "1,2,3,4", "7,EVERBRIGHT,9", ",2,3", "5,,"), LAYOUT)
    assert [tuple(r) for r in got.collect()] == [("1", "2", "3"), ("5", "", "")]


def test_short_rows_without_exact_arity(spark):
    layout = FeedLayout("t", "DPS", ("k", "v"), required=("k",), exact_arity=False)
    got = feeds.parse_feed(lines(spark, "1", "2,4", "3,,9", ",4"), layout)
    assert [tuple(r) for r in got.collect()] == [("1", ""), ("2", "4"), ("3", "")]


def test_line_is_split_once(spark):
    df = feeds.parse_feed(lines(spark, "1,2,3"), LAYOUT)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_read_feed_from_files(spark, tmp_path):
    (tmp_path / "org.csv").write_text('"ORG name",key\n"A, Ltd",1\nB , 2\n\nbad\n', encoding="utf-8")
    got = feeds.read_feed(spark, str(tmp_path / "org.csv"), layouts.BOND_ORG)
    assert sorted(tuple(r) for r in got.collect()) == [("A, Ltd", "1"), ("B", "2")]


def test_split_record(spark):
    got = feeds.split_record(lines(spark, "a,b,,", "x"), ("p", "q", "r")).collect()
    assert [tuple(r) for r in got] == [("a", "b", ""), ("x", None, None)]


def test_quoted_lines_round_trip(spark):
    """Random fields, written with and without quotes, come back as they were."""
    chooser = random.Random(7)
    alphabet = ["a", "债", "1", " ", ",", '""', "x y"]
    rows, texts = [], []
    for _ in range(3000):
        row = ["".join(chooser.choices(alphabet, k=chooser.randint(0, 6))).strip() for _ in range(4)]
        written = []
        for value in row:
            plain = "," not in value and '"' not in value
            written.append(value if plain and chooser.random() < 0.5 else f'"{value}"')
        rows.append(row)
        texts.append(chooser.choice([",", ", ", " ,"]).join(written) + chooser.choice(["", " "]))
    numbered = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    got = dict(map(tuple, numbered.select("n", feeds.split_fields(F.col("value"))).collect()))
    wrong = [(texts[i], row, got[i]) for i, row in enumerate(rows) if got[i] != row]
    assert not wrong, wrong[:3]


def test_data_line_with_the_tag_is_kept(spark, tmp_path):
    text = "bond_id,x\nB1,BONDCO Ltd\nB2,\\ back \"quoted, BOND\"\n\n\tB3 , x \n"
    (tmp_path / "a").mkdir()
    for name in ("one.csv", "two.csv"):
        (tmp_path / "a" / name).write_text(text.replace("B", name[0].upper()), encoding="utf-8")
    layout = FeedLayout("f", "BOND", ("key", "name"))
    first = feeds.read_feed(spark, str(tmp_path / "a"), layout)
    found = sorted(tuple(r) for r in first.collect())
    assert ("O1", "OONDCO Ltd") in found and ("T3", "x") in found and len(found) == 6
    tagged = feeds.parse_feed(lines(spark, "BOND,h", "B1,BONDCO Ltd", "B2,x"), layout, header=feeds.TAG)
    assert [tuple(r) for r in tagged.collect()] == [("B2", "x")]


def test_rejects_are_counted(spark):
    layout = FeedLayout("f", "TAG", ("a", "b"), ("a",))
    given = lines(spark, "TAG,x", "", "1,2,3", ",2", "1,2", '"1, 1",2')
    counts = {r.reason: r.n_lines for r in feeds.rejects(given, layout).collect()}
    assert counts == {"header tag": 1, "empty line": 1, "field count": 1, "empty field": 1, "kept": 2}
    assert feeds.parse_feed(given, layout).count() == counts["kept"]
    by_line = {r.reason: r.n_lines for r in feeds.rejects(given, layout, header=feeds.FIRST_LINE).collect()}
    assert by_line == {"empty line": 1, "field count": 1, "empty field": 1, "kept": 3}
