import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st

from ledgerloom.llm import fill_in_middle as fim

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, output string, form int"


def brute(doc_id, text):
    """The contract, over strings."""
    text = text or ""
    units = TOKEN.findall(text)
    n = len(units)
    shown = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(shown[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


ROWS = [
    (1, "one two three"), (2, ""), (3, None), (4, "  lead and tail \n\t"), (5, " \n "), (None, "no id here"), (None, None),
    (6, "héllo wörld 你好 世界 😀 end"), (7, "has <P> inside"), (8, "a<S>"), (9, "<M>"), (10, "x"), (10, "x"),
    (11, "< P> <<P <S >M> <M"), (12, "  nbsp is a word \x0b \x0c\x1f"), (13, "long words " * 100_000), (-7, "below zero ids"),
] + [(100 + i, f"document {i} with\nsome words <P and more> {'y' * i}") for i in range(60)]


def expected(rows):
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = [(i, *brute(i, t)[:4], sha(brute(i, t)[4]), sha(t or "")) for i, t in rows]
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    rows = [(i, t, "clash", 7) for i, t in ROWS]
    found = fim.report(spark.createDataFrame(rows, DOCS).repartition(3))
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == expected(ROWS)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_outputs_and_texts_travel(spark):
    docs = spark.createDataFrame([(i, t, "clash", 7) for i, t in ROWS], DOCS)
    out = fim.transformed(docs)
    rows = out.collect()
    assert sorted([(r.doc_id, r.output) for r in rows], key=str) == sorted([(i, brute(i, t)[4]) for i, t in ROWS], key=str)
    texts = {i: (t or "").encode() for i, t in ROWS if i is not None}
    for r in rows:
        if r.doc_id is not None:  # descriptors alone give the output
            buffers = {"text": texts[r.doc_id], "sentinels": fim.PieceTable.marks}
            assert b"".join(buffers[p.buffer][p.start:p.end] for p in r.pieces) == r.output.encode()
    back = fim.restored(out).collect()
    assert sorted([(r.doc_id, r.text) for r in back], key=str) == sorted([(i, t or "") for i, t in ROWS], key=str)


def test_other_id_types_and_empty_table(spark):
    texts = spark.createDataFrame([("17", "some words that are cut somewhere")], "doc_id string, text string")
    numbers = texts.selectExpr("cast(doc_id as int) doc_id", "text")
    assert [r[1:] for r in fim.report(texts).collect()] == [r[1:] for r in fim.report(numbers).collect()]
    assert fim.report(spark.createDataFrame([], DOCS)).collect() == []
    assert fim.restored(fim.transformed(spark.createDataFrame([], DOCS))).collect() == []


def test_percentages(spark):
    docs = spark.createDataFrame([(i, f"a b c {i}") for i in range(200)], "doc_id long, text string")
    forms = lambda **k: {r.form for r in fim.report(docs, **k).collect()}
    assert forms(arranged_percent=0) == {"plain"}
    assert forms(arranged_percent=100, spm_percent=100) == {"spm"}
    assert forms(arranged_percent=100, spm_percent=0) == {"psm"}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab <>PSM\n\té€😀"), max_size=60), st.integers(-5, 10_000))
def test_any_text(text, doc_id):
    n, form, prefix, middle, output = brute(doc_id, text)
    found = fim.arrange(str(doc_id), text.encode())
    assert (found.n, found.form, found.prefix_chars, found.middle_chars) == (n, form, prefix, middle)
    assert found.table.content().decode() == output
    assert fim.restore(output.encode(), form).content().decode() == text


def test_inverse_permutation():
    table = fim.PieceTable(b"abcdef").cut(1, 3).marked()
    assert [bytes(v) for v in table.stream()] == [b"a", b"bc", b"def", b"<P>", b"<S>", b"<M>"]
    for order in fim.ARRANGEMENTS.values():
        if len(order) == 6:
            assert table.arranged(order).put_back(order).pieces == table.pieces


@pytest.mark.parametrize("places", [(0,), (6,), (2, 2), (0, 6), (1, 4, 5)])
def test_cut_keeps_content(places):
    table = fim.PieceTable(b"abcdef").cut(*places)
    assert len(table.pieces) == len(places) + 1
    assert table.content() == b"abcdef"
    assert table.cut(3).content() == b"abcdef"
