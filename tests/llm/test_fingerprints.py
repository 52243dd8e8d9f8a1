import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import fingerprints as fp

DOCS = "doc_id long, text string, fingerprint string, tail int"


def phrases(text):
    seen, word = set(), ""
    for c in text:
        word += c
        if word not in seen:
            seen.add(word)
            word = ""
    return seen


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, other, after = (fp.decode(fp.fingerprint(t)) for t in (text, edited, following))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.encode(own), fp.encode(other),
                    fp.likeness(own, other), fp.likeness(own, after)))
    return out


def test_parse_by_hand():
    seen = set()
    assert fp.parse("aababcabcd", seen) == ""
    assert seen == {"a", "ab", "abc", "abcd"} == phrases("aababcabcd")


def test_report_is_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert sorted(map(tuple, fp.report(docs).collect())) == sorted(brute(rows))


def test_odd_rows(spark):
    rows = [(5, "äöü 😀 words"), (-2, None), (7, ""), (5, "äöü 😀 words"), (9, "x"), (11, "ab" * 3000), (12, "ab" * 3000)]
    docs = spark.createDataFrame([(i, t, "f", 1) for i, t in rows], DOCS)
    found = sorted(map(tuple, fp.report(docs).collect()))
    assert found == sorted(brute(rows))
    with_null = spark.createDataFrame([(None, "z", None, None), (3, "y", None, None)], DOCS)
    assert [r.doc_id for r in fp.report(with_null).orderBy("doc_id").collect()] == [None, 3]
    one = fp.report(spark.createDataFrame([(1, "abc", None, None)], DOCS)).first()
    assert one.near_next == 1.0
    assert fp.report(spark.createDataFrame([], DOCS)).collect() == []


def test_likeness_estimates_overlap():
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcdefgh "), 6000)) for _ in range(4)]
    for a in texts:
        for b in [texts[0][:3000] + texts[1][3000:], texts[2]]:
            x, y = phrases(a), phrases(b)
            true = len(x & y) / len(x | y)
            assert abs(fp.likeness(fp.decode(fp.fingerprint(a)), fp.decode(fp.fingerprint(b))) - true) < 0.12


def test_columns(spark):
    df = spark.createDataFrame([("same text", "same text"), (None, "")], "a string, b string")
    out = df.select(fp.likeness_column(fp.fingerprint_column("a"), fp.fingerprint_column("b")).alias("s")).collect()
    assert [r.s for r in out] == [1.0, 1.0]
