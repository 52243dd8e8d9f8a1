import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import pii, spans as sp

DOCS = "doc_id long, text string, base string, kind int"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def good(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        return 16 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 8 <= len(d) <= 15
    return True


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if good(k, m.group())]


def card(rng, n=16):
    d = [rng.randrange(10) for _ in range(n - 1)]
    return next(s for c in range(10) if luhn(s := "4" + "".join(map(str, d[1:])) + str(c)))


def texts(seed):
    rng = random.Random(seed)
    bits = ["a@b.c", "x.y+z@mail-1.example.com", "a@b.com_x@d.org", "@", "a@", "@b.c", "a@b", "a@b..c", "1.2.3.4", "256.1.1.1",
            "0001.02.3.255", "1.2.3.4.5.6.7.8", "999.1.1.1.1", "+1 (375) 555-4393", "+49 30 1234", "+1", "++12 345 678 90",
            "+1((((", "4111 1111 1111 1111", "4111-1111-1111-1112", "12  34", "1-2-3", "5", "é", "😀", "ß", " ", "  ", "\n", ".",
            "-", "word", "(", ")", "%", "+", "00", "7"]
    out = ["".join(rng.choice(bits) + rng.choice(["", " ", "é ", "😀"]) for _ in range(rng.randrange(25))) for _ in range(300)]
    out += [f"pay {card(rng, n)} now" for n in (15, 16, 17, 18, 19, 20) for _ in range(3)]
    out += ["".join(rng.choices("a@.1+-% ", k=40)) for _ in range(400)]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_base_spans(spark, seed):
    rows = [(i, t, "b", 1) for i, t in enumerate(texts(seed))] + [(9000, None, None, None), (9001, "", None, None)]
    found = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(found) == len(rows)
    for i, text, *_ in rows:
        base = brute(text)
        row, joined = found[i], ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text
        for kind in PATTERNS:
            assert row[f"n_{kind}"] == sum(k == kind for k, _, _ in base)
        everything = row.spans.split(",") if row.spans else []
        assert set(joined.split(",")) - {""} <= set(everything)
        assert len(everything) == len(base) + row.n_added


def test_long_texts_take_linear_time(spark):
    rows = [(1, "a" * 200_000, "", 0), (2, "1" * 100_000, "", 0), (3, "a.b" * 60_000 + "@", "", 0),
            (4, "a@" + "b." * 60_000, "", 0), (5, "+1" + "(" * 100_000, "", 0), (6, "1.2.3.4 " * 3000, "", 0)]
    found = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, DOCS)).collect()}
    assert found[4].n_email == 1 and found[6].n_ip == 3000
    assert found[6].spans.endswith(f"ip:{8 * 2999}:{8 * 2999 + 7}")


def test_places(spark):
    text = "é" + "ab " * 700 + "😀ab"
    df = spark.createDataFrame([(text,), ("",), ("ab",)], "text string")
    out = [r.s for r in df.select(sp.spans(F.col("text"), "ab").alias("s")).collect()]
    assert [(x.start, x.end) for x in out[0]] == [m.span() for m in re.finditer("ab", text)]
    assert out[1] == [] and out[2][0].end == 2


def test_added_spans(spark):
    rng = random.Random(3)
    rows = [(i, f"please call phone ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)} today or mail "
                f"ann{i}@mail.example.com soon", None, None) for i in range(60)]
    rows += [(100 + i, f"order no {rng.randrange(100, 199)}-{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}x shipped", None, None)
             for i in range(60)]
    rows += [(200 + i, f"call +1 (375) 555-{1000 + i} now", None, None) for i in range(60)]
    found = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, DOCS)).collect()}
    assert sum(found[i].n_added for i in range(60)) == 60
    assert sum(found[100 + i].n_added for i in range(60)) == 0
    assert sum(found[200 + i].n_added for i in range(60)) == 0


def test_reliabilities_are_learned():
    """Two labelers that agree outvote one that votes at random."""
    rng = random.Random(5)
    counts = {}
    for _ in range(4000):
        truth = rng.random() < 0.5
        said = lambda rate: 1 if (rng.random() < rate) == truth else -1
        votes = (said(0.95), said(0.9), said(0.5), 0, said(0.9))
        counts[0, votes] = counts.get((0, votes), 0) + 1
    shares = pii.estimate([(k, v, n) for (k, v), n in counts.items()])
    assert shares[0, (1, 1, -1, 0, 1)] > 0.95 and shares[0, (-1, -1, 1, 0, -1)] < 0.05


def test_empty(spark):
    assert pii.report(spark.createDataFrame([], DOCS)).collect() == []


def test_many_added_spans_take_time_in_proportion(spark):
    """100,000 added spans in one text; all are found, each once."""
    number = "call 555-123-4567 now "
    docs = spark.createDataFrame([(1, number * 100_000), (2, number * 3)] , "doc_id long, text string")
    began = time.perf_counter()
    found = {r.doc_id: r for r in pii.report(docs).select("doc_id", "n_added", F.length("spans").alias("n")).collect()}
    taken = time.perf_counter() - began
    if found[2].n_added == 3:  # the classifier decides alike on equal spans
        assert found[1].n_added == 100_000
    assert taken < 60


def test_added_spans_equal_a_look_at_all_pairs(spark, monkeypatch):
    """Overlaps across kinds and patterns, against the definition: of overlapping ones the first stays."""
    monkeypatch.setattr(pii, "ACCEPT", 0.0)  # every candidate that is not a base span is accepted
    rng = random.Random(5)
    parts = ["555-123-4567", "(555) 123 4567", "4111 1111 1111 1111", "12 34 56 78 90", "+1 555 123 4567", "+1", "1.2.3.4", "999.1.2.3",
             "a.b@c.de", "a (at) b.de", "x [at] 10.1.1.1.com", "1:2:3:4:5:6:7:8", " ", "-", ".", "55", " tel ", "\u20ac"]
    docs = spark.createDataFrame(
        [(i, "".join(rng.choice(parts) for _ in range(rng.choice([3, 12, 60, 200])))) for i in range(150)], "doc_id long, text string")
    rated = {r.doc_id: r["_candidates"] for r in pii.candidates(docs).collect()}
    added = 0
    for row in pii.with_spans(docs).collect():
        meets = lambda a, b: a[1] < b[2] and b[1] < a[2]
        base = [(c.kind, c.start, c.end) for c in rated[row.doc_id] if c.base]
        more = sorted((c.kind, c.start, c.end) for c in rated[row.doc_id] if not c.base)
        free = [x for i, x in enumerate(more) if not any(meets(x, b) for b in base) and not any(meets(x, y) for y in more[:i])]
        assert [tuple(x) for x in row.base] == base
        assert [tuple(x) for x in row.added] == free
        added += len(free)
    assert added > 200
