import random

import numpy as np
import pytest

from ledgerloom.llm import decontaminate as dc

DOCS = "doc_id long, text string, lang string, contamination string, n_words int"


def brute(docs, items, window=10):
    out = {}
    prepared = []
    for name, text in items:
        w = dc.words(text.encode()) if text else []
        n = min(window, len(w))
        prepared += [(name, tuple(w[p:p + n])) for p in range(len(w) - n + 1)] if w else []
    for doc_id, text in docs:
        w = dc.words(text.encode()) if text else []
        hit, names = set(), set()
        for name, win in prepared:
            for p in range(len(w) - len(win) + 1):
                if tuple(w[p:p + len(win)]) == win:
                    hit |= set(range(p, p + len(win)))
                    if name is not None:
                        names.add(str(name))
        out[doc_id] = (len(w), len(hit), sorted(names))
    return out


def run(spark, docs, items, **options):
    rows = spark.createDataFrame([(i, t, None, "x", 1) for i, t in docs], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dc.with_findings(rows, bench, **options).collect()
    return {r.doc_id: (r.contamination.n_words, sum(s.end - s.start for s in r.contamination.spans),
                       list(r.contamination["items"])) for r in found}


@pytest.mark.parametrize("options", [{}, {"shard_words": 40}, {"block_bytes": 200}])
def test_brute_force(spark, options):
    rng = random.Random(5)
    vocabulary = ["a", "b", "The", "é1", "zz", "q"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(3, items[5][1]), (None, "never seen words"), (99, None), (98, "a " * 30), (97, "a " * 30)]
    docs = []
    for i in range(30):
        w = rng.choices(vocabulary + ["x1", "x2"], k=rng.randrange(0, 60))
        if i % 3 == 0:
            p = rng.randrange(len(w) + 1)
            w[p:p] = items[rng.randrange(12)][1].split()
        docs.append((i, ", ".join(w) if i % 2 else " ".join(w)))
    docs += [(100, None), (101, ""), (102, "a " * 400), (103, "!!!"), (104, "NEVER-seen words")]
    assert run(spark, docs, items, **options) == brute(docs, items)


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(3)
    ids = np.r_[rng.integers(0, 3, 500), np.ones(60, int), np.zeros(90, int)]
    order = dc.suffix_array(ids, 40)

    def key(p):
        w = ids[p:p + 40].tolist()
        return w[:w.index(0)] if 0 in w else w

    keys = [key(p) for p in order]
    assert keys == sorted(keys)
    assert sorted(order) == np.flatnonzero(ids).tolist()


def test_removal_keeps_columns_and_repeats(spark):
    passage = "one two three four five six seven eight nine ten eleven"
    rows = spark.createDataFrame([(1, "x " + passage, None, "c", 7), (2, "clean text", "en", "c", 7),
                                  (2, "clean text", "en", "c", 7), (None, None, None, None, None)], DOCS)
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = dc.decontaminated(rows, bench)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 2]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.report(docs, bench).collect() == []
    one = spark.createDataFrame([(1, "a b", None, None, None)], DOCS)
    row = dc.report(one, bench).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)


def test_longest_match(spark):
    docs = spark.createDataFrame([(1, "p q a b c z"), (2, "a b c d e"), (3, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, "a b c d q")], "item_id long, text string")
    found = {r.position: (r.n_words, r.doc_id, r.doc_position) for r in
             dc.longest_matches(docs, bench).collect()}
    assert found[0] == (4, 2, 0)
    assert found[4] == (1, 1, 1)
