import random
from pathlib import Path

import numpy as np
import pytest

from ledgerloom.llm import common, near_dedup as nd

DOCS = "doc_id long, text string, source string, component_id string, node int"


def brute(docs, size, percent):
    sets = {}
    for i, text in docs:
        w = (text or "").lower().split()
        n = min(size, len(w))
        sets[i] = {tuple(w[p:p + n]) for p in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: (len(sets[i]), find(i)) for i in ids}


def frame(spark, docs):
    return spark.createDataFrame([(i, t, None, "x", 1) for i, t in docs], DOCS)


def corpus(seed, n):
    """Groups of edited copies of copies, so that many links miss a star's centre."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    docs = []
    for g in range(n):
        text = rng.choices(vocabulary, k=rng.choice([1, 2, 3, 8, 40, 120]))
        for _ in range(rng.choice([1, 2, 12])):
            copy = list(text)
            for _ in range(max(1, len(copy) // rng.choice([15, 20, 30, 60]))):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            docs.append(" ".join(copy).title() if rng.random() < 0.3 else " ".join(copy))
            if rng.random() < 0.5:
                text = copy
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("size, seed", [(2, 1), (5, 2)])
def test_brute_force(spark, size, seed):
    docs = corpus(seed, 40) + [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE")]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.groups(frame(spark, docs), shingle=size).collect()}
    assert found == brute(docs, size, 80)


def test_star_misses_are_found(spark):
    """A chain of copies in which only neighbours are similar."""
    chain = [f"t{i}" for i in range(200)]
    docs = [(i, " ".join(chain[4 * i:4 * i + 60])) for i in range(12)]
    found = {r.doc_id: r.component_id for r in nd.groups(frame(spark, docs), shingle=2).collect()}
    assert found == {i: c for i, (_, c) in brute(docs, 2, 80).items()}
    assert set(found.values()) == {0}


def test_family_fringe(spark, monkeypatch):
    """Many copies of one text around the threshold, so that buckets are large and unresolved."""
    monkeypatch.setattr(nd, "SMALL_BUCKET", 3)
    monkeypatch.setattr(nd, "BLOCK_MEMBERS", 7)
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(50)]
    base = rng.choices(vocabulary, k=90)
    docs = []
    for i in range(90):
        copy = list(base)
        for _ in range(rng.choice([2, 3, 4, 6])):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        docs.append((i, " ".join(copy)))
    truth = {i: c for i, (_, c) in brute(docs, 2, 80).items()}
    assert 3 < len(set(truth.values())) < 80
    assert {r.doc_id: r.component_id for r in nd.groups(frame(spark, docs), shingle=2).collect()} == truth


def test_removal(spark):
    text = " ".join(f"u{i}" for i in range(30))
    docs = frame(spark, [(5, text), (3, text), (3, text), (9, "alone"), (None, text), (None, None), (7, None), (8, "")])
    kept = nd.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id if r.doc_id is not None else -1), r.text or "") for r in kept.collect()) == [
        (-1, ""), (3, text), (7, ""), (8, ""), (9, "alone")]


@pytest.mark.parametrize("kind", ["int", "bigint", "string", "smallint", "decimal(20,0)"])
def test_removal_with_any_type_of_id(spark, kind):
    text = " ".join(f"u{i}" for i in range(30))
    docs = frame(spark, [(1, text), (2, text), (3, text), (4, "other words here")])
    docs = docs.withColumn("doc_id", docs["doc_id"].cast(kind))
    assert sorted(int(r.doc_id) for r in nd.deduplicated(docs).collect()) == [1, 4]


def test_unlike_texts_under_one_id_stay(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    near = a + " tail"
    docs = frame(spark, [(1, a), (1, b), (2, near), (2, b), (2, c), (None, c), (3, "")]).repartition(4)
    for partitions in (1, 4):
        kept = nd.deduplicated(docs.repartition(partitions))
        assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, a), (1, b), (2, c), (3, "")]


def test_columns_with_the_names_used_inside(spark):
    text = " ".join(f"u{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, 5, "x"), (1, text, 6, "y"), (2, "one", 7, "z")],
                                 "doc_id long, text string, _row int, component_id string")
    kept = nd.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_scratch_tables_are_removed(spark):
    shared = Path(common.shared_folder(spark).removeprefix("file:"))
    before = set(shared.glob("near-dedup-*"))
    nd.groups(frame(spark, [(1, "a b c"), (2, "a b c")])).collect()
    assert set(shared.glob("near-dedup-*")) == before


def test_repeated_ids_unite(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = nd.groups(frame(spark, [(1, a), (4, a), (4, b), (6, b)])).collect()
    assert {(r.doc_id, r.component_id) for r in rows} == {(1, 1), (4, 1), (6, 1)}


def test_empty(spark):
    assert nd.groups(frame(spark, [])).collect() == []
    assert nd.deduplicated(frame(spark, [])).collect() == []


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    signer = nd.Signer(nd.BINS, nd.BANDS)
    for size in (20, 400, 4000):
        rates = []
        for _ in range(60):
            x = rng.integers(0, 1 << 63, size + size // 4, dtype=np.uint64) * np.uint64(2)
            a, b = np.sort(x[:size]), np.sort(x[size // 4:])
            rates.append((signer.bins(a) == signer.bins(b)).mean())
        assert abs(np.mean(rates) - 0.6) < 0.05
