import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import packing as pk

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, length int, ids string"


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def held(rows, texts, whole, window=2048):
    """Checks of the contract: every id once, offsets without gaps, right checksums; returns ids and windows."""
    ids = {i: whole(t) for i, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for doc_id, own in by_doc.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids[doc_id])) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(np.array(ids[doc_id][at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[doc_id])
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return sum(map(len, ids.values())), len(by_sequence)


TEXTS = {1: None, 2: "", 3: "a few words", 4: "long text " * 5000, 5: "héllo 你好 😀\n\n  end ", 6: "<|endoftext|> here",
         **{100 + i: "some words of a text " * (i % 37 + 1) for i in range(300)}}


def test_contract(spark, whole):
    docs = spark.createDataFrame([(i, t, 5, "clash") for i, t in TEXTS.items()], DOCS).repartition(5)
    found = pk.report(docs, TOKENIZER)
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    total, windows = held(found.collect(), TEXTS, whole)
    assert windows <= 1.01 * total / 2048 + 1


def test_whole_table(spark, sf_check, whole):
    docs = spark.read.parquet(f"{sf_check}/documents.parquet")
    total, windows = held(pk.report(docs, TOKENIZER).collect(), {r.doc_id: r.text for r in docs.collect()}, whole)
    assert windows <= 1.005 * total / 2048 + 1


def test_sequences_hold_the_ids(spark, whole):
    docs = spark.createDataFrame([(i, t) for i, t in TEXTS.items()], "doc_id long, text string").repartition(3)
    parts = pk.packed(docs, TOKENIZER, window=256)
    parts = parts.sparkSession.createDataFrame(parts.collect(), parts.schema)
    sequences = {r.sequence_id: r for r in pk.sequences(parts, TOKENIZER, window=256).collect()}
    found = defaultdict(dict)
    for r in parts.collect():
        found[r.doc_id][r.start] = sequences[r.sequence_id].ids[r.offset:r.offset + r.length]
        assert r.offset in sequences[r.sequence_id].begins
    for doc_id, text in TEXTS.items():
        assert sum((found[doc_id][k] for k in sorted(found[doc_id])), []) == whole(text)
    assert all(len(r.ids) == 256 and set(r.ids[r.n_tokens:]) <= {0} for r in sequences.values())


def test_repeats_nulls_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "one two"), (1, "one two"), (None, "three"), (None, None)], "doc_id long, text string")
    rows = pk.report(docs, TOKENIZER).collect()
    assert len(rows) == 4 and {r.sequence_id for r in rows} == {0}
    assert sorted(r.offset for r in rows)[0] == 0
    assert pk.report(spark.createDataFrame([], DOCS), TOKENIZER).collect() == []


def test_counts_joined_by_a_shuffle_too(spark, whole, monkeypatch):
    monkeypatch.setattr(pk, "BROADCAST_COUNTS", 0)
    docs = spark.createDataFrame([(i, t, 5, "clash") for i, t in TEXTS.items()], DOCS).repartition(5)
    held(pk.report(docs, TOKENIZER).collect(), TEXTS, whole)


# ------------------------------------------------------------------ plan

def laid_out(histogram, plan):
    """Every piece by number through the plan: windows are filled without overlap or gap."""
    used = np.zeros(plan.n_sequences * plan.window, bool)
    for length in np.flatnonzero(histogram):
        for at in plan.positions(np.full(histogram[length], length), np.arange(histogram[length])):
            assert not used[at:at + length].any()
            used[at:at + length] = True
    rows = used.reshape(plan.n_sequences, plan.window)
    assert (np.diff(rows.astype(int), axis=1) <= 0).all() and rows[:, 0].all()
    assert (~used).sum() == plan.padding


@pytest.mark.parametrize("seed", range(6))
def test_any_histogram_is_laid_out(seed):
    rng = np.random.default_rng(seed)
    window = int(rng.choice([8, 32, 100]))
    histogram = np.zeros(window + 1, int)
    some = rng.choice(np.arange(1, window + 1), min(window, 1 + 5 * seed), replace=False)
    histogram[some] = rng.integers(1, 200, len(some))
    plan = pk.plan(histogram, window, slack=seed % 3)
    laid_out(histogram, plan)
    assert plan.padding <= plan.n_sequences * (seed % 3) + window


def test_lonely_length_and_large_counts():
    for histogram in ({1500: 1000}, {1: 5000}, {2048: 7}, {1024: 4, 1023: 3}, {2047: 2, 1: 2}):
        counts = np.zeros(2049, int)
        counts[list(histogram)] = list(histogram.values())
        plan = pk.plan(counts)
        laid_out(counts, plan)
        assert plan.n_sequences == -(-(counts * np.arange(2049)).sum() // 2048)
    counts[1500], counts[548] = 10**12, 10**12 + 5
    assert pk.plan(counts).n_sequences == -(-(counts * np.arange(2049)).sum() // 2048) or pk.plan(counts).padding < 10**13


def test_combinations_by_hand():
    lengths = np.array([1, 2, 3, 4, 6])
    found = {tuple(sorted(lengths[c[c < 5]].tolist())) for c in pk.combinations(lengths, 8)}
    assert found == {(4, 4), (2, 6), (1, 1, 6), (1, 3, 4), (2, 2, 4), (2, 3, 3)}
    assert len(pk.combinations(lengths, 8)) == 6


@pytest.mark.parametrize("seed", range(4))
def test_repeat_counts_are_least_squares(seed):
    """No counts >= 0 come nearer: projected gradients from there do not gain."""
    rng = np.random.default_rng(seed)
    lengths = np.sort(rng.choice(np.arange(1, 63), 30, replace=False))
    columns = pk.combinations(lengths, 64)
    a = np.zeros((len(lengths) + 1, len(columns)))
    np.add.at(a, (columns.T, np.arange(len(columns))), 1)
    a, h = a[:-1], rng.integers(0, 100, len(lengths)).astype(float)
    x = pk.repeat_counts(columns, h)
    error = ((a @ x - h) ** 2).sum()
    y, step = x.copy(), 1 / np.linalg.norm(a, 2) ** 2
    for _ in range(20_000):
        y = np.maximum(0, y - step * (a.T @ (a @ y - h)))
    assert (x >= 0).all()
    assert error <= ((a @ y - h) ** 2).sum() * (1 + 1e-3) + 1e-3 * (h @ h) / len(h)
    assert (x > 0).sum() <= len(lengths) + 5


def test_most_pieces_lie_in_combinations():
    rng = np.random.default_rng(0)
    histogram = np.bincount(np.clip(rng.lognormal(5.5, 1, 200_000).astype(int), 1, 2048), minlength=2049)
    lengths = np.flatnonzero(histogram[:2048])
    columns = pk.combinations(lengths, 2048)
    x = np.round(pk.repeat_counts(columns, histogram[lengths]))
    taken = np.minimum(pk._times(columns, x, len(lengths)), histogram[lengths])
    assert (taken * lengths).sum() > 0.4 * (histogram[lengths] * lengths).sum()
