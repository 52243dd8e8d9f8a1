from fractions import Fraction

import numpy as np
import pytest

from ledgerloom.llm import whitening as wh

TABLE = "vec_id long, embedding array<float>, n int, whitened string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "clash") for i, v in rows], TABLE).repartition(3)


def brute(rows):
    """Exact covariance by fractions, and the float64 eigenvalues of it."""
    sound = [(i, [float(np.float32(c)) for c in v]) for i, v in rows
             if v and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in sound]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    v = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in x), n**3) for j in range(d)] for i in range(d)]
    deviation = {i: sum((n * r[k] - s[k]) ** 2 for k in range(d)) for (i, _), r in zip(sound, x)}
    return n, np.array([[float(c) for c in r] for r in v]), deviation, np.array(x), s


def collected(df):
    rows = df.collect()
    return rows, {(r.vec_id, r.component): r for r in rows}


def test_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, [0.1, 0.2, 0.4, 0.3, 0.9], 5).tolist()) for i in range(200)]
    rows[7] = (7, rows[6][1])
    bad = [(900, None), (901, []), (902, [1.0, None, 2.0, 3.0, 4.0]), (903, [float("nan")] * 5), (904, [1.0, float("inf"), 0.0, 0.0, 0.0]),
           (905, [1.0, 2.0])]
    n, v, deviation, x, s = brute(rows)
    found, by_key = collected(wh.report(frame(spark, rows + bad)))
    assert len(found) == n * 5 and {r.n for r in found} == {n}
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1], basis[:, ::-1]
    expected = ((x - np.array(s) / n) @ basis) / np.sqrt(values)
    for c in range(5):
        got = np.array([by_key[i, c + 1].whitened for i, _ in rows])
        assert min(np.abs(got - expected[:, c]).max(), np.abs(got + expected[:, c]).max()) < 1e-8
        assert by_key[0, c + 1].explained == pytest.approx(values[c] / v.trace(), rel=1e-10)
    assert {r.vec_id: r.deviation for r in found} == deviation
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-10


def test_arrays_agree_with_rows(spark):
    rng = np.random.default_rng(5)
    table = frame(spark, [(i, rng.normal(size=6).tolist()) for i in range(40)])
    _, by_key = collected(wh.report(table, 3))
    arrays = {r.vec_id: r.whitened for r in wh.whitened(table, wh.fit(table, 3)).collect()}
    assert {k: v.whitened for k, v in by_key.items()} == {(i, c + 1): w for i, a in arrays.items() for c, w in enumerate(a)}


def test_at_most_so_many_components(spark):
    rng = np.random.default_rng(4)
    found = wh.report(frame(spark, [(i, rng.normal(size=40).tolist()) for i in range(60)])).collect()
    assert {r.component for r in found} == set(range(1, 33))
    assert found[0].identity_error < 1e-9


def test_equal_eigenvalues_give_some_basis(spark):
    corners = [[float(a), float(b), float(c)] for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    found, by_key = collected(wh.report(frame(spark, list(enumerate(corners)))))
    assert found[0].identity_error < 1e-12
    assert all(r.explained == pytest.approx(1 / 3) for r in found)


def test_components_without_variance(spark):
    rows = [(i, [float(i), 2.0 * i, 5.0]) for i in range(10)]
    found, by_key = collected(wh.report(frame(spark, rows)))
    assert all(by_key[i, 1].whitened is not None and by_key[i, 2].whitened is None for i in range(10))
    assert by_key[0, 1].explained == pytest.approx(1) and by_key[0, 3].explained == 0
    assert found[0].identity_error < 1e-12
    one = wh.report(frame(spark, [(1, [0.5, 0.25])] * 2)).collect()
    assert len(one) == 4
    assert all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in one)


def test_empty_and_unsound_tables(spark):
    assert wh.report(frame(spark, [])).collect() == []
    assert wh.report(frame(spark, [(1, None), (2, []), (3, [None])])).collect() == []


def test_commonest_length_and_null_ids(spark):
    found = wh.report(frame(spark, [(None, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [3.0]), (3, [0.0])])).collect()
    assert {r.n for r in found} == {2} and {r.vec_id for r in found} == {None, 1}


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e9 * i, 3.0e38, -5e8 + i]) for i in range(5)]
    found = wh.report(frame(spark, rows)).collect()
    fitted = wh.fit(frame(spark, rows))
    assert fitted.n == 5 and len(found) == 15
    by_hand = [[min(int(np.floor(64 * float(np.float32(c)))), 1 << 40) for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*by_hand)]
    exact = {i: sum((5 * v[k] - sums[k]) ** 2 for k in range(3)) for i, v in enumerate(by_hand)}
    assert {r.vec_id: r.deviation for r in found} == {i: d if d < 1 << 63 else None for i, d in exact.items()}


def _orthogonal(size, rng):
    q = np.linalg.qr(rng.normal(size=(size, size)))[0].astype(wh.EXTENDED)
    for _ in range(4):
        q = q + q @ (np.eye(size, dtype=wh.EXTENDED) - q.T @ q) / 2
    return q


@pytest.mark.parametrize("values", [
    np.linspace(1, 2, 30),
    np.r_[np.full(10, 1.0), np.linspace(2, 3, 20)],
    np.r_[1 + 1e-9 * np.arange(10), 2 + 1e-12 * np.arange(10), np.linspace(3, 4, 10)],
    np.r_[1e-12 * np.arange(1, 16), np.geomspace(1e-8, 1, 15)],
    np.full(30, 7.0),
])
def test_eigenvectors_to_more_than_double(values):
    q = _orthogonal(30, np.random.default_rng(1))
    a = (q * values.astype(wh.EXTENDED)) @ q.T
    a = (a + a.T) / 2
    found, x = wh.eigen(a)
    noise = 200 * float(np.finfo(wh.EXTENDED).eps) * float(values.max())
    assert np.abs(x.T @ x - np.eye(30)).max() < noise / values.max()
    assert np.abs(a @ x - x * found).max() < noise
    assert np.abs(found - np.sort(values)[::-1]).max() < noise
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(wh.EXTENDED)
    assert np.abs(start.T @ start - np.eye(30)).max() > 1e-9  # where it began


def test_exact_products_of_any_size():
    for largest in (3, 1 << 20, 1 << 30, 1 << 41):
        x = np.random.default_rng(2).integers(-largest, largest, (50, 4))
        total = wh.WholeSum((4, 4))
        for block in wh.blocks(x):
            total.add(wh.products(block))
        own = x.astype(object)
        assert (total.result() == own.T @ own).all()
