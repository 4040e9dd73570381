import math

import numpy as np
import pytest

from wardlake.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, row string, x int"


def brute(rows):
    x = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    fit = sorted({tuple(v) for _, v in x})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[c - t / n for c, t in zip(v, s)] for v in fit])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    return x, n, s, e[::-1], u.T[::-1]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "r", 1) for i, v in rows], SCHEMA).repartition(5)


def test_whitening_equals_eigh_of_the_distinct_vectors(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(150, 24)) * np.linspace(3, 0.2, 24) + 5
    rows = [(i, v.tolist()) for i, v in enumerate(base)] + [(500 + i, base[0].tolist()) for i in range(150)]
    bad = [(900, None), (901, [1.0, None] + [0.0] * 22), (902, [float("nan")] * 24), (903, [float("inf")] * 24), (904, []), (905, [1.0])]
    x, n, s, e, u = brute(rows)
    out, w = whitening.whiten(frame(spark, rows + bad + [(None, base[1].tolist())]), components=16)
    assert w.n == n == 150 and w.sums == s and w.identity_error < 1e-10
    assert np.allclose(w.values, e[:16], rtol=1e-12)
    got = {r.row.vec_id: r for r in out.collect()}
    assert set(got) == {i for i, _ in rows} | {None} and got[0].row.asDict()["x"] == 1
    for i, v in x[::17]:
        assert int(got[i].deviation) == sum((n * c - t) ** 2 for c, t in zip(v, s))
        want = (u[:16] @ np.array([c - t / n for c, t in zip(v, s)])) / np.sqrt(e[:16])
        assert np.allclose(np.abs(got[i].whitened), np.abs(want), atol=1e-8)
    lines = whitening.by_component(out, w).where("row.vec_id = 3").orderBy("component").collect()
    assert [r.component for r in lines] == list(range(1, 17)) and lines[0].n == 150
    assert np.allclose([r.explained for r in lines], e[:16] / e.sum())


@pytest.mark.parametrize("values", [[5, 5, 5, 2, 2, 1], [1e6, 1, 1 - 1e-9, 1e-3, 1e-6, 0], [3, 0, 0, 0, 0, 0], [7] * 6, [1, 1 - 1e-15, 0.5, 0.25, 0, 0]])
def test_slicing_numbers_equal_and_close_eigenvalues(values):
    q = np.linalg.qr(np.random.default_rng(1).normal(size=(6, 6)))[0]
    v = (q * values) @ q.T
    v = (v + v.T) / 2
    e, u = whitening.leading(v, 6)
    real = [x for x in values if x > 1e-10 * sum(values)]
    assert len(e) == len(real) and np.allclose(e, real, rtol=1e-9, atol=1e-13 * max(values))
    assert np.abs(u @ u.T - np.eye(len(e))).max() < 1e-9
    assert np.abs(v @ u.T - u.T * e).max() < 1e-10 * max(values)


def test_counts_equal_the_spectrum():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 30):
        a = rng.normal(size=(n, n))
        a = a + a.T
        if n == 5:
            np.fill_diagonal(a, 0)      # needs pivots of two rows
        e = np.linalg.eigvalsh(a)
        for shift in [*(e + 1e-6), *(e - 1e-6), 0.0, 100.0, -100.0]:
            assert whitening.inertia(a - shift * np.eye(n)) == int((e > shift).sum())


def test_iteration_is_certified_on_a_larger_matrix():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(300, 96)) @ np.diag(np.geomspace(10, 0.1, 96))
    v = np.cov(a.T, bias=True)
    e, u = whitening.leading(v, 16)
    want = np.linalg.eigvalsh(v)[::-1][:16]
    assert np.allclose(e, want, rtol=1e-12) and np.abs(u @ u.T - np.eye(16)).max() < 1e-9


def test_whitening_edge_cases(spark):
    def run(rows, **kw):
        out, w = whitening.whiten(frame(spark, rows), **kw)
        return [r for r in whitening.by_component(out, w).collect()], w
    assert run([])[0] == [] and run([(1, None), (2, [])])[0] == []
    one, w = run([(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    assert one == [] and w.n == 1                       # a single distinct vector has no spread
    two, w = run([(1, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0]), (3, [1e30, 0.0, 0.0])])
    assert w.n == 2 and len(two) == 3 and sorted(round(abs(r.whitened), 9) for r in two) == [1, 1, 1]
    wide, w = run([(i, [float(i) * 1e9, float(i)]) for i in range(-3, 4)])     # held at the limit, no overflow
    assert w.n == 7 and len(wide) == 7 and w.identity_error < 1e-6     # beside it the other dimension is flat
    assert all(r.deviation > 0 for r in wide if r.row.vec_id)
