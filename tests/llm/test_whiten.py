"""Operator 12 against a dense eigensolver, and the parts of the contour method."""

import numpy as np
import pytest

from tidewater.llm import feast, whiten

SCHEMA = "vec_id long, embedding array<float>, component int"


def symmetric(rng, values):
    q = np.linalg.qr(rng.standard_normal((len(values), len(values))))[0]
    a = q @ np.diag(values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.linspace(1, 5, 40), [3.0] * 12 + [1.0] * 5, [2.0, *[1 + 1e-13 * i for i in range(12)]], [4.0, 0, 0, 0], [0.0] * 3, [1.0],
    10.0 ** np.arange(-6, 6), [-3.0, -1, 0, 2, 5]])
def test_contour_finds_every_pair(values):
    a = symmetric(np.random.default_rng(3), np.array(values, float))
    found = feast.intervals(a, min(8, len(a)))
    value, vector = feast.polish(a, np.hstack([feast.solve(a, x)[1] for x in found]))
    exact = np.linalg.eigvalsh(a)[::-1]
    scale = max(1e-300, np.abs(exact).max())
    assert len(value) == sum(x.count for x in found) >= min(8, len(a))
    assert np.abs(value - exact[: len(value)]).max() <= 1e-13 * scale
    assert np.abs(vector.T @ vector - np.eye(len(value))).max() < 1e-13
    assert np.abs(a @ vector - vector * value).max() <= 1e-13 * scale


def test_inertia_counts():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 30):
        a = rng.standard_normal((n, n))
        a = a + a.T
        exact = np.linalg.eigvalsh(a)
        for s in rng.uniform(exact[0] - 1, exact[-1] + 1, 20):
            assert feast.count_above(a, s) == (exact > s).sum()
    assert feast.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # no pivot on the diagonal


def test_an_interval_that_misses_one_is_refused():
    a = np.diag([1.0, 2.0, 3.0])
    with pytest.raises(ArithmeticError):
        feast.solve(a, feast.Interval(1.5, 3.5, 3))


def check(got, x, wanted=32):
    """``got`` rows against integers x (rows by id), in exact and double arithmetic."""
    ids = list(range(len(x)))
    n, s = len(x), x.sum(axis=0)
    centred = x - s / n
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = int((e[:wanted] > 1e-9 * e[0]).sum())
    table = {(r.vec_id, r.component): r for r in got}
    assert len(table) == len(got) == n * k
    white = np.array([[table[i, c].whitened for c in range(1, k + 1)] for i in ids])
    want = centred @ u[:, :k] / np.sqrt(e[:k])
    sign = np.sign((white * want).sum(axis=0))
    assert np.abs(white - want * sign).max() < 1e-6
    assert {r.n for r in got} == {n}
    for i in ids:
        assert table[i, 1].deviation == sum((n * int(p) - int(q)) ** 2 for p, q in zip(x[i], s, strict=True))
    explained = np.array([table[0, c].explained for c in range(1, k + 1)])
    assert np.abs(explained / (e[:k] / e.sum()) - 1).max() < 1e-6
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-6


def test_whitening_against_dense_solver(spark):
    rng = np.random.default_rng(1)
    c = (rng.standard_normal((300, 40)) * np.linspace(0.2, 3, 40)).astype(np.float32)
    rows = [(i, v.tolist(), 7) for i, v in enumerate(c)]
    bad = [(900, None, 1), (901, [1.0, None], 1), (902, [float("nan")] * 40, 1), (903, [float("inf")] * 40, 1)]
    got = whiten.whiten(spark.createDataFrame(rows + bad, SCHEMA).repartition(4)).collect()
    check(got, np.floor(64 * c.astype(float)).astype(np.int64) + 1_000_000)


def test_repeated_missing_and_short_rows(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [3.0], 0), (4, [0.5, -1.0], 0), (5, [], 0)]
    got = whiten.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.vec_id is None, r.vec_id, r.component) for r in got if r.vec_id) == [
        (False, 1, 1), (False, 1, 1), (False, 1, 2), (False, 1, 2), (False, 4, 1), (False, 4, 2), (False, 5, 1), (False, 5, 2)]
    assert sum(r.vec_id is None for r in got) == 2 and {r.n for r in got} == {5}
    x = np.array([[64, 128], [64, 128], [192, 0], [32, -64], [0, 0]])
    want = ((5 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert {r.deviation for r in got if r.vec_id is None} == {want[2]} and {r.deviation for r in got if r.vec_id == 5} == {want[4]}


def test_nothing_to_whiten(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for frame in (empty, spark.createDataFrame([(1, None, 0)], SCHEMA), spark.createDataFrame([(1, [], 0)], SCHEMA),
                  spark.createDataFrame([(1, [1.0, 2.0], 0)] * 3, SCHEMA)):
        got = whiten.whiten(frame)
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert got.count() == 0


def test_rank_and_large_entries(spark):
    """Two of three dimensions are equal; one is far from zero."""
    rng = np.random.default_rng(2)
    c = rng.integers(-500, 500, (50, 3)) / 64
    c[:, 1] = c[:, 0]
    c[:, 2] += 2.0**20
    schema = SCHEMA.replace("float", "double")
    got = whiten.whiten(spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(c)], schema)).collect()
    check(got, np.floor(64 * c).astype(np.int64))
    assert max(r.component for r in got) == 2
    with pytest.raises(Exception, match="after scaling"):
        whiten.whiten(spark.createDataFrame([(1, [1e30], 0), (2, [0.0], 0)], schema)).collect()
