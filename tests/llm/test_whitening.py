"""Whitening against plain eigenvectors."""

import math

import numpy as np
import pytest

from adlens.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in zip(ids, vectors)], SCHEMA)


def integers(vectors):
    return np.array([[math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for v in vectors])


def compare(got, vectors, k, every=True):
    """Rows of ``whiten`` against numpy's eigenvectors, by vec_id."""
    x = integers(vectors)
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(k, int((values > 1e-12 * values.sum()).sum()))
    want = centred @ axes[:, :k] / np.sqrt(values[:k])
    white = np.zeros((n, k))
    for r in got:
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert r["deviation"] == sum((n * int(v) - int(s)) ** 2 for v, s in zip(x[r["vec_id"]], sums))
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) <= 1e-12
        white[r["vec_id"], r["component"] - 1] = r["whitened"]
    assert len(got) == n * k
    if every:
        for j in range(k):
            assert min(np.abs(white[:, j] - want[:, j]).max(), np.abs(white[:, j] + want[:, j]).max()) < 1e-7, j


def test_equals_plain_eigenvectors(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((300, 70)) * np.linspace(0.5, 3, 70) + 2
    compare(whitening.whiten(table(spark, vectors), 32).collect(), vectors, 32)


def test_small_and_flat_spectra(spark):
    rng = np.random.default_rng(4)
    for vectors, k in ((rng.standard_normal((50, 5)), 32), (np.outer(rng.standard_normal(40), np.arange(1, 9)), 32), (rng.standard_normal((6, 80)), 32)):
        compare(whitening.whiten(table(spark, vectors), k).collect(), vectors, k, every=len(vectors) != 40)


@pytest.mark.parametrize("spectrum,k", [(np.r_[1e6, np.linspace(1, 2, 199)], 32), (2.0 ** -np.arange(64), 32), (np.ones(64), 10),
                                        (np.r_[np.ones(5), np.zeros(90)], 32), (np.linspace(1, 1.2, 300), 16)])
def test_iteration_is_certified(spectrum, k):
    d = len(spectrum)
    turn = np.linalg.qr(np.random.default_rng(1).standard_normal((d, d)))[0]
    v = (turn * spectrum) @ turn.T
    v = (v + v.T) / 2
    values, axes = whitening.leading(lambda q: v @ q, d, k, np.trace(v))
    want = np.sort(spectrum)[::-1][:k]
    want = want[want > whitening.FLAT * spectrum.sum()]
    assert np.abs(values - want).max() < 1e-12 * want[0]
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12
    assert np.linalg.norm(v @ axes - axes * values, axis=0).max() < 1e-11 * want[0]


def test_uncertified_is_an_error(monkeypatch):
    monkeypatch.setattr(whitening, "MAX_ROUNDS", 1)
    v = np.diag(np.linspace(1, 2, 100))
    with pytest.raises(ArithmeticError):
        whitening.leading(lambda q: v @ q, 100, 8, np.trace(v))


def test_odd_tables(spark):
    rng = np.random.default_rng(5)
    good = rng.standard_normal((30, 6))
    bad = [None, [], [None] * 6, [float("nan")] + [0] * 5, [float("inf")] + [0] * 5, [1, 2]]
    rows = whitening.whiten(table(spark, [*good, *bad]).selectExpr("*", "1 as n", "'x' as x", "2 as component"), 3).collect()
    assert {r["vec_id"] for r in rows} == set(range(30)) and len(rows) == 90 and rows[0]["n"] == 30
    # null and repeated ids are rows of their own
    rows = whitening.whiten(table(spark, good, [None, None, *range(1, 15), *range(1, 15)]), 2).collect()
    assert len(rows) == 60 and sum(r["vec_id"] is None for r in rows) == 4
    assert whitening.whiten(table(spark, []), 3).collect() == []
    assert whitening.whiten(table(spark, [[1, 2]] * 4), 3).collect() == []          # no variance
    assert whitening.whiten(table(spark, [[1, 2]]), 3).collect() == []
    assert whitening.whiten(table(spark, bad[:-1]), 3).collect() == []
    # components far beyond a long are bounded; a deviation beyond a long is null
    rows = whitening.whiten(table(spark, [[3e38, 0], [-3e38, 1], [1, 2]]), 2).collect()
    assert {r["vec_id"]: r["deviation"] is None for r in rows} == {0: True, 1: True, 2: False}


def test_many_parts_are_added_in_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((200, 20)) * np.linspace(1, 2, 20)
    fit = whitening.Rows(whitening.integer_rows(table(spark, vectors)).repartition(9))
    x = integers(vectors)
    centred = x - x.mean(axis=0)
    q = rng.standard_normal((20, 4))
    assert np.allclose(fit.times(q), centred.T @ (centred @ q) / 200, rtol=1e-12)
    assert abs(fit.trace()[0] - (centred ** 2).sum() / 200) < 1e-9 * fit.trace()[0]
