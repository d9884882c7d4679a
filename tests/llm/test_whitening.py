"""Whitening against numpy's eigenvectors and Python's whole numbers."""

import math

import numpy as np
import pytest
from conftest import CHECK
from pyspark.sql import functions as F

from orderlens.llm import queries, whitening
from orderlens.llm.whitening import Factored, Slicer


def spectrum(values, seed=0):
    turn = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    made = (turn * np.asarray(values)) @ turn.T
    return (made + made.T) / 2


MATRICES = {
    "spread": spectrum(np.linspace(1, 9, 30)),
    "equal": np.eye(12) * 3,
    "nil": np.zeros((5, 5)),
    "clusters": spectrum(np.repeat([5, 3, 3 + 1e-13, 1], 8)),
    "close": spectrum([7, 7 - 1e-6, 7 - 2e-6, 1, 1 + 1e-9, 0.5]),
    "wide": spectrum(np.r_[1e8, 1, np.logspace(0, -12, 20)]),
    "one": np.array([[4.0]]),
    "edge": np.full((2, 2), 2.0),
}


@pytest.mark.parametrize("name", MATRICES)
def test_eigenpairs_are_those_of_the_library(name):
    matrix = MATRICES[name]
    values, vectors = Slicer(matrix).leading(16)
    wanted = np.linalg.eigvalsh(matrix)[::-1][:16]
    size = max(1e-300, np.abs(wanted).max())
    assert np.abs(values - wanted).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(wanted))).max() < 1e-13
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * size


def test_counts_and_solutions_of_indefinite_matrices():
    for seed in range(120):
        random = np.random.default_rng(seed)
        n = random.integers(1, 10)
        matrix = random.integers(-2, 3, (n, n))
        matrix = (matrix + matrix.T).astype(float)
        values = np.linalg.eigvalsh(matrix)
        for shift in np.linspace(-9.3, 9.1, 7):
            assert Slicer(matrix).above(shift) == (values > shift).sum()
        moved, right = matrix - 0.123 * np.eye(n), random.standard_normal((n, 2))
        assert np.allclose(moved @ Factored(moved).solve(right, 1e-300), right, atol=1e-8)
        assert np.allclose(Slicer(matrix).leading(n)[0], values[::-1], atol=1e-12)



def test_a_wrong_number_is_noticed(monkeypatch):
    monkeypatch.setattr(Slicer, "intervals", lambda self, wanted: [(0.5, 1.5, 1)])
    with pytest.raises(ArithmeticError):
        Slicer(np.diag([1.0, 2.0])).leading(1)


def by_hand(rows, components=32):
    """n, whitened, deviation and explained of ``rows`` of one length, in exact numbers up to the eigenvectors."""
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    apart = n * x - sums
    exact = np.array([[c / n**3 for c in line] for line in apart.T @ apart], float)
    values, vectors = np.linalg.eigh(exact)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    whitened = (apart / n).astype(float) @ vectors / np.sqrt(np.maximum(values, 1e-300))
    return n, whitened, [int(d) for d in (apart * apart).sum(axis=1)], values / np.trace(exact)


def compare(got, rows):
    """``rows``: {id: vector} of one length; ``got`` rows by id."""
    n, whitened, deviations, explained = by_hand(list(rows.values()))
    made = np.array([got[i].whitened for i in rows], float)
    sign = np.sign((made * whitened).sum(axis=0))
    assert np.abs(made - sign * whitened).max() < 1e-8
    assert [got[i].deviation for i in rows] == deviations and {got[i].n for i in rows} == {n}
    assert np.allclose([got[i].explained for i in rows], explained, rtol=1e-10)
    centred = made - made.mean(axis=0)
    error = np.abs(centred.T @ centred / n - np.eye(made.shape[1])).max()
    assert {got[i].identity_error for i in rows} == {next(iter(got[i].identity_error for i in rows))}
    assert got[next(iter(rows))].identity_error == pytest.approx(error, abs=1e-12) and error < 1e-9


def test_rows_of_every_kind(spark):
    random = np.random.default_rng(4)
    rows = {i: (random.standard_normal(6) * [9, 7, 5, 3, 2, 1] + 40).astype(np.float32).tolist() for i in range(300)}
    rows |= {1000 + i: rows[i] for i in range(40)}
    more = {2000 + i: random.standard_normal(3).astype(np.float32).tolist() for i in range(50)}
    inf, nan = float("inf"), float("nan")
    bad = [None, [], [inf] * 6, [nan] + [1.0] * 5, [None] * 6]
    everything = [*rows.items(), *more.items(), *[(3000 + i, v) for i, v in enumerate(bad)]]
    frame = spark.createDataFrame(everything, "vec_id long, embedding array<float>").withColumns(
        {c: F.lit("old") for c in ("numbers", "whitened", "n", "dims")}).repartition(5)
    made = whitening.whiten(frame).collect()
    got = {r.vec_id: r for r in made}
    assert len(made) == len(rows) + len(more)
    compare(got, rows)
    compare(got, more)
    assert whitening.whiten(frame.limit(0)).count() == 0


def test_nothing_varies_and_huge_entries(spark):
    rows = [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (5, [3e38, 1.0, 0.0]), (6, [-3e38, 1.0, 2.0]), (7, [5.0, 1.0, 4.0])]
    made = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    for r in made:
        if r.vec_id is None:
            assert (r.n, r.deviation, list(r.whitened), list(r.explained)) == (2, 0, [None, None], [None, None])
        else:
            assert r.n == 3 and (r.deviation is None) == (r.vec_id < 7) and len(r.whitened) == 3 and r.explained[0] == pytest.approx(1)


def test_exact_products():
    random = np.random.default_rng(1)
    for size in (10, 2**20, 2**40, 2**62):
        rows = random.integers(-size, size, (50, 4))
        assert np.array_equal(whitening.exact_products(rows), rows.astype(object).T @ rows.astype(object))


def test_query_over_the_whole_table(spark):
    stored = {r.vec_id: r.embedding for r in queries.table(spark, CHECK, "embeddings").collect()}
    made = queries.op13_whitening(spark, CHECK)
    assert made.count() == 32 * len(stored)
    n, whitened, deviations, explained = by_hand(list(stored.values()))
    place = {key: i for i, key in enumerate(stored)}
    got = np.zeros_like(whitened)
    for r in made.collect():
        got[place[r.vec_id], r.component - 1] = r.whitened
        assert (r.n, r.deviation) == (n, deviations[place[r.vec_id]]) and r.identity_error < 1e-9
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10)
    assert np.abs(got - np.sign((got * whitened).sum(axis=0)) * whitened).max() < 1e-8
