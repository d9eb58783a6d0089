import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int"


@pytest.fixture
def table(spark):
    return lambda *vectors, ids=None: spark.createDataFrame(
        [(i if ids is None else ids[i], v, 1) for i, v in enumerate(vectors)], SCHEMA
    )


def vectors(count, size, seed=1, spread=1.0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(count, size)) * spread * np.linspace(1, 2, size)).astype(np.float32).tolist()


def brute(given, components=16):
    """Eigenvectors of numpy over the distinct whole vectors."""
    x = np.floor(64 * np.array(given, np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(fit))
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    n, sums = len(fit), fit.sum(0)
    deviation = [sum(int(n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return (x - fit.mean(0)) @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n), n, deviation


def held_against_brute(rows, given, ids, components):
    want, explained, n, deviation = brute(given, components)
    got = {(row.vec_id, row.component): row for row in rows}
    assert len(rows) == len(given) * components
    for at, vec_id in enumerate(ids):
        for k in range(components):
            row = got[vec_id, k + 1]
            assert row.n == n and row.deviation == deviation[at]
            assert row.explained == pytest.approx(explained[k], rel=1e-9)
            assert abs(abs(row.whitened) - abs(want[at, k])) < 1e-7
            assert row.identity_error < 1e-9
    for k in range(components):  # one sign for all rows
        signs = {np.sign(got[i, k + 1].whitened * want[at, k]) for at, i in enumerate(ids) if abs(want[at, k]) > 1e-6}
        assert len(signs) == 1


def test_equals_eigenvectors_by_numpy(table):
    given = vectors(300, 20)
    given += given[:40]  # copies count once
    out = whitening.whitened(table(*given).withColumns({n: F.lit("x") for n in ("y", "n", "component", "size", "at")}))
    held_against_brute(out.collect(), given, range(len(given)), 16)


def test_few_dimensions_have_few_components(table):
    given = vectors(50, 3)
    held_against_brute(whitening.whitened(table(*given)).collect(), given, range(50), 3)


def test_unusable_vectors_are_left_out(table):
    good = vectors(40, 4)
    bad = [None, [], [1.0, None, 0.0, 0.0], [float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = whitening.whitened(table(*bad, *good)).collect()
    held_against_brute(rows, good, range(len(bad), len(bad) + 40), 4)


def test_zero_eigenvalues_have_no_component(table):
    flat = [[a, b, 0.5, a + b] for a, b in np.random.default_rng(3).integers(-5, 5, (60, 2)).tolist()]
    flat = [list(map(float, v)) for v in flat]
    rows = whitening.whitened(table(*flat)).collect()
    assert {row.component for row in rows} == {1, 2} and len(rows) == 120
    assert rows[0].identity_error < 1e-9
    assert whitening.whitened(table([1.0, 2.0], [1.0, 2.0])).collect() == []


def test_equal_eigenvalues_share_a_plane(table):
    # The corners of a cube: all three eigenvalues are equal.
    corners = [[float(a), float(b), float(c)] for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]
    rows = whitening.whitened(table(*corners)).collect()
    assert len(rows) == 24 and rows[0].identity_error < 1e-9
    assert {round(row.explained, 12) for row in rows} == {round(1 / 3, 12)}
    lengths = {round(sum(r.whitened**2 for r in rows if r.vec_id == i), 9) for i in range(8)}
    assert lengths == {3.0}


def test_null_and_repeated_ids_are_rows_of_their_own(table):
    given = vectors(10, 2)
    rows = whitening.whitened(table(*given, ids=[None, None, 4, 4, *range(6)])).collect()
    assert len(rows) == 20 and sum(row.vec_id is None for row in rows) == 4


def test_empty_table(table):
    out = whitening.whitened(table())
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0


def test_moments_are_exact_for_large_and_small_entries(spark):
    rng = random.Random(4)
    rows = [[rng.randrange(-(1 << 62), 1 << 62), rng.randrange(-50, 50), rng.choice([0, -(1 << 62), 1 << 30])] for _ in range(50)]
    n, sums, products = whitening.moments(spark.createDataFrame([(r,) for r in rows], "y array<bigint>"), 3)
    assert n == 50
    assert sums == [sum(r[i] for r in rows) for i in range(3)]
    assert products == [[sum(r[i] * r[j] for r in rows) for j in range(3)] for i in range(3)]


def test_large_entries_have_no_deviation(table):
    given = [[1e30, 0.0], [-1e30, 1.0], [0.0, 2.0]]
    rows = whitening.whitened(table(*given)).collect()
    assert {row.vec_id: row.deviation for row in rows} == {0: None, 1: None, 2: 36864} and len(rows) == 6
    assert rows[0].identity_error < 1e-4


def expanded(roots):
    out = [1]
    for root in roots:
        out = [(out[k - 1] if k else 0) - root * (out[k] if k < len(out) else 0) for k in range(len(out) + 1)]
    return out


def test_polynomial_and_roots_are_exact(spark):
    rng = random.Random(2)
    half = [[rng.randrange(-9, 9) for _ in range(7)] for _ in range(9)]
    matrix = [[sum(row[i] * row[j] for row in half) for j in range(7)] for i in range(7)]
    # Newton's identities: another way to the coefficients, by whole traces.
    power, traces = matrix, []
    for _ in range(7):
        traces.append(sum(power[i][i] for i in range(7)))
        power = [[sum(power[i][k] * matrix[k][j] for k in range(7)) for j in range(7)] for i in range(7)]
    sums = [1]
    for k in range(1, 8):
        sums.append(sum((-1) ** (i - 1) * sums[k - i] * traces[i - 1] for i in range(1, k + 1)) // k)
    want = [(-1) ** k * sums[k] for k in range(7, -1, -1)]
    assert whitening.characteristic(spark, matrix) == want

    found = whitening.Roots(expanded([0, 0, 3, 3, 5, 10**12, 10**12 + 1])).largest(16)
    assert [(round(root / 2**whitening.FINE), many) for root, many in found] == [(10**12 + 1, 1), (10**12, 1), (5, 1), (3, 2)]
    assert whitening.Roots(expanded([7])).largest(1) == [(7 << whitening.FINE, 1)]


def test_primes_are_prime():
    for p in whitening.primes(5):
        assert all(p % d for d in range(2, 47_000))
