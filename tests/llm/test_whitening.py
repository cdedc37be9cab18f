import math
import random

import numpy as np
import pytest

from stratascore.llm.whitening import chebyshev_components, fit_basis, integer_rows, whitened_components

SCHEMA = "vec_id bigint, embedding array<float>, component string, n string"


def by_hand(vectors, components=8):
    """Exact deviations, eigenvalues and whitened rows (up to sign) of integer rows."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors], object)
    n = len(x)
    sums = x.sum(axis=0)
    deviation = [int(((n * row - sums) ** 2).sum()) for row in x]
    z = ((n * x - sums).astype(float)) / n
    values, turn = np.linalg.eigh(z.T @ z / n)
    values, turn = values[::-1], turn[:, ::-1]
    k = min(components, len(values))
    return n, deviation, values, (z @ turn[:, :k]) / np.sqrt(values[:k]), values[:k] / values.sum()


def check(found, ids, vectors, tolerance=1e-8):
    n, deviation, _, white, shares = by_hand(vectors)
    k = len(shares)
    assert len(found) == len(ids) * k
    table = {(r.vec_id, r.component): r for r in found}
    mine = np.array([[table[i, c + 1].whitened for c in range(k)] for i in ids])
    signs = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine * signs - white).max() < tolerance * max(1, np.abs(white).max())
    assert [table[i, 1].deviation for i in ids] == deviation
    assert np.allclose([table[ids[0], c + 1].explained for c in range(k)], shares, rtol=1e-9)
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    assert max(r.identity_error for r in found) < 1e-9


def float32(rows):
    return [[float(np.float32(c)) for c in row] for row in rows]


def test_flat_spectrum_with_all_edges(spark):
    rng = np.random.default_rng(1)
    good = float32(rng.standard_normal((700, 40)))
    good[3:10] = [good[2]] * 7  # repeated rows
    odd = [None, [None] * 40, [float("nan")] + [0.0] * 39, [float("inf")] * 40, [-float("inf")] + [1.0] * 39, [], [1.0, 2.0]]
    rows = [(i, v, "c", "n") for i, v in enumerate(good)] + [(1000 + i, v, None, None) for i, v in enumerate(odd)]
    random.Random(1).shuffle(rows)
    found = whitened_components(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(found.collect(), list(range(700)), good)


@pytest.mark.parametrize("name", ["steep", "few dimensions", "large entries", "one dimension"])
def test_spectra(spark, name):
    rng = np.random.default_rng(2)
    rows = {
        "steep": rng.standard_normal((300, 48)) * np.geomspace(100, 0.01, 48),
        "few dimensions": rng.standard_normal((200, 5)),
        "large entries": rng.standard_normal((200, 12)) * 3e6 + 1e7,
        "one dimension": rng.standard_normal((50, 1)),
    }[name]
    rows = float32(rows)
    found = whitened_components(spark.createDataFrame([(i, v, "", "") for i, v in enumerate(rows)], SCHEMA).repartition(3)).collect()
    if name == "large entries":  # exact beyond doubles, and null only beyond a long
        want = by_hand(rows)[1]
        assert {r.vec_id: r.deviation for r in found} == {i: v if v < 1 << 63 else None for i, v in enumerate(want)}
    else:
        check(found, list(range(len(rows))), rows)


def test_little_variance(spark):
    """Equal vectors, one vector and none give no rows; a table of rank two gives two components; null keys stay."""
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert whitened_components(make([(i, [1.0, 2.0, 3.0], "", "") for i in range(9)])).collect() == []
    assert whitened_components(make([(1, [1.0, 2.0], "", "")])).collect() == []
    assert whitened_components(make([])).collect() == []
    assert whitened_components(make([(1, None, "", "")])).collect() == []
    rows = [(None if i % 5 == 0 else i, [float(i % 7), float(i % 3), float(i % 7), 0.0], "", "") for i in range(42)]
    found = whitened_components(make(rows)).collect()
    assert {r.component for r in found} == {1, 2} and len(found) == 84 and sum(r.vec_id is None for r in found) == 18
    huge = whitened_components(make([(i, [3e38 * (-1) ** i, 1.0], "", "") for i in range(4)])).collect()
    assert {r.component for r in huge} == {1} and {r.deviation for r in huge} == {None}


def test_filter_on_hard_spectra():
    """A cluster at the edge of the wanted components, equal eigenvalues, and a steep fall: certified by residuals."""
    rng = np.random.default_rng(5)
    turn, _ = np.linalg.qr(rng.standard_normal((200, 200)))
    for spectrum in (np.r_[np.linspace(2, 1.2, 8), np.linspace(1.199, 0.5, 192)], np.r_[[3.0] * 12, [1.0] * 188], np.geomspace(1e6, 1e-6, 200),
                     np.r_[[5.0, 4.0], np.zeros(198)]):
        matrix = (turn * spectrum) @ turn.T
        values, vectors, residuals = chebyshev_components(lambda q, m=matrix: m @ q, 200)
        want = np.sort(spectrum)[::-1][:8]
        want = want[want > 1e-11 * want[0]]
        assert np.allclose(values, want, rtol=1e-9) and (residuals <= 1e-10 * want[0]).all()
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)


def test_same_on_any_partitions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v, "", "") for i, v in enumerate(float32(rng.standard_normal((500, 80))))]
    bases = []
    for parts in (1, 7):
        table, dimensions = integer_rows(spark.createDataFrame(rows, SCHEMA).repartition(parts))
        bases.append(fit_basis(table, dimensions))
    one, other = bases
    assert one.sums == other.sums and np.allclose(one.values, other.values, rtol=1e-12)
    assert np.allclose(np.abs((one.vectors * other.vectors).sum(axis=0)), 1, atol=1e-12)
    assert (one.residuals <= 1e-12 * one.values[0]).all() and one.passes > 5
