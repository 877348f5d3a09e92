"""Whitening against dense eigenvectors."""

import numpy as np
import pytest

from wardstar.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, k string, x int, component double"


def table(spark, rows, parts=5):
    return spark.createDataFrame([(i, None if v is None else [None if e is None else float(e) for e in v], "k", 1, 0.5) for i, v in rows], SCHEMA).repartition(parts)


def plain(rows):
    """n, deviations and whitened values (a row per vector, up to sign) from the dense covariance."""
    good = [(i, v) for i, v in rows if v is not None and len(v) and all(e is not None and np.isfinite(e) for e in v)]
    x = np.array([np.floor(256 * np.array(v, np.float32).astype(float)) for _, v in good]).astype(int) + 0
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    m = min(4, int((values > 1e-9 * max(values[0], 1e-300)).sum())) if values[0] > 0 else 0
    white = (x - total / n) @ axes[:, :m] / np.sqrt(values[:m])
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    return good, n, deviations, white, values[:m] / values.sum() if m else values[:0]


def check(spark, rows, **options):
    good, n, deviations, white, explained = plain(rows)
    m = white.shape[1]
    found = whitening.whiten(table(spark, rows), **options).collect()
    assert len(found) == len(good) * m
    by_row = {}
    for r in found:
        by_row.setdefault((r["k"], r["component"]), []).append(r)
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-9
    signs = {}
    for (vec_id, _), deviation, values in zip(good, deviations, white):
        for c in range(m):
            mine = by_row[vec_id, c + 1]
            assert deviation in [r["deviation"] for r in mine]
            match = min((r["whitened"] for r in mine), key=lambda w: abs(abs(w) - abs(values[c])))
            assert abs(abs(match) - abs(values[c])) < 1e-6 * max(1, abs(values[c]))
            if abs(values[c]) > 1e-3 and len(mine) == 1:
                signs.setdefault(c, set()).add(np.sign(match) == np.sign(values[c]))
    assert all(len(s) == 1 for s in signs.values())


def test_random_vectors_with_copies(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(300, 12)) * np.linspace(3, 0.5, 12)
    rows = [(i, v) for i, v in enumerate(base.tolist())]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # a third are copies of one vector
    rows += [(7, rows[7][1]), (None, rows[9][1])]
    rows += [(2000, None), (2001, []), (2002, [None] * 12), (2003, [float("nan")] + [0.0] * 11), (2004, [float("inf")] * 12)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [
    [(1, [1.0, 2.0])],
    [(1, [1.0, 2.0]), (2, [1.0, 2.0])],
    [(1, [1.0, 2.0]), (2, [3.0, 4.0])],
    [(1, [0.5]), (2, [-0.001]), (3, [2.0])],
    [(i, [float(i), 2.0 * i, 0.0, 1.0]) for i in range(9)],
])
def test_small_and_deficient(spark, rows):
    check(spark, rows)


def test_equal_variances(spark):
    """Components of one variance span the same space as the dense ones."""
    rows = [(4 * j + i, [s if c == j else 0.0 for c in range(6)]) for j in range(6) for i, s in enumerate((1.0, -1.0, 2.0, -2.0))]
    found = whitening.fit(whitening.quantised(table(spark, rows)))
    values = plain(rows)[4]
    assert np.allclose(found.values / found.trace, values) and found.identity_error < 1e-9
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(4))


def test_hidden_direction_is_found(spark):
    """A start that is orthogonal to a component must not lose it."""
    rows = [(i, [0.0] * j + [float(s)] + [0.0] * (7 - j)) for i, (j, s) in enumerate((j, s * (8 - j)) for j in range(8) for s in (-1, 1))]
    found = whitening.fit(whitening.quantised(table(spark, rows)))
    assert np.allclose(found.values, [256**2 * 2 * (8 - j) ** 2 / 16 for j in range(4)])


def test_empty_and_ragged(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).collect() == []
    rows = [(1, [1.0, 2.0]), (2, [3.0, 5.0]), (3, [0.0, 1.0]), (4, [1.0])]
    assert {r["k"] for r in whitening.whiten(table(spark, rows)).collect()} == {1, 2, 3}


def test_large_numbers(spark):
    rows = [(1, [1e30, 0.0]), (2, [-1e9, 1.0]), (3, [5.0, 7.0])]
    found = {r["k"]: r["deviation"] for r in whitening.whiten(table(spark, rows)).collect()}
    assert found[1] is None and set(found) == {1, 2, 3}
    assert whitening._deviations(np.array([[2**33, 1]]), 3, [2**34, 2]) == [None]
    assert whitening._deviations(np.array([[2**29, 1]]), 4, [2**30, 2]) == [(2**30) ** 2 + 4]
