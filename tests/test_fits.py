"""Fits against singular value decompositions, on clouds of every shape."""

import numpy as np
import pytest

from tessella.operators import transforms


def by_decomposition(a, b, scaled):
    ma, mb = a.mean(axis=0), b.mean(axis=0)
    u, d, vt = np.linalg.svd((b - mb).T @ (a - ma) / len(a))
    sign = np.array([1, 1, np.sign(np.linalg.det(u) * np.linalg.det(vt))])
    scale = (d * sign).sum() / ((a - ma) ** 2).sum() * len(a) if scaled else 1.0
    r = scale * (u * sign) @ vt
    return r, mb - r @ ma, scale


def fitted(spark, groups, scaled):
    rows = [(k, *map(float, p), *map(float, q)) for k, (a, b) in groups.items() for p, q in zip(a, b)]
    df = spark.createDataFrame(rows, "prep int, x_a double, y_a double, z_a double, x_b double, y_b double, z_b double")
    return {f["prep"]: (np.array([[f[f"r{i}{j}"] for j in range(3)] for i in range(3)]), np.array([f[f"t{i}"] for i in range(3)]), f["scale"]) for f in transforms.fit(df, ["prep"], scaled).collect()}


@pytest.mark.parametrize("scaled", [True, False])
def test_fits_of_noisy_clouds(spark, scaled):
    r, groups = np.random.default_rng(1), {}
    for k in range(40):
        a = r.normal(size=(int(r.integers(4, 30)), 3)) * r.uniform(0.1, 500, size=3) + r.normal(size=3) * 1000
        if k % 4 == 1:
            a[:, 2] = a[0, 2]  # a plane
        b = a @ np.linalg.qr(r.normal(size=(3, 3)))[0].T * r.uniform(0.5, 3) + r.normal(size=a.shape) * (0 if k % 3 else 5) + 100  # with reflections
        groups[k] = (a, b if k % 4 != 2 else r.normal(size=a.shape))
    got = fitted(spark, groups, scaled)
    for k, (a, b) in groups.items():
        want = by_decomposition(a, b, scaled)
        assert np.linalg.det(got[k][0]) > 0
        assert np.allclose(got[k][0], want[0], rtol=1e-5, atol=1e-6) and np.allclose(got[k][1], want[1], rtol=1e-5, atol=1e-3) and np.isclose(got[k][2], want[2])


def test_points_on_a_line_and_on_a_spot_turn_least(spark):
    line = np.outer(np.arange(5.0), [1.0, 0, 0])
    got = fitted(spark, {1: (line, line + 7), 2: (line, line @ np.array([[0.0, 1, 0], [-1, 0, 0], [0, 0, 1]])), 3: (line * 0 + 4, line * 0 + 9)}, False)
    assert np.allclose(got[1][0], np.eye(3)) and np.allclose(got[1][1], 7)
    assert np.allclose(got[2][0], [[0, -1, 0], [1, 0, 0], [0, 0, 1]])
    assert np.allclose(got[3][0], np.eye(3)) and np.allclose(got[3][1], 5)
