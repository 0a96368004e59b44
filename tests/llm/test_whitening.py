"""Whitening against numpy's eigenvectors and exact arithmetic."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest

from wayfare.llm import whitening as wh


def determinant(matrix):
    m, out = [[Fraction(x) for x in row] for row in matrix], Fraction(1)
    for k in range(len(m)):
        at = next((i for i in range(k, len(m)) if m[i][k]), None)
        if at is None:
            return 0
        if at != k:
            m[k], m[at], out = m[at], m[k], -out
        out *= m[k][k]
        for i in range(k + 1, len(m)):
            f = m[i][k] / m[k][k]
            m[i] = [a - f * b for a, b in zip(m[i], m[k], strict=True)]
    return int(out)


def test_characteristic_polynomial(spark):
    rng = random.Random(4)
    for dim, rank in ((1, 1), (2, 2), (5, 5), (6, 3), (7, 7)):
        b = [[rng.randrange(-900, 900) for _ in range(dim)] for _ in range(rank)]
        a = [[sum(r[i] * r[j] for r in b) for j in range(dim)] for i in range(dim)]
        poly = wh.characteristic(spark, a)
        assert poly[-1] == 1 and len(poly) == dim + 1
        for t in (-3, 0, 1, 10**6):
            assert sum(c * t**i for i, c in enumerate(poly)) == determinant([[(t if i == j else 0) - a[i][j] for j in range(dim)] for i in range(dim)])


def test_roots_are_counted_and_refined():
    roots = [2, 2, 7, 1000, 1001, 10**12]
    poly = [1]
    for r in roots:
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0], strict=True)]
    assert [wh.roots_above(poly, at) for at in (0, 1, 2, 7, 1000, 10**12)] == [6, 6, 4, 3, 2, 0]
    found = wh.isolate(poly, 6)
    assert [m for *_, m in found] == [1, 1, 1, 1, 2]
    for (low, high, bits, many), root in zip(found, sorted(set(roots), reverse=True), strict=True):
        value = wh.refined(poly, low, high, bits) if many == 1 else wh.middle(low, high, bits)
        assert abs(float(value) - root) < 1e-12 * root


def check(got, vectors, count=8, scale=1024):
    x = np.array([[int(np.floor(scale * c)) for c in v] for v in vectors.values()], object) + 100_000
    n, s = len(x), x.sum(0)
    centred = ((n * x - s).astype(float)) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-e)[:count]
    e, u, trace = e[order], u[:, order], e.sum()
    want = centred @ u / np.sqrt(e)
    rows = {(r["vec_id"], r["component"]): r for r in got}
    assert len(rows) == len(got) == n * count
    mine = np.array([[rows[i, c + 1]["whitened"] for c in range(count)] for i in vectors])
    signs = np.sign((mine * want).sum(0))
    assert np.abs(mine * signs - want).max() < 1e-8
    deviation = ((n * x - s) ** 2).sum(1)
    for i, d in zip(vectors, deviation, strict=True):
        assert int(rows[i, 1]["deviation"]) == d and rows[i, 1]["n"] == n
    assert all(abs(rows[i, c + 1]["explained"] - e[c] / trace) <= 1e-8 for i in vectors for c in range(count))
    assert all(r["identity_error"] < 1e-8 for r in got)


def table(spark, rows):
    schema = "vec_id long, embedding array<double>, label string, v int, w int, dim int, component int"
    return spark.createDataFrame([(i, v, "x", 1, 2, 3, 4) for i, v in rows], schema).repartition(3)


def test_against_numpy(spark, sf_dir):
    emb = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = {r["vec_id"]: [float(c) for c in r["embedding"]] for r in emb.collect()}
    check(wh.whitened_embeddings(emb).collect(), vectors)


def test_odd_vectors(spark):
    rng = np.random.default_rng(3)
    sound = {i: (rng.normal(size=3) * [5, 1, 0.1] + 1000 * (i == 7)).tolist() for i in range(80)}
    rows = [*sound.items(), (None, None), (200, None), (201, [1.0, None, 2.0]), (202, [1.0, float("nan"), 2.0]), (203, [float("inf"), 1.0, 1.0]), (204, []), (205, [1.0, 2.0]), (206, [1.0] * 500)]
    check(wh.whitened(table(spark, rows)).collect(), sound, 3)
    for size in (1e13, 6e13):
        large = {i: (rng.uniform(-1, 1, size=2) * size).tolist() for i in range(30)}
        check(wh.whitened(table(spark, large.items()), components=2).collect(), large, 2)
    with pytest.raises(Exception, match="(?i)overflow"):
        wh.whitened_embeddings(table(spark, large.items())).collect()


def test_equal_eigenvalues_and_no_variance(spark):
    cross = {i: v for i, v in enumerate([[1.0, 0.0, 0.0, 0.0], [-1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0], [0.0, -1.0, 0.0, 0.0], [0.0, 0.0, 0.5, 0.0], [0.0, 0.0, -0.5, 0.0]])}
    got = wh.whitened(table(spark, cross.items())).collect()
    assert {r["component"] for r in got} == {1, 2, 3}  # the fourth has no variance
    assert max(r["identity_error"] for r in got) < 1e-12
    assert sorted({round(r["explained"], 12) for r in got}) == [round(x, 12) for x in (0.5 / 4.5, 2 / 4.5)]
    assert wh.whitened(table(spark, [(i, [1.0, 2.0]) for i in range(4)])).count() == 0
    assert wh.whitened(table(spark, [(1, [1.0])])).count() == 0
    assert wh.whitened(table(spark, [(1, [1.0])]).filter("vec_id > 5")).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_repeated_rows_take_part(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [3.0, 1.5]), (None, [1.0, -2.0])]
    got = wh.whitened(table(spark, rows)).collect()
    assert len(got) == 8 and {r["n"] for r in got} == {4} and sum(r["vec_id"] is None for r in got) == 2
