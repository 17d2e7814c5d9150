from __future__ import annotations

import numpy as np
import pytest

from pagetrail.llm import whitening
from pagetrail.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def by_eigenvectors(vectors):
    """x, S, n, the centred rows, and eigenvalues and vectors by numpy's dense solver."""
    x = [[int(np.floor(64 * np.float64(np.float32(c)))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in x])
    _, s, w = np.linalg.svd(centred, full_matrices=False)
    return x, sums, n, centred, s**2 / n, w.T


def check(rows, vectors, ids):
    x, sums, n, centred, e, w = by_eigenvectors(vectors)
    count = min(32, int((e > 1e-16 * e[0]).sum()))
    assert len(rows) == count * n
    found = np.full((n, count), np.nan)
    place = {i: k for k, i in enumerate(ids)}
    for r in rows:
        k = place[r.vec_id]
        found[k, r.component - 1] = r.whitened
        assert r.n == n
        exact = sum((n * a - s) ** 2 for a, s in zip(x[k], sums, strict=True))
        assert r.deviation == (exact if exact < 2**63 else None)
        assert r.explained == pytest.approx(e[r.component - 1] / e.sum(), rel=1e-9)
        assert 0 <= r.identity_error < 1e-9
    wanted = centred @ w[:, :count] / np.sqrt(e[:count])
    apart = np.min([np.abs(found - wanted).max(axis=0), np.abs(found + wanted).max(axis=0)], axis=0)
    assert apart.max() < 1e-6
    assert np.abs(found.T @ found / n - np.eye(count)).max() < 1e-9


def test_query_equals_eigenvectors(spark):
    rows = QUERIES["op11_whitening"](spark, SF).collect()
    given = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    check(rows, [r.embedding for r in given], [r.vec_id for r in given])


@pytest.mark.parametrize("kind", ["few rows", "dependent", "constant", "uneven scales", "copies"])
def test_hard_tables_equal_eigenvectors(spark, kind):
    random = np.random.default_rng(7)
    vectors = random.normal(size=(300, 12)) * 3
    if kind == "few rows":
        vectors = random.normal(size=(5, 12)) * 100
    if kind == "dependent":
        vectors[:, 5] = vectors[:, 2]
        vectors[:, 7] = vectors[:, 3]
    if kind == "constant":
        vectors[:, 4] = 1.5
    if kind == "uneven scales":
        vectors *= np.logspace(0, 7, 12)
    if kind == "copies":
        vectors[100:] = vectors[0]
    vectors = vectors.astype(np.float32).astype(float).tolist()
    rows = whitening.whiten(frame(spark, list(enumerate(vectors))).repartition(5)).collect()
    check(rows, vectors, range(len(vectors)))


def test_triangular_solve():
    random = np.random.default_rng(1)
    r = np.triu(random.normal(size=(6, 6))) + 3 * np.eye(6)
    rows = random.normal(size=(4, 6))
    assert np.allclose(whitening.solve_upper(rows, r) @ r, rows)


def test_rows_that_do_not_count(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [4.0, 8.0], [4.0, 8.0]]
    bad = [None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [1e30, 1.0], [3.0]]
    rows = [(1, good[0]), (None, good[1]), (2, good[2]), (2, good[3])]
    rows += [(10 + i, v) for i, v in enumerate(bad)]
    docs = frame(spark, rows).selectExpr("*", "7 AS n", "'x' AS component", "1 AS key", "2 AS x")
    found = whitening.whiten(docs).collect()
    ids = sorted((r.vec_id or 0) for r in found)
    assert ids == [0, 0, 1, 1, 2, 2, 2, 2] and {r.n for r in found} == {4}
    assert found[0].identity_error < 1e-9
    one = {(r.component, r.whitened) for r in found if r.vec_id == 2}
    assert len(one) == 2  # equal rows, equal answers


def test_nothing_to_whiten(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    equal = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))
    assert equal.collect() == [] and equal.columns == whitening.whiten(
        frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 3.0])])
    ).columns


def test_deviation_that_fits_no_long():
    x = np.array([[2**40, 0], [0, 2**40]], np.int64)
    assert whitening.deviations(x, 2, [2**40, 2**40]) == [None, None]
    assert whitening.deviations(x >> 12, 2, [2**28, 2**28]) == [2**57, 2**57]


def test_too_many_dimensions(spark):
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, [(1, [1.0] * 2049)]))
