"""Whitening against numpy's eigenvectors and plain integers."""

import math

import numpy as np
import pytest

from tidemark.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, x string, component string"
NAN, INF = float("nan"), float("inf")


def reference(rows, most=4):
    """(vec_id, component) -> values, by definition."""
    sound = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    distinct = sorted({tuple(x) for _, x in sound})
    n, s = len(distinct), [sum(c) for c in zip(*distinct, strict=True)]
    z = np.array(distinct, float) - np.array(s) / n
    v = z.T @ z / n
    e, q = (a[..., ::-1] for a in np.linalg.eigh(v))
    out = []
    for i, x in sound:
        for k in range(min(most, len(e))):
            out.append((i, k + 1, n, sum((n * a - b) ** 2 for a, b in zip(x, s, strict=True)), (np.array(x) - np.array(s) / n) @ q[:, k] / np.sqrt(e[k]), e[k] / np.trace(v)))
    return out


def check(got, expected):
    order = lambda r: (str(r[0]), r[1], r[3], abs(round(r[4], 6)))
    got, expected = sorted((tuple(r) for r in got), key=order), sorted(expected, key=order)
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    for k in {r[1] for r in expected}:
        a, b = (np.array([r[4] for r in rows if r[1] == k]) for rows in (got, expected))
        assert np.allclose(a, b, atol=1e-9) or np.allclose(a, -b, atol=1e-9)
    assert np.allclose([r[5] for r in got], [r[5] for r in expected], rtol=1e-9)
    assert all(r[6] < 1e-9 for r in got)


@pytest.mark.parametrize("d,n", [(6, 300), (3, 40), (2, 9)])
def test_report_by_definition(spark, d, n):
    rng = np.random.default_rng(d)
    base = rng.normal(size=(n, d)) @ rng.normal(size=(d, d))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [rows[0], (None, rows[1][1]), (77, [-0.0] * d), (78, [0.0] * d)] + [(79, rows[2][1])] * 50
    odd = [(90, None), (91, []), (92, [1.0] * (d - 1) + [None]), (93, [NAN] * d), (94, [INF] + [0.0] * (d - 1)), (95, [1.0] * (d + 1))]
    df = spark.createDataFrame([(i, v, "clash", None) for i, v in rows + odd], SCHEMA)
    check(whitening.report(df).collect(), reference(rows))


def test_tables_without_components(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = whitening.report(spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_are_exact_or_null(spark):
    rows = [(1, [2.0**20, 0.0]), (2, [-(2.0**20), 1.0]), (3, [2.0**31, 3.0])]
    got = whitening.report(spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA)).collect()
    exact = {r[0]: r[3] for r in reference(rows)}
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: y if y < 2**63 else None for i, y in exact.items()} and None in {r["deviation"] for r in got}
    assert whitening._deviations(np.array([[2**40, 1]]), 3, [2**41, 0]) == [None] and whitening._deviations(np.array([[2**30, 1]]), 3, [2**31, 0]) == [2**60 + 9]


@pytest.mark.parametrize("e", [[5, 5, 5, 1, 1, 0], [1e12, 1, 1e-6, 1e-12], [3] * 8, list(np.linspace(1, 2, 40)), [1, 1 + 1e-15, 1 - 1e-15, 2], list(2.0 ** -np.arange(30)), [0, 0]])
def test_divide_and_conquer(e):
    rng = np.random.default_rng(len(e))
    q, _ = np.linalg.qr(rng.normal(size=(len(e), len(e))))
    v = q @ np.diag(e) @ q.T
    v = (v + v.T) / 2
    got, vectors = whitening.eigenvectors(v)
    scale = max(1e-300, max(e))
    assert np.allclose(got, sorted(e, reverse=True), atol=1e-14 * scale * len(e))
    assert np.abs(vectors.T @ vectors - np.eye(len(e))).max() < 1e-14 * len(e)
    assert np.abs(v @ vectors - vectors * got).max() <= 1e-14 * len(e) * scale


def test_polar_factor_of_a_matrix_close_to_singular():
    q, _ = np.linalg.qr(np.random.default_rng(3).normal(size=(9, 9)))
    e = np.array([1, -1, 0.5, -1e-3, 1e-6, -1e-9, 1e-12, 2, -3])
    assert np.abs(whitening.polar_factor(q @ np.diag(e) @ q.T) - q @ np.diag(np.sign(e)) @ q.T).max() < 1e-3  # the condition times rounding
    assert np.abs(whitening.polar_factor(np.diag(e)) - np.diag(np.sign(e))).max() < 1e-14


def test_whole_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(queries.op11_embedding_whitening(spark, sf).collect(), reference(rows))
