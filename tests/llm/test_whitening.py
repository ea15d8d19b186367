"""Whitening against a dense eigen-decomposition, and its edge cases."""

import math

import numpy as np
import pytest

from chunkwright.llm import entries, whitening
from chunkwright.llm.common import stage
from tests.conftest import SF_SMALL


def plain(vectors):
    """(n, sums, eigenvalues, eigenvectors, covariance) of the distinct grid points."""
    x = np.unique(np.floor(64 * np.asarray(vectors, float)).astype(np.int64) + 1_000_000, axis=0)
    z = x - x.sum(0) / len(x)
    v = z.T @ z / len(x)
    e, q = np.linalg.eigh(v)
    return len(x), x.sum(0), e[::-1], q[:, ::-1], v


def compare(rows, table, k):
    """table: (id, vector) of the usable rows."""
    n, sums, e, q, v = plain([x for _, x in table])
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, []).append(r)
    assert len(rows) == k * len(table)
    signs = {}
    for i, vector in table:
        x = np.floor(64 * np.asarray(vector, float)).astype(np.int64) + 1_000_000
        for r in by_id[i]:
            j = r.component - 1
            assert r.n == n and r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums)) == r.deviation_exact
            want = (x - sums / n) @ q[:, j] / math.sqrt(e[j])
            sign = signs.setdefault(j, 1.0 if want * r.whitened >= 0 else -1.0) if abs(want) > 1e-3 else signs.get(j, math.copysign(1, want * r.whitened))
            assert math.isclose(r.whitened, sign * want, rel_tol=1e-7, abs_tol=1e-7)
            assert math.isclose(r.explained, e[j] / np.trace(v), rel_tol=1e-9)
            assert 0 <= r.identity_error < 1e-9


def test_query_equals_dense_solution(spark):
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    compare(entries.queries()["op11_whiten"](spark, SF_SMALL).collect(), table, 16)


def test_filter_finds_a_decaying_spectrum(spark):
    """More dimensions than the block: the answer needs filtered passes."""
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((300, 96)) * np.geomspace(40, 0.5, 96) @ np.linalg.qr(rng.standard_normal((96, 96)))[0]
    df = stage(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>"), "vectors")
    model = whitening.fit_whitening(df.select("embedding"), 8)
    assert model.passes > 10
    _, _, e, q, _ = plain(vectors)
    assert np.allclose(model.values, e[:8], rtol=1e-11)
    assert np.abs(np.abs((model.vectors * q[:, :8]).sum(0)) - 1).max() < 1e-11


def test_a_wrong_block_never_certifies(spark):
    """Without the filter the first block's residuals are far above the bound."""
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("embedding")
    v = whitening.Covariance(whitening.fit_list(df, 64), 64)
    q = np.linalg.qr(np.random.default_rng(1).standard_normal((64, 32)))[0]
    e, _, _, residual = whitening._ritz(q, v.times(q))
    assert residual[:16].min() > 1e6 * whitening.TOLERANCE * e[0]


ODD = [
    (1, [0.5, -0.25, 1.0]), (1, [0.5, -0.25, 1.0]), (2, None), (3, [1.0, None, 2.0]), (4, [1.0, float("nan"), 2.0]), (5, [float("inf"), 0.0, 0.0]),
    (None, [3.0, 2.0, -1.0]), (6, [0.0, 0.0, 0.0]), (7, [1.0, 2.0]), (8, []), (9, [-4.0, 300.5, 7.25]), (10, [0.5, -0.25, 1.0009]),
]
SCHEMA = "vec_id long, embedding array<float>"


def test_odd_rows(spark):
    out = whitening.whiten_digest(stage(spark.createDataFrame(ODD, SCHEMA), "odd")).collect()
    used = [(1, ODD[0][1]), (None, ODD[6][1]), (6, ODD[7][1]), (9, ODD[10][1]), (10, ODD[11][1])]
    assert {r.vec_id for r in out} == {i for i, _ in used} and len(out) == 3 * 6  # id 1 twice, rank 3
    assert {r.n for r in out} == {4}  # 10 falls on 1's grid point
    n, sums, e, _, v = plain([x for _, x in used])
    for r in out:
        assert math.isclose(r.explained, e[r.component - 1] / np.trace(v), rel_tol=1e-9) and r.identity_error < 1e-9
        x = np.floor(64 * np.array(dict(used)[r.vec_id])).astype(int) + 1_000_000
        assert r.deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten_digest(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_clashing_names_and_hot_vector(spark):
    rng = np.random.default_rng(8)
    vectors = [rng.standard_normal(6).tolist() for _ in range(40)]
    rows = [(i, vectors[0] if i % 2 else vectors[i % 40]) for i in range(200)]
    df = stage(spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", *[f"1 as {c}" for c in ("id", "v", "n", "i", "cell", "component", "whitened")]), "hot")
    compare_rows = whitening.whiten_digest(df).collect()
    assert {r.n for r in compare_rows} == {20}
    compare(compare_rows, rows, 6)


def test_wide_values_are_exact(spark):
    """Deviations that pass a long are null there and exact beside it."""
    rows = [(i, [float(i * 10**6), float((i * i) % 7) * 10**7]) for i in range(2000)]
    out = whitening.whiten_digest(stage(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "wide")).collect()
    n, sums, _, _, _ = plain([x for _, x in rows])
    for r in out:
        x = [int(c * 64) + 1_000_000 for c in rows[r.vec_id][1]]
        want = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums))
        assert r.deviation_exact == want and r.deviation == (want if want < 2**63 else None)
    assert any(r.deviation is None for r in out)
