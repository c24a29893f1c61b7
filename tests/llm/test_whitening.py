import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from pitwall.llm import whitening
from pitwall.llm.whitening import count_below, leading_eigenvalues, leading_eigenvectors, tridiagonal, whitened

SCHEMA = "vec_id long, embedding array<float>"


def symmetric(kind, n, seed):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    values = {
        "random": rng.standard_normal(n), "spread": 10.0 ** rng.uniform(-9, 6, n), "equal": np.full(n, 3.0), "twins": np.repeat(rng.uniform(1, 2, -(-n // 2)), 2)[:n],
        "cluster": 1 + 1e-10 * rng.standard_normal(n), "rank one": np.r_[5.0, np.zeros(n - 1)],
    }[kind]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@settings(max_examples=120, deadline=None)
@given(st.sampled_from(["random", "spread", "equal", "twins", "cluster", "rank one"]), st.integers(1, 40), st.integers(0, 1 << 20))
def test_eigenvectors_against_numpy(kind, n, seed):
    a = symmetric(kind, n, seed)
    most = min(4, n)
    values, vectors = leading_eigenvectors(a, most)
    true, size = np.linalg.eigvalsh(a)[::-1], np.abs(a).max()
    assert np.allclose(values, true[:most], rtol=0, atol=1e-13 * n * size)
    assert np.allclose(vectors.T @ vectors, np.eye(most), atol=1e-10)
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-11 * n * size


def test_tridiagonal_form_and_sturm_counts():
    a = symmetric("random", 30, 1)
    d, e, _ = tridiagonal(a)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    true = np.linalg.eigvalsh(a)
    assert np.allclose(np.linalg.eigvalsh(t), true)
    x = np.linspace(true[0] - 1, true[-1] + 1, 50)
    assert list(count_below(d, e, x)) == [int((true < v).sum()) for v in x]
    assert np.allclose(leading_eigenvalues(d, e, 30), true[::-1])
    # a matrix that falls into parts, with an eigenvalue in several of them
    d, e = np.array([2.0, 2.0, 2.0, 1.0]), np.array([0.0, 0.0, 0.0])
    assert np.allclose(leading_eigenvalues(d, e, 4), [2, 2, 2, 1])


def brute(rows, components):
    """All in plain numbers: exact sums, a dense eigenvalue routine."""
    kept = [(i, [math.floor(256 * c) + 0 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max(len(x) for _, x in kept)
    kept = [(i, x + [0] * (dims - len(x))) for i, x in kept]
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    y = (n * fit - np.array(sums)) / n
    v = y.T @ y / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in kept:
        z = (np.array(x) - np.array(sums) / n) @ vectors / np.sqrt(values)
        for c in range(components):
            out.append((i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(x, sums)), abs(z[c]), values[c] / np.trace(v)))
    return out


def test_against_dense_arithmetic(spark):
    rng = np.random.default_rng(3)
    base = np.float32(rng.standard_normal((300, 12)) * np.linspace(3, 0.2, 12) @ rng.standard_normal((12, 12)) + 40)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    # a third of all rows is one vector; ids repeat and are null; vectors that go
    rows += [(i, rows[0][1]) for i in range(1000, 1150)] + [(None, rows[1][1]), (5, rows[2][1])]
    bad = [(2000, None), (2001, [None] * 12), (2002, [float("nan")] + [0.0] * 11), (2003, [0.0] * 11 + [float("-inf")])]
    got = whitened(spark.createDataFrame(rows + bad, SCHEMA).repartition(5)).collect()
    want = brute(rows, 4)
    assert len(got) == len(want) == 4 * len(rows)
    plain = sorted((r.vec_id is None, r.vec_id or 0, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got)
    for a, b in zip(plain, sorted((i is None, i or 0, *rest) for i, *rest in want)):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9, atol=1e-9)
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-10
    one = {c: {r.vec_id: r.whitened for r in got if r.component == c} for c in (1, 2)}
    assert all(len({np.sign(one[c][i] * one[c][1000]) for i in (0, 1001)}) == 1 for c in one)


def test_few_dimensions_ragged_and_flat_vectors(spark):
    ragged = [(1, [1.0, 2.0]), (2, [3.0]), (3, []), (4, [0.5, -7.0])]
    got = whitened(spark.createDataFrame(ragged, SCHEMA)).collect()
    want = brute(ragged, 2)
    assert sorted((r.vec_id, r.component, r.n, r.deviation) for r in got) == sorted(w[:4] for w in want)
    # all on one line: a single component has variance
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(20)], SCHEMA)
    assert {r.component for r in whitened(line).collect()} == {1}
    for flat in ([], [(1, None)], [(1, [2.0, 3.0])] * 5, [(1, [])]):
        assert whitened(spark.createDataFrame(flat, SCHEMA)).collect() == []


def test_deviation_is_exact_or_null():
    made = whitening.Whitening(3_000_000_001, np.array([7, -5]), np.ones(1), np.ones((2, 1)), 1.0, 0.0)
    assert made.deviation(np.array([[1, 0]])) == [(3_000_000_001 - 7) ** 2 + 25] or (3_000_000_001 - 7) ** 2 + 25 >= 1 << 63
    assert made.deviation(np.array([[2, 0]])) == [None]
    small = whitening.Whitening(1000, np.array([7, -5]), np.ones(1), np.ones((2, 1)), 1.0, 0.0)
    assert small.deviation(np.array([[1, 0], [-3, 9]])) == [993**2 + 25, 3007**2 + 9005**2]


def test_clashing_names(spark):
    df = spark.createDataFrame([(i, [float(i), random.Random(i).random()], "c", 0) for i in range(9)], SCHEMA + ", x string, component int")
    assert len(whitened(df).collect()) == 18
    with pytest.raises(ValueError):
        whitened(spark.createDataFrame([(1, [0.0] * 4097)], SCHEMA))


def test_query_on_the_table(spark, data):
    from pitwall.llm.queries import QUERIES

    got = QUERIES["op13_embedding_whitening"](spark, data).collect()
    assert list(got[0].asDict()) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    want = sorted(brute(rows, 4), key=repr)
    plain = sorted(((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in got), key=repr)
    assert [p[:4] for p in plain] == [w[:4] for w in want]
    assert np.allclose([p[4:] for p in plain], [w[4:] for w in want], rtol=1e-6, atol=1e-8)
    assert got[0].identity_error < 1e-9
