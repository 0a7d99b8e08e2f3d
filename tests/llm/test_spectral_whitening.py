"""Whitening by incremental eigendecomposition against a plain eigendecomposition."""

from __future__ import annotations

import math

import numpy as np
import pytest

from sliceward.llm import spectral_whitening as S

SCHEMA = "vec_id long, embedding array<float>, n string, component string, x string, whitened string"


def scatter(x):
    off = x - x.mean(axis=0)
    return off.T @ off


def data(kind: str):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 16)) * rng.uniform(0.1, 30, 16)
    return {
        "plain": x,
        "integers": np.round(x / 20),
        "copies": np.repeat(x[:3], 100, axis=0),
        "few": x[:5],
        "flat": np.where(np.arange(16) < 6, x, 0.0),
        "wide": x * np.logspace(0, 6, 16),
        "same eigenvalues": np.kron(np.eye(16), np.ones((9, 1))),
    }[kind]


@pytest.mark.parametrize("kind", ["plain", "integers", "copies", "few", "flat", "wide", "same eigenvalues"])
def test_updates_equal_the_plain_decomposition(kind):
    x = data(kind)
    whole, first, second = (S.Spectrum(16) for _ in range(3))
    for at, row in enumerate(x):
        whole.add(row)
        (first if at % 3 else second).add(row)
    first.combine(second)
    for found in (whole, first):
        assert found.n == len(x) and np.allclose(found.mean, x.mean(axis=0))
        size = np.abs(scatter(x)).max()
        assert np.abs(found.vectors @ np.diag(found.values) @ found.vectors.T - scatter(x)).max() < 1e-11 * size
        assert np.abs(found.vectors.T @ found.vectors - np.eye(16)).max() < 1e-11


def test_secular_roots_solve_their_equation():
    rng = np.random.default_rng(1)
    for k in (1, 2, 5, 40):
        d = np.sort(rng.uniform(0, 10, k))
        z2 = 10.0 ** rng.uniform(-12, 2, k)
        near, x = S.secular_roots(d, z2)
        roots = np.sort(d[near] + x)
        want = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(z2), np.sqrt(z2)))
        assert np.abs(roots - want).max() < 1e-12 * want.max()


def checked(spark, rows, found, components=8):
    """All columns of the result against exact integers and numpy's eigenvectors."""
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in kept], object)
    n, sums = len(kept), x.sum(axis=0)
    off = ((n * x - sums) / n).astype(float)
    cov = off.T @ off / n
    e, vectors = np.linalg.eigh(cov)
    e, vectors = e[::-1], vectors[:, ::-1]
    k = min(components, int((e > S.NOTHING * e.sum()).sum()))
    want = off @ vectors[:, :k] / np.sqrt(e[:k])
    got = found.collect()
    assert len(got) == n * k
    exact = sorted((i, int(sum((n * row - sums) ** 2))) for (i, _), row in zip(kept, x, strict=True))
    for c in range(1, k + 1):
        mine = sorted((r.vec_id, r.whitened) for r in got if r.component == c)
        plain = sorted(zip((i for i, _ in kept), want[:, c - 1], strict=True))
        values, other = np.array([w for _, w in mine]), np.array([w for _, w in plain])
        assert [i for i, _ in mine] == [i for i, _ in plain]
        if c == k or (e[c - 1] - e[c]) > 1e-6 * e[0]:
            assert min(np.abs(values - other).max(), np.abs(values + other).max()) < 1e-6
        assert sorted((r.vec_id, r.deviation) for r in got if r.component == c) == exact
        assert all(abs(r.explained / (e[c - 1] / e.sum()) - 1) < 1e-9 and r.n == n for r in got if r.component == c)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-8


def test_query_on_whole_table(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    checked(spark, rows, S.op13_spectral_whitening(spark, path))


def test_odd_rows_over_many_parts(spark):
    rng = np.random.default_rng(2)
    some = [(i, rng.normal(0.1, 0.2, 5).tolist(), *"abcd") for i in range(90)]
    nan, inf = float("nan"), float("inf")
    rows = some + [(3, some[3][1], *"abcd")] * 40 + [
        (200, None, *"abcd"), (201, [0.1, None, 0.0, 0.0, 0.0], *"abcd"), (202, [nan] * 5, *"abcd"), (203, [0.0, -inf, 0.0, 0.0, 0.0], *"abcd"), (-7, [0.5] * 5, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, SCHEMA).repartition(20)
    checked(spark, rows, S.whiten(df))
    checked(spark, rows, S.whiten(df, 2), 2)
    without_id = df.filter("vec_id < 5").withColumn("vec_id", S.F.lit(None).cast("long"))
    assert {r.vec_id for r in S.whiten(without_id).collect()} == {None}


def test_nothing_to_whiten(spark):
    df = spark.createDataFrame([(1, [0.5, 0.25], *"abcd"), (2, [0.5, 0.25], *"abcd")], SCHEMA)
    for rows in (df, df.filter("false"), df.limit(1), df.withColumn("embedding", S.F.array().cast("array<float>"))):
        found = S.whiten(rows)
        assert found.collect() == [] and found.columns[:6] == ["vec_id", "component", "n", "deviation", "whitened", "explained"]
    mixed = spark.createDataFrame([(1, [0.5, 0.25], *"abcd"), (2, [0.5], *"abcd")], SCHEMA)
    with pytest.raises(ValueError, match="1 to 2 entries"):
        S.whiten(mixed)


def test_deviation_beyond_a_long_is_null():
    x = np.array([[100_000, 100_000], [4_000_000_000, 100_000]])
    assert S.deviations(2, x, x.sum(axis=0)).to_pylist() == [None, None]
    assert S.deviations(1, x[:1], x[0]).to_pylist() == [0]
