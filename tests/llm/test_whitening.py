"""Rank-one updates and whitening against direct eigendecompositions."""

import math
import os
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from sparkraster.llm import whitening
from sparkraster.llm.common import ship

DATA = "/root/testdata/sf0.001"


def test_secular_roots():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 30))
        d = np.cumsum(rng.exponential(size=n) * 10.0 ** rng.integers(-6, 3)) + 1e-9
        w = rng.exponential(size=n) * 10.0 ** rng.integers(-8, 4, n)
        pole, x = whitening.secular(d, w)
        roots = d[pole] + x
        wanted = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(w), np.sqrt(w)))
        assert np.allclose(roots, wanted, rtol=1e-12, atol=1e-13 * wanted[-1])
        assert (np.diff(roots) >= 0).all() and (roots >= d).all()


@pytest.mark.parametrize("kind", ["random", "few directions", "repeated", "equal values", "scales"])
def test_updates_keep_the_spectrum(kind):
    rng = np.random.default_rng(1)
    d = 16
    rows = {
        "random": rng.normal(size=(300, d)), "few directions": rng.normal(size=(100, 3)) @ rng.normal(size=(3, d)), "repeated": np.repeat(rng.normal(size=(5, d)), 40, 0),
        "equal values": np.vstack([np.eye(d)] * 5), "scales": rng.normal(size=(200, d)) * 10.0 ** np.arange(-8, 8),
    }[kind]
    values, vectors, scatter = np.zeros(d), np.eye(d), np.zeros((d, d))
    for row in rows:
        values, vectors = whitening.updated(values, vectors, row)
        scatter += np.outer(row, row)
    size = np.linalg.norm(scatter)
    assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-11
    assert np.abs(vectors * values @ vectors.T - scatter).max() < 1e-11 * size
    assert (np.diff(values) >= 0).all()


def test_combined_parts_equal_the_whole():
    rng = np.random.default_rng(2)
    x = rng.integers(99_000, 101_000, (500, 12))
    parts = []
    for rows in np.array_split(x, 7):
        part = whitening.Spectrum(12)
        for some in np.array_split(rows, 3 if len(parts) % 2 else 30):  # more or fewer rows than dimensions
            part.add(some)
        parts.append(whitening.Spectrum.of(part.row()))
    first = parts[0]
    for part in parts[1:]:
        first.combine(part)
    assert first.n == 500 and first.sums.tolist() == x.sum(0).tolist()
    wanted = np.linalg.eigvalsh(np.cov(x.T.astype(float), bias=True)) * 500
    assert np.allclose(first.values, wanted, rtol=1e-10)


def checked(got, vectors, key="vec_id", components=8):
    """Every column against its definition."""
    held = [(k, v) for k, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = Counter(len(v) for _, v in held)
    dims = max(sizes, key=lambda s: (sizes[s], s)) if sizes else 0
    held = [(k, [math.floor(1024 * c) + 100000 for c in v]) for k, v in held if len(v) == dims]
    n, many = len(held), min(components, dims)
    assert Counter((r[key], r["component"]) for r in got) == Counter((k, i + 1) for k, _ in held for i in range(many))
    sums = [sum(x[i] for _, x in held) for i in range(dims)]
    deviations = Counter((k, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for k, x in held)
    assert Counter((r[key], r["deviation"]) for r in got if r["component"] == 1) == deviations
    x = np.array([x for _, x in held], float) - np.array([s / n for s in sums])
    e, u = np.linalg.eigh(x.T @ x / n)
    e, u = e[::-1], u[:, ::-1]
    for i in range(many):
        own = [r for r in got if r["component"] == i + 1]
        assert all(r["n"] == n and abs(r["explained"] - max(e[i], 0) / (e.sum() or 1)) <= 1e-9 for r in own)
        if e[i] <= 1e-9 * max(e[0], 1e-300):
            assert all(r["whitened"] is None for r in own)
            continue
        apart = all(abs(e[i] - e[j]) > 1e-6 * e[0] for j in range(dims) if j != i)
        if apart:
            want = sorted(zip((k if k is not None else -1 for k, _ in held), (x @ u[:, i] / np.sqrt(e[i])).tolist()))
            have = ((r[key] if r[key] is not None else -1, r["whitened"]) for r in own)
            have = list(have)
            turned = [sorted((k, sign * h) for k, h in have) for sign in (1, -1)]
            assert any(np.allclose([w for _, w in want], [h for _, h in t], atol=1e-7) for t in turned)
    assert all(0 <= r["identity_error"] <= 1e-4 for r in got) and len({r["identity_error"] for r in got}) <= 1


def test_odd_vectors(spark):
    ship(spark)
    rng = np.random.default_rng(3)
    rows = [(i if i % 9 else None, rng.normal(size=5).tolist()) for i in range(120)] + [(500 + i, [0.25] * 5) for i in range(60)]
    rows += [(700, None), (701, []), (702, [1.0, None, 0.0, 0.0, 0.0]), (703, [float("nan")] * 5), (704, [float("inf")] + [0.0] * 4), (705, [1.0, 2.0]), (1, [0.25] * 5)]
    schema = "vec_id long, embedding array<float>, n int, component string"
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], schema).repartition(40)
    single = [(k, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for k, v in rows]
    checked(whitening.whiten(df).collect(), single)
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id = 701")).collect() == []
    for few in ([(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])], [(1, [0.5, -0.5, 1.0]), (2, [0.0, 0.5, 1.0]), (2, [0.0, 0.25, 1.0])]):
        checked(whitening.whiten(spark.createDataFrame(few, "vec_id long, embedding array<double>")).collect(), few)


def test_deviations_beyond_a_long_are_null():
    x = np.array([[100_000, 100_000], [5_000_000_000, 100_000]])
    n = 10**6
    sums = [100_000 * n + 7, 100_000 * n]
    assert whitening._deviations(x, n, sums) == [49, None]
    assert whitening._deviations(x[:1], 3, [300_001, 299_999]) == [2]


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_query_equals_a_direct_decomposition(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{DATA}/embeddings.parquet").to_pylist()]
    checked(entry.queries()["op13_whitening"](spark, DATA).collect(), vectors)
