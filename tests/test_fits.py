"""Fits of many histograms at once against one at a time."""

import time

import numpy as np
from pyspark.sql import functions as F

from sparkraster.operators import bimodal, hist


def samples(rng, k):
    a, b = rng.normal(-22, 1 + k % 3 * 0.5, 300), rng.normal(-12 + k % 4, 1.5, 50 + 40 * (k % 7))
    return np.concatenate([a, b]) if k % 5 else a[: k % 4]


def test_many_fits_equal_single_ones():
    rng = np.random.default_rng(0)
    n, low, high = 90, -35.0, 10.0
    step = (high - low) / n
    x = low + (np.arange(n) + 0.5) * step
    rows = [np.histogram(samples(rng, k), n, (low, high))[0].astype(float) for k in range(1, 60) if k % 5]
    y = np.stack([r / r.sum() for r in rows])
    for modes in (2, 3):
        start = np.stack([bimodal.start_values(x, r, modes, step) for r in y])
        bounds = np.tile(bimodal.LOWEST, modes), np.tile(bimodal.HIGHEST, modes)
        p, error = bimodal.least_squares_many(x, y, start, *bounds)
        for i in range(len(y)):
            single, least = bimodal.least_squares(x, y[i], start[i], *bounds)
            assert error[i] <= least * 1.01 + 1e-12
            if modes == 2:
                assert np.allclose(p[i], single, atol=2e-2)


def test_fits_by_group_with_empty_ones(spark):
    rng = np.random.default_rng(1)
    rows = [(None if k == 7 else k, float(v)) for k in range(700) for v in samples(rng, k % 60)]
    df = spark.createDataFrame(rows, "k long, v double")
    bins = hist.histogram(df, ["k"], "v", -35.0, 10.0, 90)
    got = {r["k"]: r for r in bimodal.fit(bins, ["k"], -35.0, 10.0, 90).collect()}
    assert set(got) == {r["k"] for r in bins.select("k").distinct().collect()}
    counts = {r["k"]: r["n"] for r in bins.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    for k, r in got.items():
        assert r["fitted"] == (counts[k] >= 3) and (r["mu1"] is not None) == r["fitted"]
        if r["fitted"]:
            assert r["mu1"] <= r["mu2"]


def test_a_thousand_fits_take_seconds():
    rng = np.random.default_rng(2)
    x = -35 + (np.arange(90) + 0.5) * 0.5
    y = np.stack([np.histogram(samples(rng, 1 + k % 4), 90, (-35, 10))[0] for k in range(1000)]).astype(float)
    y /= y.sum(1)[:, None]
    began = time.process_time()
    for a in range(0, 1000, bimodal.TOGETHER):
        some = y[a : a + bimodal.TOGETHER]
        bimodal.least_squares_many(x, some, np.stack([bimodal.start_values(x, r, 2, 0.5) for r in some]), np.tile(bimodal.LOWEST, 2), np.tile(bimodal.HIGHEST, 2))
    assert time.process_time() - began < 20
