"""Windows of every size against windows made cell by cell."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkraster.operators import bimodal, hist, pyramid, thresholds
from sparkraster.operators.morph import kept

KEYS = pyramid.KEYS


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(0)
    rows = []
    for r in range(50):
        for c in range(37):
            v = float(rng.normal(-18 if (r // 7 + c // 9) % 2 else -8, 1.5))
            rows.append((r, c, None if rng.random() < 0.1 else v, bool(rng.random() < 0.3)))
    return kept(spark.createDataFrame(rows, "row int, col int, v double, wet boolean"), "cells")


def by_cells(cells, sizes):
    parts = [thresholds.windows(cells, s) for s in sizes]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return kept(out, "windowed")


def test_moments_of_all_sizes(cells):
    sizes = pyramid.halved(32, 4)
    assert sizes == (32, 16, 8, 4)
    ours = {tuple(r[k] for k in KEYS): r for r in pyramid.moments(cells, "v", sizes, "wet").collect()}
    wanted = by_cells(cells, sizes).groupBy(*KEYS).agg(F.avg("v").alias("mean"), F.var_pop("v").alias("var"), F.count("v").alias("valid"), F.count_if("wet").alias("wet"), F.count("*").alias("cells")).collect()
    assert len(wanted) == len(ours)
    for r in wanted:
        o = ours[tuple(r[k] for k in KEYS)]
        assert (o["valid"], o["wet"], o["cells"]) == (r["valid"], r["wet"], r["cells"])
        if r["valid"]:
            assert abs(o["mean"] - r["mean"]) < 1e-9 and abs(o["m2"] / o["valid"] - r["var"]) < 1e-9


def test_measures_of_all_sizes(cells):
    sizes, bins = (16, 8), (-25.0, -2.0, 46)
    parts = kept(pyramid.halves(cells, "v", sizes, *bins), "halves")
    windowed = by_cells(cells, sizes)
    for ours, wanted in (
        (hist.share_of(parts, KEYS, bins[2]), hist.between_class_share(windowed, KEYS, "v", *bins)),
        (hist.bimodality_of(parts, KEYS, *bins), hist.histogram_bimodality(windowed, KEYS, "v", *bins)),
        (bimodal.verdict_of(parts, KEYS, *bins).drop("mu1", "sd1", "mu2", "sd2", "amp1", "amp2", "overlap"), bimodal.verdict(windowed, KEYS, "v", *bins)),
    ):
        names = [c for c in ours.columns if c not in KEYS]
        theirs = {tuple(r[k] for k in KEYS): r for r in wanted.collect()}
        for r in ours.collect():
            w = theirs[tuple(r[k] for k in KEYS)]
            for c in names:
                a, b = r[c], w[c]
                assert a == b or (a is not None and b is not None and abs(a - b) <= 1e-6 * max(1, abs(b))), (c, a, b)


def test_moments_of_values(cells):
    v = np.array([r[0] for r in cells.where("v is not null").select("v").collect()])
    m = hist.moments(hist.halves(cells.withColumn("k", F.lit(1)), ["k"], "v", -20.0, -5.0, 10), ["k"]).first()
    d = v - v.mean()
    assert m["cells"] == len(v) and abs(m["mean"] - (v.mean() + 12.5)) < 1e-9
    for name, k in (("variance", 2), ("m3", 3), ("m4", 4)):
        assert abs(m[name] - (d**k).mean()) < 1e-8 * max(1, abs((d**k).mean()))


def test_cells_of_chosen_windows(cells):
    sizes = (16, 8, 4)
    chosen = kept(by_cells(cells, sizes).select(*KEYS).distinct().where("pmod(window_row * 7 + window_col * 3 + window_size, 5) = 0"), "chosen")
    ours = pyramid.cells_of(cells, chosen, 2).select(*KEYS, "row", "col")
    wanted = by_cells(cells, sizes).join(chosen, KEYS, "left_semi").select(*KEYS, "row", "col")
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, wanted.collect()))


def test_windows_are_halved_while_too_few_pass(cells):
    stats = kept(thresholds.window_stats(cells.withColumn("p", F.pow(F.lit(10.0), F.col("v") / 10)), "p", (32, 16, 8, 4), "wet"), "stats")
    limits = {"variation": 0.0, "low": 0.0, "high": 9.0, "water": (-1, 2)}
    counts = {r[0]: r[1] for r in stats.groupBy("window_size").count().collect()}
    assert {r[0] for r in thresholds.selected(stats, wanted=0, **limits).select("window_size").distinct().collect()} == {32}
    assert {r[0] for r in thresholds.selected(stats, wanted=counts[32], **limits).select("window_size").distinct().collect()} == {32, 16}
    assert {r[0] for r in thresholds.selected(stats, wanted=10**9, **limits).select("window_size").distinct().collect()} == {32, 16, 8, 4}
