"""Modes of histograms and whether there are two.

Only the fit itself runs in Python, on the bins of a group; all measures are columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.maths import gaussian
from ..sources.folders import ship
from ..sources.tiles import groups, sorted_apply, whole
from . import hist
from .morph import kept

#: Bounds of a mode: mean, deviation, amplitude.
LOWEST, HIGHEST = (-40.0, 1e-3, 0.0), (10.0, 10.0, 1.0)
#: Histograms that are fitted at once.
TOGETHER = 256


def histogram_apply(bins: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``fn`` over the bins of every group."""
    ship(bins.sparkSession)
    return bins.groupBy(*keys).applyInPandas(fn, schema)


def _modes(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    return sum(a * np.exp(-((x - m) ** 2) / 2 / s**2) for m, s, a in p.reshape(-1, 3))


def _slopes(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    columns = []
    for m, s, a in p.reshape(-1, 3):
        e = np.exp(-((x - m) ** 2) / 2 / s**2)
        columns += [a * e * (x - m) / s**2, a * e * (x - m) ** 2 / s**3, e]
    return np.stack(columns, axis=1)


def least_squares(x: np.ndarray, y: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray, steps: int = 80) -> tuple[np.ndarray, float]:
    """Damped Gauss-Newton steps inside bounds; the parameters and the remaining squared error."""
    p = np.clip(start, low, high)
    error, damping = float(((y - _modes(x, p)) ** 2).sum()), 1e-3
    for _ in range(steps):
        j, r = _slopes(x, p), y - _modes(x, p)
        normal = j.T @ j
        step = np.linalg.lstsq(normal + damping * np.diag(np.diag(normal) + 1e-12), j.T @ r, rcond=None)[0]
        new = np.clip(p + step, low, high)
        new_error = float(((y - _modes(x, new)) ** 2).sum())
        if new_error < error:
            done = error - new_error < 1e-12 * max(error, 1e-30)
            p, error, damping = new, new_error, max(damping / 3, 1e-9)
            if done:
                break
        else:
            damping *= 4
            if damping > 1e9:
                break
    return p, error


def least_squares_many(x: np.ndarray, y: np.ndarray, start: np.ndarray, low: np.ndarray, high: np.ndarray, steps: int = 80) -> tuple[np.ndarray, np.ndarray]:
    """``least_squares`` of many histograms over one grid at once: parameters (groups, parameters) and remaining squared errors."""

    def modes(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        m, s, h = (p[:, k::3, None] for k in range(3))
        e = np.exp(-((x - m) ** 2) / 2 / s**2)
        slopes = np.stack([h * e * (x - m) / s**2, h * e * (x - m) ** 2 / s**3, e], 2)
        return (h * e).sum(1), slopes.reshape(len(p), -1, len(x))

    p = np.clip(start, low, high)
    error = ((y - modes(p)[0]) ** 2).sum(1)
    damping, open_ = np.full(len(p), 1e-3), np.arange(len(p))
    for _ in range(steps):
        if not len(open_):
            break
        now = p[open_]
        value, j = modes(now)
        normal = j @ j.transpose(0, 2, 1)
        diagonal = np.einsum("gii->gi", normal)
        damped = normal.copy()
        np.einsum("gii->gi", damped)[:] += damping[open_, None] * (diagonal + 1e-12)
        step = (np.linalg.pinv(damped, hermitian=True) @ (j @ (y[open_] - value)[:, :, None]))[:, :, 0]
        new = np.clip(now + step, low, high)
        new_error = ((y[open_] - modes(new)[0]) ** 2).sum(1)
        old = error[open_]
        better = new_error < old
        done = np.where(better, old - new_error < 1e-12 * np.maximum(old, 1e-30), damping[open_] * 4 > 1e9)
        p[open_[better]], error[open_[better]] = new[better], new_error[better]
        damping[open_] = np.where(better, np.maximum(damping[open_] / 3, 1e-9), damping[open_] * 4)
        open_ = open_[~done]
    return p, error


def dividers(y: np.ndarray, parts: int) -> list[int]:
    """Ends of the parts of a histogram with the most variance between them, parts of equal weight where it has too few bins in use."""
    used = np.flatnonzero(y)
    if len(used) < parts:
        cumulated = np.cumsum(y) / y.sum()
        return [int(np.searchsorted(cumulated, (i + 1) / parts)) for i in range(parts - 1)]
    x = np.arange(len(y), dtype=float)
    n, s = np.concatenate([[0], np.cumsum(y)]), np.concatenate([[0], np.cumsum(y * x)])

    def score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the bins [a, b): squared sum by weight."""
        weight = n[b] - n[a]
        return np.divide((s[b] - s[a]) ** 2, weight, out=np.full(np.broadcast(a, b).shape, -np.inf), where=weight > 0)

    edges, end = np.arange(len(y) + 1), np.array(len(y))
    if parts == 2:
        return [int(np.argmax(score(np.array(0), edges) + score(edges, end))) - 1]
    i, j = edges[:, None], edges[None, :]
    both = np.where(i < j, score(np.zeros_like(i), i) + score(np.minimum(i, j), np.maximum(i, j)) + score(j, np.full_like(j, len(y))), -np.inf)
    low, high = np.unravel_index(int(np.argmax(both)), both.shape)
    return [int(low) - 1, int(high) - 1]


def start_values(x: np.ndarray, y: np.ndarray, modes: int, step: float) -> np.ndarray:
    """Mean, deviation and height of each part between the dividers; a part without weight takes the whole's."""
    ends = [-1, *dividers(y, modes), len(y) - 1]
    start = []
    for a, b in zip(ends, ends[1:]):
        w = np.zeros_like(y)
        w[a + 1 : b + 1] = y[a + 1 : b + 1]
        w = w if w.sum() else y
        mean = (w * x).sum() / w.sum()
        start += [mean, max(np.sqrt((w * (x - mean) ** 2).sum() / w.sum()), step), max(y[np.abs(x - mean).argmin()], 1e-4)]
    return np.array(start)


def fit(bins: DataFrame, keys: list[str], low: float, high: float, n: int, modes: int = 2) -> DataFrame:
    """(keys, mu1, sd1, amp1, .., fitted, error): modes by ascending mean, fitted to the bins' shares.

    Starts from the parts of the histogram between the dividers of most variance; a group of fewer than 3 cells isn't
    fitted. Only bins are in Python, however many cells a group has, and many groups are fitted at once.
    """
    step = (high - low) / n
    names = [f"{c}{i + 1}" for i in range(modes) for c in ("mu", "sd", "amp")]
    x = low + (np.arange(n) + 0.5) * step

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        spans = groups(table, keys)
        at, count = (whole(table.column(c)).to_numpy(zero_copy_only=False) for c in ("bin", "n"))
        for some in range(0, len(spans), TOGETHER):
            own = spans[some : some + TOGETHER]
            a, b = own[0][0], own[-1][1]
            y = np.zeros((len(own), n))
            y[np.repeat(np.arange(len(own)), [v - u for u, v in own]), at[a:b]] = count[a:b]
            total = y.sum(1)
            enough = np.flatnonzero(total >= 3)
            p, error = np.full((len(own), 3 * modes), np.nan), np.full(len(own), np.nan)
            if len(enough):
                shares = y[enough] / total[enough, None]
                start = np.stack([start_values(x, row, modes, step) for row in shares])
                found, error[enough] = least_squares_many(x, shares, start, np.tile(LOWEST, modes), np.tile(HIGHEST, modes))
                found = found.reshape(len(enough), modes, 3)
                p[enough] = np.take_along_axis(found, np.argsort(found[:, :, :1], axis=1, kind="stable"), 1).reshape(len(enough), -1)
            parts = [whole(table.column(k)).take(pa.array([u for u, _ in own])) for k in keys]
            parts += [pa.array(p[:, i], from_pandas=True) for i in range(3 * modes)]
            yield pa.RecordBatch.from_arrays([*parts, pa.array(total >= 3), pa.array(error, from_pandas=True)], [*keys, *names, "fitted", "error"])

    kinds = dict(bins.dtypes)
    schema = ", ".join([f"{k} {kinds[k]}" for k in keys] + [f"{c} double" for c in names] + ["fitted boolean", "error double"])
    return sorted_apply(bins.select(*keys, "bin", F.col("n").cast("double").alias("n")), keys, run, schema)


def valley_mode(modes: DataFrame, keys: list[str], low: float, high: float, n: int, share: float = 0.03) -> DataFrame:
    """(keys, valley): the last bin between the peaks and below the threshold up to which less than ``share`` of the second
    mode lies, else the lower peak. ``modes`` has keys, low_peak, high_peak, threshold, and mu, sd and amp of the second mode."""
    step = (high - low) / n
    bins = modes.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("x", F.lit(low) + (F.col("bin") + 0.5) * step)
    bins = bins.withColumn("g", gaussian("x", F.col("mu"), F.col("sd"), F.col("amp")))
    upto = F.sum("g").over(hist.prefix(keys)) / F.sum("g").over(Window.partitionBy(*keys))
    fits = (F.col("x") > F.col("low_peak")) & (F.col("x") < F.col("high_peak")) & (F.col("x") < F.col("threshold")) & (F.col("upto") < share)
    return bins.withColumn("upto", upto).groupBy(*keys).agg(F.coalesce(F.max(F.when(fits, F.col("x"))), F.max("low_peak")).alias("valley"))


def coefficient() -> Column:
    """Bimodality coefficient of a row of ``hist.moments``, corrected for the sample size."""
    n = F.col("cells").cast("double")
    g1 = F.col("m3") / F.pow("variance", F.lit(1.5)) * F.sqrt(n * (n - 1)) / (n - 2)
    g2 = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (F.col("m4") / F.pow("variance", F.lit(2.0)) - 3) + 6)
    return F.when((n > 3) & (F.col("variance") > 0), (g1 * g1 + 1) / (g2 + 3 * F.pow(n - 1, F.lit(2.0)) / ((n - 2) * (n - 3))))


def metrics(df: DataFrame, keys: list[str], value: str, low: float, high: float, n: int) -> DataFrame:
    """Separation, overlap with the histogram, surface ratio, between-class share at the valley, coefficient."""
    return metrics_of(kept(hist.halves(df, keys, value, low, high, n), "halves"), keys, low, high, n)


def metrics_of(parts: DataFrame, keys: list[str], low: float, high: float, n: int) -> DataFrame:
    """``metrics`` of half-bins; a sample on the valley's centre counts right of it."""
    step = (high - low) / n
    bins = hist.bins_of(parts, keys, n)
    fitted = fit(bins, keys, low, high, n)
    full = hist.dense(bins, keys, n).join(fitted, keys)
    x = F.lit(low) + (F.col("bin") + 0.5) * step
    full = full.withColumn("x", x).withColumn("one", gaussian("x", F.col("mu1"), F.col("sd1"), F.col("amp1"))).withColumn("two", gaussian("x", F.col("mu2"), F.col("sd2"), F.col("amp2")))
    whole = Window.partitionBy(*keys)
    full = full.withColumns({
        "all": F.col("one") + F.col("two"), "total": F.sum("n").over(whole), "left_": F.max_by("bin", F.struct("one", -F.col("bin"))).over(whole),
        "right_": F.max_by("bin", F.struct("two", -F.col("bin"))).over(whole),
    })
    between = (F.col("bin") >= F.greatest(F.lit(0), F.col("left_") - 1)) & (F.col("bin") < F.greatest(F.col("right_"), F.col("left_")))
    full = full.withColumn("valley", F.min_by("bin", F.struct(F.when(between, F.col("all")).otherwise(1e9), "bin")).over(whole))
    sums = full.groupBy(*keys).agg(
        F.sum("one").alias("area1"), F.sum("two").alias("area2"), (F.sum(F.sqrt(F.col("all") * F.col("n"))) / F.sqrt(F.sum("all") * F.sum("n"))).alias("overlap"),
        (F.sum(F.when(F.col("bin") <= F.col("valley"), F.col("n"))) / F.max("total")).alias("p1"), (F.sum(F.when(F.col("bin") >= F.col("valley"), F.col("n"))) / F.max("total")).alias("p2"),
        F.max("valley").alias("valley"),
    )
    side = parts.join(sums.select(*keys, "valley"), keys).withColumn("left_", F.col("bin") <= 2 * F.col("valley"))
    mean = lambda test: F.sum(F.when(test, F.col("s1"))) / F.sum(F.when(test, F.col("n")))
    sides = side.groupBy(*keys).agg(mean(F.col("left_")).alias("m1"), mean(~F.col("left_")).alias("m2"))
    out = fitted.join(sums, keys).join(sides, keys).join(hist.moments(parts, keys), keys)
    return out.select(
        *keys, "cells", "fitted", "mu1", "sd1", "amp1", "mu2", "sd2", "amp2", "overlap", coefficient().alias("coefficient"),
        (F.lit(2**0.5) * F.abs(F.col("mu1") - F.col("mu2")) / F.sqrt(F.pow("sd1", F.lit(2.0)) + F.pow("sd2", F.lit(2.0)))).alias("separation"),
        (F.least("area1", "area2") / F.greatest("area1", "area2")).alias("surface_ratio"),
        F.when(F.col("variance") > 0, F.expr("p1 * p2 * pow(m1 - m2, 2) / variance")).alias("share"),
    )


def verdict(df: DataFrame, keys: list[str], value: str, low: float, high: float, n: int, **limits) -> DataFrame:
    """(keys, bimodal): two of three measures, or far apart, with a fair surface ratio; without a fit the histogram decides. ``limits`` as for ``verdict_of``."""
    return verdict_of(kept(hist.halves(df, keys, value, low, high, n), "halves"), keys, low, high, n, **limits)


def verdict_of(
    parts: DataFrame, keys: list[str], low: float, high: float, n: int, separation: float = 1.5, surface: float = 0.1, share: float = 0.7, coefficient: float | None = 5 / 9
) -> DataFrame:
    """``verdict`` of half-bins. With ``coefficient`` None the coefficient has no vote, so both other measures must hold."""
    shown = hist.bimodality_of(parts, keys, low, high, n).select(*keys, F.col("share").alias("hist_share"), F.col("separation").alias("hist_separation"))
    facts = metrics_of(parts, keys, low, high, n).join(shown, keys, "left")
    sure = lambda c: F.coalesce(c, F.lit(False))
    votes = sure(F.col("separation") > separation).cast("int") + sure(F.col("share") > share).cast("int")
    if coefficient is not None:
        votes = votes + sure(F.col("coefficient") > coefficient).cast("int")
    by_fit = ((votes >= 2) | sure(F.col("separation") > 3)) & sure(F.col("surface_ratio") > surface)
    by_hist = sure(F.col("hist_share") > share) & sure(F.col("hist_separation") > 1.5)
    return facts.withColumn("bimodal", F.when(F.col("fitted") & (F.col("cells") > 4), by_fit).otherwise(by_hist))
