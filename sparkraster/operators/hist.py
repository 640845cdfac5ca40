"""Grouped histograms and what windows over bins make of them.

Cells are touched once; everything after ``histogram`` works on a bounded number of
bins per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bin_of(value: Column, low: Column | float, high: Column | float, n: int) -> Column:
    """Uniform bin from 0; the upper edge belongs to the last bin; outside is missing."""
    low, high = (x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high))
    at = F.floor((value - low) / ((high - low) / n)).cast("int")
    return F.when((value >= low) & (value <= high), F.least(at, F.lit(n - 1)))


def histogram(df: DataFrame, keys: list[str], value: str, low: float, high: float, n: int) -> DataFrame:
    """(keys, bin, n, density): counts of the bins that have values, and their density."""
    binned = df.withColumn("bin", bin_of(F.col(value), low, high, n)).where("bin is not null")
    counts = binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys))
    return counts.withColumn("density", F.col("n") / (total * ((high - low) / n)))


def dense(hist: DataFrame, keys: list[str], n: int) -> DataFrame:
    """All bins of every group, empty ones with 0."""
    every = hist.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return every.join(hist, [*keys, "bin"], "left").na.fill(0, ["n"])


def prefix(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)


def suffix(keys: list[str]):
    return Window.partitionBy(*keys).orderBy("bin").rowsBetween(0, Window.unboundedFollowing)


def otsu(df: DataFrame, keys: list[str], value: str, n: int = 256) -> DataFrame:
    """(keys, threshold): the bin centre that parts each group's values with the most variance between."""
    bins = _own_range(df, keys, value, n)
    whole = Window.partitionBy(*keys)
    n1, s1 = F.sum("n").over(prefix(keys)), F.sum(F.col("n") * F.col("bin")).over(prefix(keys))
    bins = bins.withColumns({"n1": n1, "s1": s1, "n2": F.sum("n").over(whole) - n1, "s2": F.sum(F.col("n") * F.col("bin")).over(whole) - s1})
    score = F.round(F.col("n1") * F.col("n2") * F.pow(F.col("s1") / F.col("n1") - F.col("s2") / F.col("n2"), 2), 6)
    best = bins.where("n2 > 0").withColumn("score", score).groupBy(*keys).agg(F.max_by("bin", F.struct("score", -F.col("bin"))).alias("bin"), F.max("low").alias("low"), F.max("step").alias("step"))
    return best.select(*keys, (F.col("low") + (F.col("bin") + 0.5) * F.col("step")).alias("threshold"))


def _own_range(df: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """Histogram over each group's own range, with its low and step; groups of one value have no bins."""
    ends = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high")).where("high > low")
    binned = df.join(ends, keys).withColumn("bin", bin_of(F.col(value), F.col("low"), F.col("high"), n)).where("bin is not null")
    return binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"), F.max("low").alias("low"), F.max((F.col("high") - F.col("low")) / n).alias("step"))


def multi_otsu(df: DataFrame, keys: list[str], value: str, n: int = 256) -> DataFrame:
    """(keys, low_threshold, high_threshold): the two bin centres that part three classes best.

    Pairs of bins, not of cells: n squared at most per group.
    """
    bins = _own_range(df, keys, value, n)
    bins = bins.withColumns({"n1": F.sum("n").over(prefix(keys)), "s1": F.sum(F.col("n") * F.col("bin")).over(prefix(keys))})
    whole = Window.partitionBy(*keys)
    left = bins.select(*keys, F.col("bin").alias("i"), F.col("n1").alias("ni"), F.col("s1").alias("si"), "low", "step")
    right = bins.select(*keys, F.col("bin").alias("j"), F.col("n1").alias("nj"), F.col("s1").alias("sj"), F.max("n1").over(whole).alias("nt"), F.max("s1").over(whole).alias("st"))
    pairs = left.join(right, keys).where("i < j and nj < nt")
    square = lambda s, m: F.pow(F.expr(s), 2) / F.expr(m)
    score = F.round(square("si", "ni") + square("sj - si", "nj - ni") + square("st - sj", "nt - nj"), 6)
    best = pairs.withColumn("score", score).groupBy(*keys).agg(F.max_by(F.struct("i", "j", "low", "step"), F.struct("score", -F.col("i"), -F.col("j"))).alias("b"))
    centre = lambda c: F.col("b.low") + (F.col(c) + 0.5) * F.col("b.step")
    return best.select(*keys, centre("b.i").alias("low_threshold"), centre("b.j").alias("high_threshold"))


def minimum_error(df: DataFrame, keys: list[str], value: str, low: float, high: float, n: int, least: float = 1e-5) -> DataFrame:
    """(keys, bin, threshold): the left bin edge with the least classification error of two normal classes."""
    step = (high - low) / n
    bins = dense(histogram(df, keys, value, low, high, n).drop("density"), keys, n)
    x = F.lit(low) + F.col("bin") * step
    whole = Window.partitionBy(*keys)
    for name, c in (("n", F.col("n")), ("s", F.col("n") * x), ("q", F.col("n") * x * x)):
        bins = bins.withColumn(f"{name}1", F.sum(c).over(prefix(keys)))
    bins = bins.withColumns({f"{c}2": F.max_by(f"{c}1", "bin").over(whole) - F.col(f"{c}1") for c in "nsq"})

    def deviation(i: int) -> Column:
        var = F.expr(f"q{i} / n{i} - pow(s{i} / n{i}, 2)")
        return F.sqrt(F.when((F.col(f"n{i}") > 0) & (var > 1e-12), var).otherwise(least))

    p = F.greatest(F.lit(least), F.least(F.lit(1 - least), F.col("n1") / (F.col("n1") + F.col("n2"))))
    error = p * F.log(deviation(1)) + (1 - p) * F.log(deviation(2)) - p * F.log(p) - (1 - p) * F.log(1 - p)
    best = bins.withColumn("error", F.round(error, 8)).groupBy(*keys).agg(F.min_by("bin", F.struct("error", "bin")).alias("bin"))
    return best.withColumn("threshold", F.lit(low) + F.col("bin") * step)


def halves(df: DataFrame, keys: list[str], value: str, low: float, high: float, n: int) -> DataFrame:
    """(keys, bin, n, s1, .., s4): ``2 n`` bins, -1 for what lies below and 2 n for what lies above; count and power sums, about the middle
    of the range, of the values in each. Rows of groups that become one add up, and everything below works on them."""
    x = F.col(value).cast("double") - (low + high) / 2
    at = F.coalesce(bin_of(F.col(value), low, high, 2 * n), F.when(F.col(value) < low, -1).otherwise(2 * n)).alias("bin")
    rows = df.where(F.col(value).isNotNull()).select(*keys, at, x.alias("_x"))
    return rows.groupBy(*keys, "bin").agg(F.count("*").alias("n"), *[F.sum(F.pow("_x", F.lit(k)) if k > 1 else F.col("_x")).alias(f"s{k}") for k in (1, 2, 3, 4)])


def moments(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, cells, mean, variance, m3, m4) of half-bins, the mean about the middle of the range, central moments of the whole group."""
    sums = parts.groupBy(*keys).agg(F.sum("n").alias("cells"), *[(F.sum(f"s{k}") / F.sum("n")).alias(f"_{k}") for k in (1, 2, 3, 4)])
    return sums.select(
        *keys, "cells", F.col("_1").alias("mean"), F.greatest(F.expr("_2 - _1 * _1"), F.lit(0.0)).alias("variance"), F.expr("_3 - 3 * _1 * _2 + 2 * _1 * _1 * _1").alias("m3"),
        F.expr("_4 - 4 * _1 * _3 + 6 * _1 * _1 * _2 - 3 * _1 * _1 * _1 * _1").alias("m4"),
    )


def bins_of(parts: DataFrame, keys: list[str], n: int) -> DataFrame:
    """(keys, bin, n): whole bins from half-bins."""
    return parts.where(F.col("bin").between(0, 2 * n - 1)).groupBy(*keys, F.expr("bin div 2").cast("int").alias("bin")).agg(F.sum("n").alias("n"))


def between_class_share(df: DataFrame, keys: list[str], value: str, low: float, high: float, n: int) -> DataFrame:
    """(keys, share): the most variance between two parts, split at bin centres, of the whole variance."""
    return share_of(halves(df, keys, value, low, high, n), keys, n)


def share_of(parts: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``between_class_share`` of half-bins: samples fall on a side of each centre; the centre's own bin counts for both parts."""
    facts = moments(parts, keys).select(*keys, "variance")
    inside = parts.where(F.col("bin").between(0, 2 * n - 1)).select(*keys, "bin", "n", F.col("s1").alias("s"))
    rows = dense(inside, keys, 2 * n).na.fill(0.0, ["s"])
    order, whole = Window.partitionBy(*keys).orderBy("bin"), Window.partitionBy(*keys)
    rows = rows.withColumns({"c": F.sum("n").over(prefix(keys)), "t": F.sum("s").over(prefix(keys)), "all_n": F.sum("n").over(whole), "all_s": F.sum("s").over(whole)})
    rows = rows.withColumns({"upto": F.lead("c").over(order), "below": F.coalesce(F.lag("c").over(order), F.lit(0))})
    split = rows.where("bin % 2 = 0 and c > 0 and c < all_n").join(facts, keys)
    share = F.expr("upto / all_n * ((all_n - below) / all_n) * pow(t / c - (all_s - t) / (all_n - c), 2) / variance")
    return split.where("variance > 0").groupBy(*keys).agg(F.max(share).alias("share"))


def histogram_bimodality(df: DataFrame, keys: list[str], value: str, low: float, high: float, n: int) -> DataFrame:
    """(keys, share, separation) from a smoothed histogram alone."""
    return bimodality_of(halves(df, keys, value, low, high, n), keys, low, high, n)


def bimodality_of(parts: DataFrame, keys: list[str], low: float, high: float, n: int) -> DataFrame:
    """``histogram_bimodality`` of half-bins."""
    step = (high - low) / n
    bins = dense(bins_of(parts, keys, n), keys, n)
    order = Window.partitionBy(*keys).orderBy("bin")
    smooth = 0.2261 * F.coalesce(F.lag("n").over(order), F.lit(0)) + 0.5478 * F.col("n") + 0.2261 * F.coalesce(F.lead("n").over(order), F.lit(0))
    bins = bins.withColumn("c", smooth).withColumn("x", F.lit(low) + (F.col("bin") + 0.5) * step).withColumn("m", F.col("c") * F.col("x"))
    bins = bins.withColumn("all", F.sum("c").over(Window.partitionBy(*keys)))
    for side, frame in (("l", prefix(keys)), ("r", suffix(keys))):
        bins = bins.withColumns({f"c{side}": F.sum("c").over(frame), f"m{side}": F.sum("m").over(frame), f"q{side}": F.sum(F.col("m") * F.col("m")).over(frame), f"k{side}": F.count("*").over(frame)})
    bins = bins.where("cl > 1e-9 and cr > 1e-9")
    mean = {s: f"(m{s} / c{s})" for s in "lr"}
    deviation = {s: f"(sqrt(greatest(q{s} - 2 * {mean[s]} * m{s} + k{s} * {mean[s]} * {mean[s]}, 0)) / c{s})" for s in "lr"}
    facts = moments(parts, keys).where("cells > 2 and variance > 0").select(*keys, "cells", F.expr("variance * cells / (cells - 1)").alias("variance"))
    share = F.expr(f"cl / all * (cr / all) * pow({mean['l']} - {mean['r']}, 2) / variance")
    apart = F.expr(f"sqrt(2.0D) * abs({mean['l']} - {mean['r']}) / sqrt(pow({deviation['l']}, 2) + pow({deviation['r']}, 2))")
    return bins.join(facts, keys).groupBy(*keys).agg(F.max(share).alias("share"), F.max(apart).alias("separation"))


def quantiles(df: DataFrame, value: str, shares: list[float], n: int = 4096) -> DataFrame:
    """(share, quantile): exact quantiles of a whole table, linear between two ranks; none of an empty one.

    Values are counted in ``n`` bins first; only those in bins that hold a wanted rank are then ranked, by distinct value
    and within their bin, so that no task sees the table.
    """
    known = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    facts = known.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count("*").alias("cells")).where("cells > 0")  # one row
    ranks = facts.select("cells", F.explode(F.array(*[F.lit(float(p)) for p in shares])).alias("share")).withColumn("at", F.col("share") * (F.col("cells") - 1))
    ranks = ranks.select("share", "at", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank")).distinct()
    binned = known.crossJoin(F.broadcast(facts.select("low", "high")))
    binned = binned.select("v", F.when(F.col("high") > F.col("low"), bin_of(F.col("v"), F.col("low"), F.col("high"), n)).otherwise(0).alias("bin"))
    order = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)  # ``n`` rows
    bins = binned.groupBy("bin").agg(F.count("*").alias("n")).withColumn("end", F.sum("n").over(order))
    wanted = ranks.join(F.broadcast(bins), (F.col("rank") < F.col("end")) & (F.col("rank") >= F.col("end") - F.col("n")))  # a few ranks, ``n`` bins
    starts = wanted.select("bin", (F.col("end") - F.col("n")).alias("start")).distinct()
    within = Window.partitionBy("bin").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = binned.join(F.broadcast(starts), "bin").groupBy("bin", "start", "v").agg(F.count("*").alias("n"))
    ranked = ranked.withColumn("end", F.col("start") + F.sum("n").over(within)).select("bin", "v", "end", (F.col("end") - F.col("n")).alias("begin"))
    hits = ranked.join(F.broadcast(wanted.select("share", "at", "rank", "bin")), "bin").where("rank >= begin and rank < end")
    low, high = F.min_by("v", "rank"), F.max_by("v", "rank")
    return hits.groupBy("share", "at").agg((low + (F.col("at") - F.floor("at")) * (high - low)).alias("quantile")).select("share", "quantile")


def tallest_peaks(hist: DataFrame, keys: list[str], n: int, divider: int | DataFrame) -> DataFrame:
    """(keys, low_peak, high_peak): the tallest local peak up to, and from, the dividing bin; else the tallest bin.

    ``divider`` is a bin or a table (keys, divider). A plateau is one run of equal counts, its peak in the middle; runs at an end aren't peaks.
    """
    out = None
    every = dense(hist.select(*keys, "bin", "n"), keys, n)
    every = every.withColumn("divider", F.lit(divider)) if isinstance(divider, int) else every.join(divider, keys)
    for name, test in (("low_peak", F.col("bin") <= F.col("divider")), ("high_peak", F.col("bin") >= F.col("divider"))):
        side = every.where(test)
        order = Window.partitionBy(*keys).orderBy("bin")
        runs = side.withColumn("new", F.coalesce((F.col("n") != F.lag("n").over(order)).cast("int"), F.lit(1))).withColumn("run", F.sum("new").over(order))
        runs = runs.groupBy(*keys, "run").agg(F.max("n").alias("n"), F.floor((F.min("bin") + F.max("bin")) / 2).cast("int").alias("bin"))
        by_run = Window.partitionBy(*keys).orderBy("run")
        peak = (F.lag("n").over(by_run) < F.col("n")) & (F.lead("n").over(by_run) < F.col("n"))
        runs = runs.withColumn("peak", F.coalesce(peak, F.lit(False)).cast("int"))
        best = runs.groupBy(*keys).agg(F.max_by("bin", F.struct("peak", "n", -F.col("bin"))).alias(name))
        out = best if out is None else out.join(best, keys)
    return out
