"""Refinement of water masks by land cover, terrain and the statistics of components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.folders import ship
from . import bimodal, components, hist, masks, morph, pyramid, thresholds

COMP = ["comp_row", "comp_col"]


def extended_land(cells: DataFrame, seeds: list, targets: list, least: int = 3, buffer: int = 10, seed: float = 0.9, relaxed: float = 0.7) -> DataFrame:
    """Land classes grown from the dark ones in ``seeds`` (components above ``least`` cells) over ``targets``, away from water.

    ``cells`` has row, col, landcover, dark (bool) and water (bool, near-permanent).
    """
    near = morph.dilate(cells.where("water").select("row", "col"), buffer)
    first = cells.where(masks.landcover_mask(F.col("landcover"), seeds) & F.col("dark")).select("row", "col")
    first = morph.kept(components.larger_than(components.label(first), least).select("row", "col"), "land")
    value = F.when(F.col("_near") == 1, 0.0).when(F.col("_seed") == 1, 1.0).when(masks.landcover_mask(F.col("landcover"), targets) & F.col("dark"), 0.75).otherwise(0.0)
    marked = cells.join(near.withColumn("_near", F.lit(1)), ["row", "col"], "left").join(first.withColumn("_seed", F.lit(1)), ["row", "col"], "left")
    return components.grow(marked.withColumn("land", value), "land", seed, relaxed)


def extended_land_from(cells: DataFrame, targets: list, least: int = 3, buffer: int = 10, seed: float = 0.9, relaxed: float = 0.7) -> DataFrame:
    """Land grown from given cells, the second variant: ``cells`` has row, col, landcover, seed and barred (bools).

    Seeds in components above ``least`` cells grow over all cells of the ``targets``, not into barred ones; a seed of a target class is a
    cell to grow over only. ``buffer`` cells around permanent water take no part.
    """
    wet = cells.where(F.col("landcover") == masks.LANDCOVER["Permanent water bodies"]).select("row", "col")
    near = morph.dilate(wet, buffer).withColumn("_near", F.lit(1))
    first = components.larger_than(components.label(cells.where("seed").select("row", "col")), least).select("row", "col").withColumn("_seed", F.lit(1))
    value = F.when(F.col("_near") == 1, 0.0).when(masks.landcover_mask(F.col("landcover"), targets), 0.75).when(F.col("_seed") == 1, 1.0).otherwise(0.0)
    marked = cells.join(near, ["row", "col"], "left").join(first, ["row", "col"], "left").withColumn("land", value)
    return components.grow(marked, "land", seed, relaxed, excluded=cells.where("barred").select("row", "col"))


def terrain_eroded(water: DataFrame, height: DataFrame, value: str = "hand", spread: float = 2.5) -> DataFrame:
    """Water without boundary cells higher than their component's boundary median plus deviation, until none is left.

    Only components whose first boundary is uneven are touched, and its median and deviation hold for all of the
    erosion (sums are rounded: of two cells neither is above their median and deviation). Taking boundary cells until none is too high equals the 4-components, over a component's cells that
    are too high, that reach its first boundary.
    """
    labels = morph.kept(components.label(water), "water")
    edge = morph.kept(morph.boundary(labels), "boundary")
    cells = morph.kept(labels.join(height.select("row", "col", F.col(value).alias("_h")), ["row", "col"]), "heights")
    uneven = cells.join(edge, ["row", "col"], "left_semi").groupBy(*COMP).agg(F.stddev_pop("_h").alias("s"), F.expr("percentile(_h, 0.5)").alias("m")).where(F.col("s") > spread)
    high = morph.kept(cells.join(morph.facts(uneven, "uneven"), COMP).where(F.col("_h") > F.round(F.col("m") + F.col("s"), 9)).select("row", "col"), "high")
    lost = components.grow_masks(high.join(edge, ["row", "col"], "left_semi"), high, [])
    return labels.join(lost, ["row", "col"], "left_anti").select("row", "col")


#: Tests of the bands between two thresholds: the darker and the brighter side of each, with the shares that bound their histograms.
BAND_TESTS = ((0, 0.01), (1, 0.02), (1, 0.01), (2, 0.02))
#: Fewer values than this are not judged by the second variant; its edge is as many cells wide.
FEW, EDGE = 64, 3


def split_water(water: DataFrame, cells: DataFrame, value: str, least: int = 5000, mode: str = "v1", n: int = 64, low: float = -35.0, high: float = 0.0) -> DataFrame:
    """Bands to take out of large, mixed water bodies: (row, col).

    A body of ``least`` cells or more whose values have two fitted modes is parted by two thresholds into three bands. A band is judged
    together with what surrounds it, as wide as its margin. ``v1``: it goes when its values and those around it, in its own body or on dry
    land, have not two modes. ``v2``: only its cells at the body's edge are judged, with the dry land around them, and it goes when
    they have two modes. A middle band is judged twice, and goes if either test says so. ``cells`` has the values of water and land.
    """
    bodies = morph.kept(components.label(water.select("row", "col")), "bodies")
    values = morph.kept(cells.where(F.col(value).isNotNull()).select("row", "col", value), "values")
    large = morph.facts(components.stats(bodies).where(F.col("size") >= least).select(*COMP), "large")
    held = morph.kept(bodies.join(large, COMP, "left_semi").join(values, ["row", "col"]), "bodies")
    mixed = morph.facts(bimodal.verdict(held, COMP, value, low, high, n).where("bimodal and cells > 4").select(*COMP), "mixed")
    held = morph.kept(held.join(mixed, COMP, "left_semi"), "mixed")
    levels = morph.facts(hist.multi_otsu(held, COMP, value, 100 if mode == "v1" else 64), "levels")
    band = F.when(F.col(value) < F.col("low_threshold"), 0).when(F.col(value) < F.col("high_threshold"), 1).otherwise(2)
    held = morph.kept(held.join(levels, COMP).select(*COMP, "row", "col", value, band.alias("part")), "bands")
    dry = values.select("row", "col").join(water.select("row", "col"), ["row", "col"], "left_anti")
    if mode == "v1":
        judged, private = held, held.select(*COMP, "row", "col")
    else:
        judged, private = held.join(morph.erode(held.select("row", "col"), EDGE), ["row", "col"], "left_anti"), None
    judged = morph.kept(judged.select(*COMP, "part", "row", "col"), "judged")
    around = components.rings(judged, dry, private=private)
    area = morph.kept(morph.unsent(judged.unionByName(around).distinct()).join(values, ["row", "col"]), "area")
    tests = F.explode(F.array(*[F.struct(F.lit(i).alias("test"), F.lit(b).alias("band"), F.lit(s).alias("share")) for i, (b, s) in enumerate(BAND_TESTS if mode == "v1" else [(b, 0.02) for b in range(3)])]))
    tested = area.withColumn("t", tests).where("t.band = part").select(*COMP, "part", "t.test", "t.share", value)
    # Both ends are within a ten-thousandth of the share asked for, in bounded memory.
    keys = [*COMP, "part", "test"]
    ends = tested.groupBy(*keys, "share").agg(F.percentile_approx(value, [0.01, 0.02, 0.98, 0.99], 10_000).alias("e"), F.count("*").alias("many"))
    first = F.when(F.col("share") == 0.01, F.col("e")[0]).otherwise(F.col("e")[1])
    last = F.when(F.col("share") == 0.01, F.col("e")[3]).otherwise(F.col("e")[2])
    ends = morph.facts(ends.select(*keys, first.alias("first"), last.alias("last"), "many"), "ends")
    # In units of its own range, a band's histogram has one grid with all others; no measure depends on the unit.
    scaled = tested.join(ends.where("last > first"), keys).withColumn("_u", (F.col(value) - F.col("first")) / (F.col("last") - F.col("first")))
    facts = bimodal.verdict(scaled, keys, "_u", 0.0, 1.0, n, coefficient=None)
    judged_bands = ends.select(*keys).join(facts.select(*keys, "bimodal", "cells"), keys, "left")
    two = masks.sure(F.col("bimodal"))
    gone = judged_bands.where(~two if mode == "v1" else two & (F.col("cells") >= FEW)).select(*COMP, "part").distinct()
    return morph.unsent(held.join(morph.facts(gone, "gone"), [*COMP, "part"], "left_semi").select("row", "col"))


def _with_rings(labels: DataFrame, allowed: DataFrame, values: DataFrame, value: str, least: int = 1) -> DataFrame:
    """Cells of components and of their rings, ``least`` cells wide at least, with their values: columns core (1 or 0) and the value."""
    core = labels.select(*COMP, "row", "col").withColumn("core", F.lit(1))
    around = components.rings(labels, allowed, least).drop("part").withColumn("core", F.lit(0))
    return morph.kept(morph.unsent(core.unionByName(around)).join(values.select("row", "col", value), ["row", "col"]), "around")


def false_water(water: DataFrame, cells: DataFrame, value: str, least: int = 40, low: float = -35.0, high: float = 0.0, n: int = 64) -> DataFrame:
    """Water whose components look like water: (row, col).

    Small components stay unless they are all land; larger ones with at most 0.8 land stay; of the others
    those stay whose values have two fitted modes together with their surroundings', the core being darker.
    """
    labels = morph.kept(components.label(water), "water")
    land = cells.where("land = 1").select("row", "col")
    facts = morph.kept(components.stats(labels).join(components.portion(labels, land), COMP), "facts")
    dry = cells.join(water.select("row", "col"), ["row", "col"], "left_anti")
    doubtful = morph.facts(facts.where((F.col("size") >= least) & (F.col("portion") > 0.8)).select(*COMP), "doubtful")
    doubtful = morph.kept(labels.join(doubtful, COMP, "left_semi"), "doubtful")
    both = _with_rings(doubtful, dry, cells, value)
    order = both.groupBy(*COMP).agg(F.expr(f"percentile(if(core = 1, {value}, null), 0.5)").alias("inner"), F.expr(f"percentile(if(core = 0, {value}, null), 0.15)").alias("outer"))
    two = bimodal.verdict(both, COMP, value, low, high, n).where("bimodal and cells > 4")
    real = order.where(F.col("inner") < F.col("outer")).join(two, COMP, "left_semi").select(*COMP, F.lit(1).alias("real"))
    keep = facts.join(real, COMP, "left").where(F.expr(f"if(size < {least}, portion <> 1, portion <= 0.8 or real = 1)"))
    return labels.join(morph.facts(keep.select(*COMP), "keep"), COMP, "left_semi").select("row", "col")


def filled_gaps(water: DataFrame, cells: DataFrame, value: str, low: float = -35.0, high: float = 0.0, n: int = 64) -> DataFrame:
    """Bright gaps to be filled: dry components of any size, all but a hundredth reference water, that are of one mode with their surroundings."""
    dry = cells.join(water.select("row", "col"), ["row", "col"], "left_anti")
    labels = morph.kept(components.label(dry.select("row", "col")), "gaps")
    wet = morph.facts(components.portion(labels, cells.where("reference = 1"), share=0.99).where("flag = 1").select(*COMP), "wet")
    gaps = morph.kept(labels.join(wet, COMP, "left_semi"), "gaps")
    both = _with_rings(gaps, water, cells, value, 5)
    two = hist.histogram_bimodality(both, COMP, value, low, high, n).where((F.col("share") > 0.7) & (F.col("separation") > 1.5)).select(*COMP)
    return gaps.join(morph.facts(two, "two"), COMP, "left_anti").select("row", "col")


def dry_bands(bands: DataFrame, dry: DataFrame, share: float = 0.5) -> DataFrame:
    """Cells of those components of ``bands`` that are dry land by more than ``share``."""
    labels = morph.kept(components.label(bands), "bands")
    flagged = morph.facts(components.portion(labels, dry, share=share).where("flag = 1").select(*COMP), "flagged")
    return morph.unsent(labels.join(flagged, COMP, "left_semi").select("row", "col"))


def mask_stage(
    cells: DataFrame, water: DataFrame, value: str, spread: float = 2.5, classes: tuple = ("Bare sparse vegetation", "Urban", "Moss and lichen"), further: tuple = ("Grassland", "Shrubs"),
    mode: str = "v1", large: int = 5000, persistent: float = 0.1, vegetation: str | None = None,
) -> DataFrame:
    """Water without dark land, without dry bands of large bodies and without cells above their banks.

    ``cells`` has row, col, landcover, hand, dark and water (as for ``extended_land``), co_db, cross_db, occurrence and
    the value. Dark land are cells of the classes, grown over the further ones, that are rarely water and dark in both
    bands. Bodies of ``large`` cells are split; of the bands that come off, components that are mostly dry land go. Dry
    land keeps three cells away from what is water for ``persistent`` of the time.

    With ``vegetation``, a column of codes of a second map, masking is that of the second sensor: its land codes count as land, too, land is
    grown from what of both is dark and rarely water, and growth keeps out of its codes for possible water and of what is often water.
    """
    own = masks.landcover_mask(F.col("landcover"), list(classes))
    if vegetation is None:
        land = extended_land(cells, list(classes), list(further))
    else:
        either = own | masks.sure(F.col(vegetation).between(*masks.LAND_CODES))
        seed = masks.dark_land(either, F.col("occurrence"), F.col("co_db"), F.col("cross_db"))
        barred = masks.sure(F.col("occurrence") > persistent) | masks.sure(F.col(vegetation).between(*masks.WATER_CODES))
        land = extended_land_from(cells.select("row", "col", "landcover", masks.sure(seed).alias("seed"), barred.alias("barred")), list(further))
    marked = cells.join(land.withColumn("_land", F.lit(True)), ["row", "col"], "left").withColumn("_land", masks.sure(F.col("_land")) | own)
    marked = morph.kept(marked.select("row", "col", "_land", "occurrence", "co_db", "cross_db"), "land")
    dark = marked.where(masks.dark_land(F.col("_land"), F.col("occurrence"), F.col("co_db"), F.col("cross_db"))).select("row", "col")
    lasting = morph.dilate(marked.where(F.col("occurrence") >= persistent).select("row", "col"), 3)
    dry = morph.kept(marked.where("_land").select("row", "col").join(lasting, ["row", "col"], "left_anti"), "dry")
    bands = split_water(water, cells, value, large, mode)
    left = water.join(dark, ["row", "col"], "left_anti").join(dry_bands(bands, dry), ["row", "col"], "left_anti")
    return terrain_eroded(left, cells, "hand", spread)


def refine_stage(cells: DataFrame, water: DataFrame, value: str, least: int = 40) -> DataFrame:
    """False water taken out, then gaps filled; ``least`` as for ``false_water``."""
    real = morph.kept(false_water(water, cells, value, least), "real")
    return morph.unsent(real.unionByName(filled_gaps(real, cells, value)).distinct())


def window_thresholds(cells: DataFrame, keys: list[str], value: str, bound: tuple[float, float] = (-28.0, -11.0), low: float = -35.0, high: float = 10.0, n: int = 450, method: str = "ki") -> DataFrame:
    """A threshold and a mode per window: minimum error (or equal variance), three classes where it is too high,
    peaks as the mode, fitted modes to walk between, and bounds at the end."""
    step = (high - low) / n
    held = cells.where(F.col(value) > low)
    first = hist.minimum_error(held, keys, value, low, high, n).drop("bin") if method == "ki" else hist.otsu(held, keys, value)
    three = hist.multi_otsu(held, keys, value, 64)
    chosen = first.join(three, keys, "left").withColumn("threshold", F.when((F.col("threshold") > bound[1]) & (F.col("low_threshold") < F.col("threshold")), F.col("low_threshold")).otherwise(F.col("threshold"))).select(*keys, "threshold")
    chosen = morph.kept(chosen, "chosen")
    bins = hist.histogram(held, keys, value, low, high, n)
    divider = chosen.select(*keys, F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((F.col("threshold") - low) / step))).cast("int").alias("divider"))
    peaks = hist.tallest_peaks(bins, keys, n, divider)
    modes = bimodal.fit(bins, keys, low, high, n)
    third = bimodal.fit(bins, keys, low, high, n, 3).select(*keys, F.col("error").alias("error3"), F.col("mu1").alias("t1"), F.col("sd1").alias("s1"), F.col("mu2").alias("t2"), F.col("sd2").alias("s2"))
    # Three modes are taken when they explain the histogram far better and are apart.
    better = F.coalesce((F.col("error3") < 0.5 * F.col("error")) & (F.col("t2") - F.col("t1") > F.col("s1")), F.lit(False))
    facts = chosen.join(peaks, keys).join(modes, keys).join(third, keys)
    facts = facts.withColumns({"mean1": F.when(better, F.col("t1")).otherwise(F.col("mu1")), "std1": F.when(better, F.col("s1")).otherwise(F.col("sd1")), "mean2": F.when(better, F.col("t2")).otherwise(F.col("mu2")), "std2": F.when(better, F.col("s2")).otherwise(F.col("sd2"))})
    facts = facts.withColumn("mode", F.lit(low) + F.col("low_peak") * step)
    known = facts.where("fitted").select(*keys, "mode", "threshold", "mean1", "std1", "mean2", "std2")
    walked = thresholds.walked(known).select(*keys, "mode", F.col("moved").alias("threshold"))
    rest = facts.where("not fitted").select(*keys, "mode", "threshold")
    out = walked.unionByName(rest)
    return out.withColumn("threshold", F.greatest(F.lit(bound[0]), F.least(F.lit(bound[1]), F.col("threshold"))))


def reach(value: np.ndarray, start: float) -> np.ndarray:
    """Of every cell of a grid the least value up to which growth from cells below ``start`` must be allowed to take it in.

    Seeds have their own value; cells without one, and what growth can't reach, are infinite. A component tree in arrays:
    all components without a seed join, at once and again and again, the neighbour that they meet at the least value, the greater of two
    cells'. What a component joins at is no less than what its neighbour joins at, so a cell needs the greatest of its components' values.
    """
    rows, cols = value.shape
    held = np.where(np.isnan(value), np.inf, value).ravel()
    seed, best = held < start, np.full(rows * cols, -np.inf)
    at = np.arange(rows * cols).reshape(rows, cols)
    a, b = (np.concatenate([x.ravel(), y.ravel()]) for x, y in ((at[:, :-1], at[:-1]), (at[:, 1:], at[1:])))
    weight = np.maximum(held[a], held[b])
    order = np.argsort(weight, kind="stable")
    order = order[np.isfinite(weight[order])]
    a, b, weight = a[order], b[order], weight[order]  # by rising value: the first edge of a component is its least
    component = np.arange(rows * cols)
    while True:
        ca, cb = component[a], component[b]
        between = (ca != cb) & ~(seed[ca] & seed[cb])
        a, b, weight, ca, cb = (x[between] for x in (a, b, weight, ca, cb))
        if not len(a):
            break
        least = np.full(rows * cols, -1)
        both, edge = np.stack([ca, cb], 1).ravel(), np.repeat(np.arange(len(a)), 2)
        least[both[::-1]] = edge[::-1]
        least[seed] = -1
        joins = np.flatnonzero(least >= 0)
        e = least[joins]
        other = np.where(ca[e] == joins, cb[e], ca[e])
        to = np.arange(rows * cols)
        to[joins] = other
        mutual = (to[other] == joins) & (joins < other)
        to[joins[mutual]] = joins[mutual]  # the lower of two that join each other stays
        gain = np.full(rows * cols, -np.inf)
        gain[joins] = weight[e]
        best = np.maximum(best, gain[component])
        while not np.array_equal(to, to[to]):
            to = to[to]
        component = to[component]
    best = np.where(seed[component], best, np.inf)
    own = held < start
    return np.where(own, held, best).reshape(rows, cols)


def grown_threshold(cells: DataFrame, keys: list[str], value: str, start: DataFrame, low: float = -35.0, high: float = 10.0, n: int = 450) -> DataFrame:
    """Thresholds relaxed by growth: (keys, threshold). ``start`` has keys, threshold, mean1, std1, amp1.

    Every bin above the threshold is grown to from the cells below it. Between threshold and bin, the share of the
    window's cells that the growth took in is held against the first mode; the bin with the least mean square
    difference (the lowest of equal ones) is averaged with the threshold. A window, bounded by its size, is one group, and
    its pairs of bins and levels (``n`` squared) are an array that only the group sees.
    """
    step = (high - low) / n
    kinds = dict(cells.dtypes)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        first, values = frame.iloc[0], frame[value].to_numpy(float)
        r, c = (frame[x].to_numpy() - frame[x].min() for x in ("row", "col"))
        image = np.full((r.max() + 1, c.max() + 1), np.nan)
        image[r, c] = values
        needed = reach(image, float(first["threshold"]))[r, c]
        base, taken = int(first["base"]), np.isfinite(needed)
        levels = n - 1 - base
        own = np.floor((values[taken] - low) / step).astype(int) - base
        level = np.maximum(1, np.floor((needed[taken] - low) / step).astype(int) - base + 1) - 1
        inside = (own >= 0) & (own < levels) & (level < levels)
        share = np.zeros((levels, levels))
        np.add.at(share, (level[inside], own[inside]), 1)
        share = np.cumsum(share, axis=0) / len(frame)
        x = low + (base + np.arange(levels) + 0.5) * step
        model = first["amp1"] * np.exp(-((x - first["mean1"]) ** 2) / 2 / first["std1"] ** 2)
        # A bin is compared from the first level above it on.
        best = int((np.tril((share - model) ** 2).sum(1) / np.arange(1, levels + 1)).argmin())
        return frame.head(1)[keys].assign(threshold=(first["threshold"] + (low + (base + best + 1) * step)) / 2)

    ship(cells.sparkSession)
    known = start.where("threshold is not null and mean1 is not null and std1 is not null and amp1 is not null")
    base = F.greatest(F.lit(0), F.floor((F.col("threshold") - low) / step).cast("int"))
    known = known.select(*keys, "threshold", "mean1", "std1", "amp1", base.alias("base")).where(F.col("base") < n - 1)
    rows = cells.where(F.col(value).between(low, high)).select(*keys, "row", "col", value).join(known, keys)
    return rows.groupBy(*keys).applyInPandas(run, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", threshold double")


def thresholds_by(cells: DataFrame, keys: list[str], value: str, bound: tuple[float, float] = (-28.0, -3.0), method: str = "ki", low: float = -35.0, high: float = 10.0, n: int = 450) -> DataFrame:
    """(keys, threshold) of every window by the method of that name: ``ki`` minimum error, ``otsu`` equal variance, ``rg`` growth from the latter."""
    if method in ("ki", "otsu"):
        return window_thresholds(cells, keys, value, bound, low, high, n, method).select(*keys, "threshold")
    if method != "rg":
        raise ValueError(f"no method {method}")
    even = window_thresholds(cells, keys, value, bound, low, high, n, "otsu").select(*keys, "threshold")
    modes = bimodal.fit(hist.histogram(cells, keys, value, low, high, n), keys, low, high, n).select(*keys, F.col("mu1").alias("mean1"), F.col("sd1").alias("std1"), F.col("amp1"))
    even = morph.kept(even.join(modes, keys), "even")
    # A window that can't grow, having no fitted mode, keeps its threshold.
    grown = grown_threshold(cells, keys, value, even, low, high, n).withColumnRenamed("threshold", "_grown")
    return even.join(grown, keys, "left").select(*keys, F.coalesce("_grown", "threshold").alias("threshold"))


def threshold_stage(cells: DataFrame, value: str, block: int = 20, water: str | None = None, largest: int | None = None, method: str = "ki", **tests) -> DataFrame:
    """Windows to thresholds to a surface to initial water: cells with threshold and water.

    With ``water``, a column of known water, only windows that pass all tests (``thresholds.selected_by_all``, limits in
    ``tests``) have a threshold: of ``largest`` (eight blocks) and, as long as too few pass, of half that size down to a block; else
    all windows of two blocks have. No window at all gives no threshold and no water. ``method`` as for ``thresholds_by``.
    """
    keys = pyramid.KEYS
    rows = cells.select("row", "col", value)
    if water is not None:
        linear = cells.select("row", "col", F.pow(F.lit(10.0), F.col(value) / 10).alias("_p"), F.col(water).alias("_w"))
        sizes, bins = pyramid.halved(largest or 8 * block, block), (-35.0, 10.0, 90)
        stats = morph.kept(thresholds.window_stats(linear, "_p", sizes, "_w"), "stats")
        chosen = thresholds.selected_by_all(stats, pyramid.halves(rows, value, sizes, *bins), bins, **tests)
        windowed = pyramid.cells_of(rows, morph.kept(chosen.select(*keys), "windows"), min(sizes) // 2)
    else:
        windowed = thresholds.windows(rows, 2 * block)
    points = morph.kept(thresholds_by(morph.kept(windowed, "windowed"), keys, value, method=method), "points")
    at = lambda c: F.floor(F.col(f"window_{c}") * F.col("window_size") / 2 / block).cast("int").alias(c)
    points = thresholds.block_median(points.select(at("row"), at("col"), F.col("threshold").alias("value")), ["row", "col"], "value")
    blocks = cells.select(F.floor(F.col("row") / block).cast("int").alias("row"), F.floor(F.col("col") / block).cast("int").alias("col")).distinct()
    return thresholds.below(cells, thresholds.inverse_distance(blocks, points), block, value)
