"""Threshold surfaces: windows, walks between modes, interpolation to cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.maths import normal_cdf
from ..sources.tiles import floats, groups, sorted_apply
from . import bimodal, hist, pyramid
from .morph import kept


def windows(df: DataFrame, size: int) -> DataFrame:
    """Every cell with each window that covers it: squares of ``size`` that begin every half size (at most four)."""
    half = size // 2

    def starts(column: str) -> Column:
        last = F.floor(F.col(column) / half)
        return F.sequence(F.greatest(last - 1, F.lit(0)).cast("int"), last.cast("int"))

    return df.withColumn("window_row", F.explode(starts("row"))).withColumn("window_col", F.explode(starts("col"))).withColumn("window_size", F.lit(size))


def window_stats(df: DataFrame, value: str, sizes: tuple[int, ...], water: str) -> DataFrame:
    """Mean, deviation, variation and ratio to the global mean of every window of more than a third valid cells, with its water share.

    ``sizes`` are halves of each other; cells are counted once, whatever their number (``pyramid``).
    """
    overall = df.agg(F.avg(value).alias("overall"))  # one row
    found = pyramid.moments(df, value, sizes, water).where("valid > window_size * window_size / 3")
    found = found.select(*pyramid.KEYS, F.expr("total / valid").alias("mean"), F.expr("sqrt(m2 / valid)").alias("deviation"), "valid", F.expr("wet / cells").alias("water")).crossJoin(F.broadcast(overall))
    return found.withColumns({"variation": F.col("deviation") / F.col("mean"), "ratio": F.col("mean") / F.col("overall")}).drop("overall")


def selected(stats: DataFrame, wanted: int = 20, least: int = 40, variation: float = 0.09, low: float = 0.8, high: float = 0.97, water: tuple[float, float] = (0.02, 0.98)) -> DataFrame:
    """Windows that pass every test, of the largest size and of smaller ones as long as too few were found."""
    passed = (F.col("water") > water[0]) & (F.col("water") < water[1]) & (F.col("variation") >= variation) & (F.col("ratio").between(low, high))
    hits = stats.where(passed)
    found = hits.groupBy("window_size").agg(F.count("*").alias("found"))  # a row per size
    sizes = stats.select("window_size").distinct().join(found, "window_size", "left").na.fill(0)
    before = Window.orderBy(F.desc("window_size")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("earlier", F.coalesce(F.sum("found").over(before), F.lit(0))).where(F.col("earlier") <= wanted)
    return hits.join(F.broadcast(sizes.select("window_size")), "window_size")


def selected_by_all(stats: DataFrame, parts: DataFrame, bins: tuple[float, float, int], share: float = 0.7, **tests) -> DataFrame:
    """Windows that pass the tests of ``selected``, have two modes and a large share of variance between two classes.

    The tests are joined before sizes are chosen, so windows are halved for as long as too few pass all of them. ``parts`` are the half-bins of
    the windows (``pyramid.halves``) over ``bins``, range and number; ``tests`` are the limits of ``selected``.
    """
    keys = pyramid.KEYS
    parts = kept(parts.join(stats.select(*keys), keys, "left_semi"), "parts")
    modes = bimodal.verdict_of(parts, keys, *bins).where("bimodal").select(*keys)
    apart = hist.share_of(parts, keys, bins[2]).where(F.col("share") > share).select(*keys)
    return selected(stats.join(modes, keys, "left_semi").join(apart, keys, "left_semi"), **tests)


def walked(df: DataFrame, low: float = 0.98, high: float = 0.02, fraction: float = 0.05, most: int = 100) -> DataFrame:
    """Thresholds moved towards the second mode until the modes' shares are met: columns threshold, mean1, std1, mean2, std2.

    Step k stands at mean2 - (mean2 - t0) (1 - fraction)^k, so the first step that meets them is a minimum over steps.
    """
    steps = df.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(most))))
    at = F.col("mean2") - (F.col("mean2") - F.col("threshold")) * F.pow(F.lit(1 - fraction), F.col("k"))
    steps = steps.withColumn("at", at)
    open_ = (normal_cdf(F.col("at"), F.col("mean1"), F.col("std1")) < low) & (normal_cdf(F.col("at"), F.col("mean2"), F.col("std2")) < high)
    keys = df.columns
    return steps.where(~open_ | (F.col("k") == most)).groupBy(*keys).agg(F.min(F.struct("k", "at")).alias("s")).select(*keys, F.col("s.k").cast("int").alias("steps"), F.col("s.at").alias("moved"))


def block_median(points: DataFrame, keys: list[str], value: str) -> DataFrame:
    return points.groupBy(*keys).agg(F.expr(f"percentile({value}, 0.5)").alias(value))


def inverse_distance(blocks: DataFrame, points: DataFrame, radius: int = 2, power: float = 0.5, smoothing: float = 1.0) -> DataFrame:
    """A value for every block (row, col) from points within ``radius``; where there is none, linear between points or the nearest's (``filled_points``).

    Points are spread to the blocks they reach, so that blocks and points meet by an equi-join.
    """
    reach = F.sequence(F.lit(-radius), F.lit(radius))
    near = points.select(F.explode(reach).alias("dr"), F.col("row").alias("pr"), F.col("col").alias("pc"), "value").select("*", F.explode(reach).alias("dc"))
    near = near.select((F.col("pr") + F.col("dr")).alias("row"), (F.col("pc") + F.col("dc")).alias("col"), "pr", "pc", "value")
    square = F.pow(F.col("row") - F.col("pr"), 2) + F.pow(F.col("col") - F.col("pc"), 2)
    weight = 1 / F.pow(square + smoothing**2, power / 2)
    found = blocks.join(near, ["row", "col"]).groupBy("row", "col").agg((F.sum(weight * F.col("value")) / F.sum(weight)).alias("value"))
    missing = kept(blocks.select("row", "col").join(found, ["row", "col"], "left_anti"), "blocks")
    if not missing.limit(1).count() or not points.limit(1).count():
        return found
    return found.unionByName(filled_points(missing, kept(points.select(F.col("row").alias("pr"), F.col("col").alias("pc"), "value"), "points"), 2 * radius))


def triangle_of(q: np.ndarray, points: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The Delaunay triangle around ``q``, as places in ``points`` and shares of its corners; None outside all points.

    Over the points lifted to their squares the triangle is the lowest one above ``q``: a linear programme with three unknowns,
    solved by exchanging one corner at a time for the point that lies lowest under the triangle's plane.
    """
    far = 4 * (np.abs(points - q).max() + 1)
    corners = q + far * np.array([[0.0, 2.0], [-2.0, -1.0], [2.0, -1.0]])  # of no point: they go first
    at = np.concatenate([points, corners])
    height = np.concatenate([weights, np.full(3, 1e3 * (far * far + (np.abs(weights).max() if len(weights) else 0) + 1))])
    basis = np.arange(len(points), len(points) + 3)
    for _ in range(20 * len(at)):
        matrix = np.column_stack([at[basis], np.ones(3)]).T
        shares = np.linalg.solve(matrix, np.append(q, 1.0))
        plane = np.linalg.solve(matrix.T, height[basis])
        under = height - at @ plane[:2] - plane[2]
        under[basis] = 0
        new = int(under.argmin())
        if under[new] > -1e-9 * max(1.0, np.abs(height[basis]).max() if basis.max() < len(points) else 1.0):
            break
        change = np.linalg.solve(matrix, np.append(at[new], 1.0))
        ratio = np.where(change > 1e-12, shares / np.where(change > 1e-12, change, 1), np.inf)
        basis[int(ratio.argmin())] = new
    return None if basis.max() >= len(points) else (basis, shares)


def filled_points(blocks: DataFrame, points: DataFrame, reach: int) -> DataFrame:
    """A value for every block from points (pr, pc, value): linear in the Delaunay triangle around it, outside all points the nearest's.

    Squares of ``reach`` meet with their neighbours; a triangle whose circle lies inside what was met is that of all points. Blocks
    without one are tried again with twice the reach, until all points were met.
    """
    ends = points.agg(F.min("pr"), F.max("pr"), F.min("pc"), F.max("pc"), F.avg("pr"), F.avg("pc")).first()  # one row
    out, outside = None, None
    while True:
        found = kept(_in_squares(blocks, points, reach, tuple(ends)), "linear")
        good, bad = found.where("state = 0").select("row", "col", "value"), found.where("state = 2").select("row", "col")
        out = good if out is None else out.unionByName(good)
        outside = bad if outside is None else outside.unionByName(bad)
        blocks = found.where("state = 1").select("row", "col")
        if not blocks.limit(1).count():
            break
        reach *= 2
    outside = kept(outside, "outside")
    return out.unionByName(nearest_points(outside, points, reach)) if outside.limit(1).count() else out


def _in_squares(blocks: DataFrame, points: DataFrame, reach: int, ends: tuple) -> DataFrame:
    """(row, col, value, state): 0 with a value, 1 not settled by the points met, 2 outside all points."""
    kinds = pa.schema([("row", pa.int32()), ("col", pa.int32()), ("value", pa.float64()), ("state", pa.int32())])

    def spread(x: np.ndarray) -> np.ndarray:
        """A small number of each place, so that no four points lie on one circle."""
        return 1e-5 * np.modf(np.abs(np.sin(x[:, 0] * 12.9898 + x[:, 1] * 78.233)) * 43758.5453)[0]

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        column = {c: floats(table.column(c)) for c in ("_r", "_c", "kind", "y", "x", "value")}
        rows = []
        for a, b in groups(table, ["_r", "_c"]):
            own = {c: v[a:b] for c, v in column.items()}
            met = own["kind"] == 1
            at, value = np.stack([own["y"][met], own["x"][met]], 1), own["value"][met]
            low = np.array([own["_r"][0] * reach, own["_c"][0] * reach]) - reach
            high = low + 3 * reach - 1
            whole_ = low[0] <= ends[0] and high[0] >= ends[1] and low[1] <= ends[2] and high[1] >= ends[3]
            for y, x in zip(own["y"][~met], own["x"][~met]):
                # Next to nothing off towards the middle of all points: no block lies on their outline, and hardly one on an edge.
                q = np.array([y, x]) + 1e-7 * (np.array(ends[4:]) - (y, x)) + np.array([1.3e-11, 0.7e-11])
                found = triangle_of(q - (y, x), at - (y, x), ((at - (y, x)) ** 2).sum(1) + spread(at)) if len(at) else None
                state, level = (2 if whole_ else 1), None
                if found is not None:
                    corner = at[found[0]]
                    left = np.column_stack([2 * (corner[1:] - corner[0])])
                    centre = np.linalg.solve(left, (corner[1:] ** 2).sum(1) - (corner[0] ** 2).sum())
                    radius = np.sqrt(((corner[0] - centre) ** 2).sum()) + 1e-3
                    if whole_ or ((centre - radius >= low) & (centre + radius <= high)).all():
                        state, level = 0, float(found[1] @ value[found[0]])
                rows.append({"row": int(y), "col": int(x), "value": level, "state": state})
            if len(rows) > 5000:
                yield pa.RecordBatch.from_pylist(rows, kinds)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, kinds)

    square = lambda c: F.floor(F.col(c) / reach).cast("int")
    asked = blocks.select(square("row").alias("_r"), square("col").alias("_c"), F.lit(0).alias("kind"), F.col("row").alias("y"), F.col("col").alias("x"), F.lit(None).cast("double").alias("value"))
    around = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (-1, 0, 1) for c in (-1, 0, 1)]))
    near = points.withColumn("_o", around).select((square("pr") + F.col("_o.r")).alias("_r"), (square("pc") + F.col("_o.c")).alias("_c"), F.lit(1).alias("kind"), F.col("pr").alias("y"), F.col("pc").alias("x"), "value")
    near = near.join(asked.select("_r", "_c").distinct(), ["_r", "_c"], "left_semi")
    return sorted_apply(asked.unionByName(near), ["_r", "_c"], run, "row int, col int, value double, state int")


def nearest_points(blocks: DataFrame, points: DataFrame, reach: int) -> DataFrame:
    """The value of the nearest point (pr, pc, value) for every block; of equally near ones the first.

    Squares of ``reach`` meet with their neighbours; what has no point that near is tried again with twice the reach.
    """
    out = None
    while True:
        square = lambda c, reach=reach: F.floor(F.col(c) / reach)
        around = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (-1, 0, 1) for c in (-1, 0, 1)]))
        spread = points.withColumn("_o", around).select("pr", "pc", "value", (square("pr") + F.col("_o.r")).alias("_r"), (square("pc") + F.col("_o.c")).alias("_c"))
        far = F.pow(F.col("row") - F.col("pr"), 2) + F.pow(F.col("col") - F.col("pc"), 2)
        pairs = blocks.withColumns({"_r": square("row"), "_c": square("col")}).join(spread, ["_r", "_c"]).withColumn("far", far).where(F.col("far") <= reach * reach)
        near = kept(pairs.groupBy("row", "col").agg(F.min_by("value", F.struct("far", "pr", "pc")).alias("value")), "near")
        out = near if out is None else out.unionByName(near)
        blocks = kept(blocks.join(near, ["row", "col"], "left_anti"), "blocks")
        if not blocks.limit(1).count():
            return out
        reach *= 2


def below(cells: DataFrame, surface: DataFrame, block: int, value: str) -> DataFrame:
    """Initial water: cells darker than their block's threshold."""
    keyed = cells.withColumns({"_r": F.floor(F.col("row") / block).cast("int"), "_c": F.floor(F.col("col") / block).cast("int")})
    surface = surface.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col("value").alias("threshold"))
    return keyed.join(surface, ["_r", "_c"], "left").withColumn("water", F.coalesce(F.col(value) < F.col("threshold"), F.lit(False))).drop("_r", "_c")


def upper_bound(df: DataFrame, value: str, inside: str) -> DataFrame:
    """Highest plausible threshold over reference water of one mode: max(99.5th percentile, mean) and two deviations."""
    chosen = df.where(inside)
    stats = chosen.agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation"))  # one row each
    tall = hist.quantiles(chosen, value, [0.995]).agg(F.max("quantile").alias("p"))
    return stats.crossJoin(F.broadcast(tall)).select((F.greatest("p", "mean") + 2 * F.col("deviation")).alias("bound"))


def upper_bound_by_modes(df: DataFrame, value: str, inside: str, low: float = -35.0, high: float = 10.0, n: int = 450) -> DataFrame:
    """(bound, bimodal, mean, deviation): as ``upper_bound``, from one mode where the reference water has two: the fitted lower one, or
    without a fit what lies above the threshold between them."""
    chosen = kept(df.where(inside).where(F.col(value).isNotNull()).select(F.lit(1).alias("_all"), F.col(value).alias("v")), "reference")
    found = bimodal.verdict(chosen, ["_all"], "v", low, high, n).select("_all", "bimodal", "fitted", "mu1", "sd1")
    parted = chosen.join(hist.otsu(chosen, ["_all"], "v"), "_all", "left")
    brighter = F.when(F.col("v") > F.col("threshold"), F.col("v"))
    stats = parted.groupBy("_all").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"), F.avg(brighter).alias("bm"), F.stddev_pop(brighter).alias("bs"))
    tall = hist.quantiles(chosen, "v", [0.995]).agg(F.max("quantile").alias("p"))  # one row
    two, fitted = F.coalesce("bimodal", F.lit(False)), F.coalesce("fitted", F.lit(False))
    pick = lambda mode, above, whole: F.when(two & fitted, F.col(mode)).when(two, F.col(above)).otherwise(F.col(whole))
    rows = stats.join(found, "_all", "left").crossJoin(F.broadcast(tall)).withColumns({"mean": pick("mu1", "bm", "m"), "deviation": pick("sd1", "bs", "s")})
    return rows.select((F.greatest("p", "mean") + 2 * F.col("deviation")).alias("bound"), two.alias("bimodal"), "mean", "deviation")
