"""Joins in space: boxes, rings and points meet on lattice cells, then exactly."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import ship

#: Side of a lattice cell.
STEP = 50_000.0


def lattice(df: DataFrame, box: tuple[str, str, str, str], step: float = STEP) -> DataFrame:
    """Every box (xmin, xmax, ymin, ymax) with each lattice cell it touches: columns _x, _y."""
    cover = lambda a, b: F.sequence(F.floor(F.col(a) / step), F.floor(F.col(b) / step))
    return df.withColumn("_x", F.explode(cover(box[0], box[1]))).withColumn("_y", F.explode(cover(box[2], box[3])))


def box_join(left: DataFrame, right: DataFrame, keys: list[str] | None = None, step: float = STEP) -> DataFrame:
    """Pairs of boxes (axmin.. of left, xmin.. of right) that touch, with their common area.

    A pair is kept only at the lattice cell where its common part begins, so it comes once.
    """
    a = lattice(left, ("axmin", "axmax", "aymin", "aymax"), step)
    b = lattice(right, ("xmin", "xmax", "ymin", "ymax"), step)
    x0, y0 = F.greatest("axmin", "xmin"), F.greatest("aymin", "ymin")
    pairs = a.join(b, ["_x", "_y", *(keys or [])]).where((F.col("_x") == F.floor(x0 / step)) & (F.col("_y") == F.floor(y0 / step)))
    wide, high = F.least("axmax", "xmax") - x0, F.least("aymax", "ymax") - y0
    return pairs.where((wide >= 0) & (high >= 0)).withColumn("area", wide * high).drop("_x", "_y")


def ring_of_box(xmin: str, xmax: str, ymin: str, ymax: str) -> Column:
    """A box as a counter-clockwise ring of (x, y)."""
    corner = lambda x, y: F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    return F.array(corner(xmin, ymin), corner(xmax, ymin), corner(xmax, ymax), corner(xmin, ymax))


def _edges(ring: Column) -> Column:
    return F.transform(ring, lambda p, i: F.struct(p.alias("p"), F.element_at(ring, ((i + 1) % F.size(ring) + 1).cast("int")).alias("q")))


def rings_touch(a: Column, b: Column) -> Column:
    """Convex counter-clockwise rings touch unless an edge of one has the other wholly outside."""

    def parted(one: Column, other: Column) -> Column:
        def outside(e: Column) -> Column:
            p, q = e["p"], e["q"]
            return F.forall(other, lambda r: (q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"]) < 0)

        return F.exists(_edges(one), outside)

    return ~parted(a, b) & ~parted(b, a)


def clipped(ring: Column, by: Column) -> Column:
    """The common part of two convex counter-clockwise rings, as a ring: the first one cut along each edge of the other in turn."""

    def cut(left: Column, e: Column) -> Column:
        p, q = e["p"], e["q"]
        side = lambda r: (q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"])

        def kept(f: Column) -> Column:
            a, b = f["p"], f["q"]
            share = side(a) / (side(a) - side(b))
            between = F.struct((a["x"] + share * (b["x"] - a["x"])).alias("x"), (a["y"] + share * (b["y"] - a["y"])).alias("y"))
            none = F.slice(F.array(a), F.lit(1), F.lit(0))
            return F.concat(F.when(side(a) >= 0, F.array(a)).otherwise(none), F.when((side(a) >= 0) != (side(b) >= 0), F.array(between)).otherwise(none))

        return F.flatten(F.transform(_edges(left), kept))

    return F.aggregate(_edges(by), ring, cut)


def ring_area(ring: Column) -> Column:
    """Area of a ring, counter-clockwise above 0; 0 of fewer than three corners."""
    twice = F.aggregate(_edges(ring), F.lit(0.0), lambda total, e: total + (e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]))
    return twice / 2


def ring_join(left: DataFrame, right: DataFrame, a: str, b: str, on: list[str] | None = None) -> DataFrame:
    """Pairs of convex rings ``a`` and ``b`` that share an area, with it; rings meet on lattice cells by their boxes."""

    def boxed(df: DataFrame, ring: str, names: tuple[str, str, str, str]) -> DataFrame:
        x, y = F.transform(ring, lambda r: r["x"]), F.transform(ring, lambda r: r["y"])
        return df.withColumns(dict(zip(names, [F.array_min(x), F.array_max(x), F.array_min(y), F.array_max(y)])))

    pairs = box_join(boxed(left, a, ("axmin", "axmax", "aymin", "aymax")), boxed(right, b, ("xmin", "xmax", "ymin", "ymax")), on)
    # About the corner of the pair's own box, so that little is lost to large coordinates.
    moved = lambda ring: F.transform(ring, lambda r: F.struct((r["x"] - F.col("xmin")).alias("x"), (r["y"] - F.col("ymin")).alias("y")))
    return pairs.withColumn("area", ring_area(clipped(moved(a), moved(b)))).where("area > 0")


def inside_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd rule: an odd number of edges cross the ray to the right."""

    def crosses(e: Column) -> Column:
        p, q = e["p"], e["q"]
        return ((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"])

    return F.size(F.filter(_edges(ring), crosses)) % 2 == 1


def distance_to_ring(x: Column, y: Column, ring: Column) -> Column:
    """Distance to the nearest edge, for buffers on either side of a shore."""

    def distance(e: Column) -> Column:
        p, q = e["p"], e["q"]
        dx, dy = q["x"] - p["x"], q["y"] - p["y"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - p["x"]) * dx + (y - p["y"]) * dy) / (dx * dx + dy * dy)))
        return F.sqrt(F.pow(x - p["x"] - t * dx, 2) + F.pow(y - p["y"] - t * dy, 2))

    return F.array_min(F.transform(_edges(ring), distance))


def largest(pairs: DataFrame, by: list[str], name: str) -> DataFrame:
    """The partner with the largest common area; of equals the first by name."""
    order = Window.partitionBy(*by).orderBy(F.desc("area"), name)
    return pairs.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def most_members(groups: DataFrame, sets: DataFrame, members: str, candidates: str, key: str) -> DataFrame:
    """Sets that share the most members with each group; equals are all kept."""
    hit = groups.select(key, F.explode(members).alias("m")).join(sets.select("mgrs_set_id", F.explode(candidates).alias("m")), "m")
    counts = hit.groupBy(key, "mgrs_set_id").agg(F.countDistinct("m").alias("common"))
    return counts.withColumn("_r", F.rank().over(Window.partitionBy(key).orderBy(F.desc("common")))).where("_r = 1").drop("_r")


def split_boxes(df: DataFrame) -> DataFrame:
    """Boxes (left_lon > 0, right_lon < 0) over the antimeridian as two boxes."""
    box = lambda a, b: F.struct(a.cast("double").alias("left_lon"), b.cast("double").alias("right_lon"))
    across = (F.col("left_lon") > 0) & (F.col("right_lon") < 0)
    parts = F.when(across, F.array(box(F.col("left_lon"), F.lit(180.0)), box(F.lit(-180.0), F.col("right_lon")))).otherwise(F.array(box(F.col("left_lon"), F.col("right_lon"))))
    return df.withColumn("_b", F.explode(parts)).drop("left_lon", "right_lon").select("*", "_b.left_lon", "_b.right_lon").drop("_b")


def wrapped_box(lons: Column, lats: Column) -> Column:
    """Bounding box of corners; a span above 340 degrees is one across the antimeridian."""
    wide = F.array_max(lons) - F.array_min(lons) > 340
    shifted = F.transform(lons, lambda x: F.when(x < 0, x + 360).otherwise(x))
    pick = lambda f: F.when(wide, f(shifted)).otherwise(f(lons))
    return F.struct(pick(F.array_min).alias("west"), pick(F.array_max).alias("east"), F.array_min(lats).alias("south"), F.array_max(lats).alias("north"))


def hull(cells: DataFrame, key: str) -> DataFrame:
    """Convex hull of each scene's cells: lines shrink to their ends first, so a task holds two points a line."""
    ends = cells.groupBy(key, "row").agg(F.min("col").alias("a"), F.max("col").alias("b"))

    def chain(frame: pd.DataFrame) -> pd.DataFrame:
        points = sorted({(int(r), int(c)) for r, a, b in zip(frame["row"], frame["a"], frame["b"]) for c in (a, b)})

        def half(order: list) -> list:
            out: list = []
            for p in order:
                while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                    out.pop()
                out.append(p)
            return out

        ring = half(points)[:-1] + half(points[::-1])[:-1] if len(points) > 2 else points
        return pd.DataFrame({key: [frame[key].iloc[0]] * len(ring), "turn": range(len(ring)), "row": [p[0] for p in ring], "col": [p[1] for p in ring]})

    ship(cells.sparkSession)
    kind = dict(cells.dtypes)[key]
    return ends.groupBy(key).applyInPandas(chain, f"{key} {kind}, turn int, row int, col int")
