"""Coarser and finer grids by keys: blocks are group keys, nearest neighbours equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo


def block(column: str, size: int) -> Column:
    return F.floor(F.col(column) / size).cast("int")


def multilook(df: DataFrame, size: int, value: str = "value") -> DataFrame:
    """Sum, positive cells and their mean per block; a last block of half its lines or fewer is dropped."""
    rows = df.groupBy(block("row", size).alias("row"), block("col", size).alias("col"))
    return rows.agg(
        F.sum(value).alias("total"), F.count_if(F.col(value) > 0).alias("positive"),
        F.when(F.count_if(F.col(value) > 0) > 0, F.sum(value) / F.count_if(F.col(value) > 0)).alias("mean"), F.countDistinct("row").alias("lines"),
    ).where(F.col("lines") >= size // 2 + 1).drop("lines")


def split_cells(df: DataFrame, parts: int) -> DataFrame:
    """Every cell as parts x parts cells of a finer grid."""
    both = F.explode(F.sequence(F.lit(0), F.lit(parts * parts - 1)))
    fine = df.withColumn("_k", both)
    return fine.withColumn("row", F.expr(f"cast(row * {parts} + _k div {parts} as int)")).withColumn("col", F.expr(f"cast(col * {parts} + _k % {parts} as int)")).drop("_k")


def regrid(df: DataFrame, source: int, target: int, value: str) -> DataFrame:
    """Multilook from one spacing to a coarser one that isn't its multiple: split to the common divisor, then sum."""
    from math import gcd

    step = gcd(source, target)
    fine = split_cells(df, source // step)
    return fine.groupBy(block("row", target // step).alias("row"), block("col", target // step).alias("col")).agg(F.sum(value).alias(value))


def nearest(target: DataFrame, source: DataFrame, spacing: float, source_spacing: float, offset: tuple[float, float] = (0.0, 0.0), missing: int | None = None, value: str = "value") -> DataFrame:
    """The source cell under every target cell's centre; the missing code where there is none."""
    y = (F.col("row") + 0.5) * spacing - offset[0]
    x = (F.col("col") + 0.5) * spacing - offset[1]
    keyed = target.withColumn("_r", F.floor(y / source_spacing).cast("int")).withColumn("_c", F.floor(x / source_spacing).cast("int"))
    found = source.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(value).alias("_v"))
    out = keyed.join(found, ["_r", "_c"], "left")
    return out.withColumn(value, F.col("_v") if missing is None else F.coalesce("_v", F.lit(missing))).drop("_r", "_c", "_v")


def overviews(df: DataFrame, factors: tuple[int, ...], code: str, value: str) -> DataFrame:
    """All levels of a pyramid in one job: the code at each block's centre and the mean of the values."""
    rows = df.withColumn("factor", F.explode(F.array(*[F.lit(f) for f in factors])))
    half = F.expr("cast(factor div 2 as int)")
    centre = (F.col("row") % F.col("factor") == half) & (F.col("col") % F.col("factor") == half)
    keys = [F.col("factor"), F.expr("cast(row div factor as int)").alias("row"), F.expr("cast(col div factor as int)").alias("col")]
    return rows.groupBy(*keys).agg(F.max(F.when(centre, F.col(code))).alias(code), F.avg(value).alias(value))


def halo_keys(column: str, size: int, halo: int, most: str | Column) -> Column:
    """The tiles whose halo holds a line: its own and those within ``halo`` lines, within [0, most]."""
    first = F.greatest(F.lit(0), F.floor((F.col(column) - halo) / size))
    last = F.least(F.floor((F.col(column) + halo) / size), F.col(most) if isinstance(most, str) else most)
    return F.sequence(first.cast("int"), last.cast("int"))


def cut_to_tiles(points: DataFrame, tiles: DataFrame, spacing: float) -> DataFrame:
    """Points (x, y) in the boxes of tiles: (mgrs_tile, row, col), row counted from the north.

    Boxes and points meet on cells of a coarse lattice, so neither side is broadcast whole.
    """
    step = 25000.0
    cover = lambda a, b: F.sequence(F.floor(F.col(a) / step), F.floor(F.col(b) / step))
    boxes = tiles.withColumn("_x", F.explode(cover("xmin", "xmax"))).withColumn("_y", F.explode(cover("ymin", "ymax")))
    keyed = points.withColumn("_x", F.floor(F.col("x") / step)).withColumn("_y", F.floor(F.col("y") / step))
    inside = (F.col("x") >= F.col("xmin")) & (F.col("x") < F.col("xmax")) & (F.col("y") > F.col("ymin")) & (F.col("y") <= F.col("ymax"))
    out = keyed.join(boxes, ["_x", "_y"]).where(inside)
    return out.withColumns({"row": F.floor((F.col("ymax") - F.col("y")) / spacing).cast("int"), "col": F.floor((F.col("x") - F.col("xmin")) / spacing).cast("int")}).drop("_x", "_y")


def reprojected(target: DataFrame, source: DataFrame, zone: int, source_zone: int, spacing: float, origin: tuple[float, float], source_origin: tuple[float, float], value: str = "value") -> DataFrame:
    """The source cell, in another zone, under the centre of every target cell (row, col); missing where there is none.

    Origins are (x, y) of the upper left corners. Cells meet by an equi-join on the source's rows and columns.
    """
    x, y = F.lit(origin[0]) + (F.col("col") + 0.5) * spacing, F.lit(origin[1]) - (F.col("row") + 0.5) * spacing
    at = target.select("row", "col", geo.from_utm(x, y, F.lit(zone)).alias("g"))
    at = at.select("row", "col", geo.to_utm(F.col("g.lon"), F.col("g.lat"), F.lit(source_zone)).alias("p"))
    row, col = F.floor((F.lit(source_origin[1]) - F.col("p.y")) / spacing).cast("int"), F.floor((F.col("p.x") - F.lit(source_origin[0])) / spacing).cast("int")
    found = source.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(value).alias(value))
    return at.select("row", "col", row.alias("_r"), col.alias("_c")).join(found, ["_r", "_c"], "left").select("row", "col", value)
