"""Mosaics of overlapping scenes and the grid they share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def geogrid(df: DataFrame) -> DataFrame:
    """One grid over boxes (x0, y0, side, spacing, epsg): extent, size, and whether the zones agree."""
    out = df.agg(
        F.min("x0").alias("start_x"), F.max(F.col("x0") + F.col("side")).alias("end_x"), F.max(F.col("y0") + F.col("side")).alias("start_y"), F.min("y0").alias("end_y"),
        F.min("spacing").alias("spacing"), F.countDistinct("epsg").alias("zones"),
    )
    size = lambda a, b: F.floor((F.col(b) - F.col(a)) / F.col("spacing")).cast("int")
    return out.withColumns({"width": size("start_x", "end_x"), "length": size("end_y", "start_y"), "same_zone": (F.col("zones") == 1).cast("int")})


def majority(df: DataFrame, value: str, order: str) -> DataFrame:
    """The most frequent value; of equals the one seen first."""
    counts = df.groupBy(value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.agg(F.max_by(value, F.struct("n", -F.col("first"))).alias(value), F.max("n").alias("n"))


def average(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean of valid values per cell, weighted by looks where given; missing where nothing weighs."""
    valid = F.col("value").isNotNull()
    w = F.coalesce(F.col(weight), F.lit(1.0)) if weight else F.when(F.col("value") > 0, 1.0).otherwise(0.0)
    total = F.sum(F.when(valid, w))
    return df.groupBy("row", "col").agg(F.when(total > 0, F.sum(F.when(valid, F.col("value") * w)) / total).alias("value"), F.count("value").cast("int").alias("scenes"))


def first_valid(df: DataFrame) -> DataFrame:
    """The value of the first scene that has one."""
    return df.where("value is not null").groupBy("row", "col").agg(F.min_by("value", "scene").alias("value"), F.min("scene").alias("scene"))


def nearest_centre(df: DataFrame) -> DataFrame:
    """The value of the scene whose centre of valid cells is nearest; of equals the later scene."""
    valid = df.where("value is not null")
    centres = valid.groupBy("scene").agg(F.avg("row").alias("r0"), F.avg("col").alias("c0"))  # a row per scene
    far = F.round(F.pow(F.col("row") - F.col("r0"), 2) + F.pow(F.col("col") - F.col("c0"), 2), 6)
    held = valid.join(centres, "scene").withColumn("order", F.struct(far.alias("d"), (-F.col("scene")).alias("s")))
    return held.groupBy("row", "col").agg(F.min_by("value", "order").alias("value"), F.min_by("scene", "order").alias("scene"))


def placed(df: DataFrame, grids: DataFrame, spacing: float, start_x: float, start_y: float, width: int, length: int) -> DataFrame:
    """Cells of scenes on the mosaic's grid: shifted by whole cells to the nearest place, and cropped.

    ``grids`` has scene, x0 and y0, the upper left corner of each scene: a row per scene.
    """
    shift = lambda far: F.floor(far / spacing + 0.5).cast("int")
    offsets = grids.select("scene", shift(F.lit(start_y) - F.col("y0")).alias("_down"), shift(F.col("x0") - F.lit(start_x)).alias("_right"))
    moved = df.join(offsets, "scene").withColumns({"row": F.col("row") + F.col("_down"), "col": F.col("col") + F.col("_right")}).drop("_down", "_right")
    return moved.where((F.col("row") >= 0) & (F.col("row") < length) & (F.col("col") >= 0) & (F.col("col") < width))
