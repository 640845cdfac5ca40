"""Neighbourhoods of cells: slope, box statistics and speckle filters.

Neighbours are gathered with window frames along lines and then along columns, so
a cell is shuffled twice whatever the box size. ``halo_apply`` is there for filters
that need whole tiles.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import ship


def along(df: DataFrame):
    """Windows along lines and along columns, within a scene where the table has scenes."""
    scene = ["scene"] if "scene" in df.columns else []
    return Window.partitionBy(*scene, "row").orderBy("col"), Window.partitionBy(*scene, "col").orderBy("row")


def _reflected(step: int, value: str, window) -> Column:
    """The neighbour ``step`` (1 or -1) away; beyond the edge its mirror image, the edge itself not repeated."""
    ahead, behind = F.lead(value).over(window), F.lag(value).over(window)
    return F.coalesce(ahead, behind) if step > 0 else F.coalesce(behind, ahead)


def slope(df: DataFrame, height: str, spacing: float = 30.0) -> DataFrame:
    """Slope angle in degrees of a complete grid: Sobel differences over three spacings."""
    row, col = along(df)
    rows = df.withColumns({"_e": _reflected(1, height, row), "_w": _reflected(-1, height, row)})
    rows = rows.withColumns({"_dx": F.col("_e") - F.col("_w"), "_sx": F.col("_e") + 2 * F.col(height) + F.col("_w")})
    gx = _reflected(1, "_dx", col) + 2 * F.col("_dx") + _reflected(-1, "_dx", col)
    gy = _reflected(1, "_sx", col) - _reflected(-1, "_sx", col)
    out = rows.withColumns({"_gx": gx / 3 / spacing, "_gy": gy / 3 / spacing})
    return out.withColumn("slope", F.degrees(F.atan(F.sqrt(F.col("_gx") * F.col("_gx") + F.col("_gy") * F.col("_gy"))))).drop("_e", "_w", "_dx", "_sx", "_gx", "_gy")


def box_sums(df: DataFrame, values: dict[str, Column], size: int) -> DataFrame:
    """Sums over the size x size box around every cell; what lies outside counts 0."""
    h = size // 2
    along_row, along_col = (w.rangeBetween(-h, h) for w in along(df))
    rows = df.withColumns({f"_{k}": v for k, v in values.items()})
    rows = rows.withColumns({f"_{k}": F.sum(f"_{k}").over(along_row) for k in values})
    return rows.withColumns({k: F.sum(f"_{k}").over(along_col) for k in values}).drop(*[f"_{k}" for k in values])


def box_stats(df: DataFrame, value: str, size: int, most_missing: float = 0.2) -> DataFrame:
    """Mean and variance over the box, missing cells as 0; missing where too much of the box is."""
    x = F.coalesce(F.col(value), F.lit(0.0))
    rows = box_sums(df, {"s1": x, "s2": x * x, "known": F.col(value).isNotNull().cast("int")}, size)
    area = float(size * size)
    mean = F.col("s1") / area
    rows = rows.withColumns({"mean": mean, "variance": F.greatest(F.col("s2") / area - mean * mean, F.lit(0.0))})
    enough = 1 - F.col("known") / area <= most_missing
    return rows.withColumns({c: F.when(enough, F.col(c)) for c in ("mean", "variance")}).drop("s1", "s2", "known")


def lee(df: DataFrame, value: str, size: int = 3, damping: float = 1.0, low: float = 0.523, high: float = 1.73) -> DataFrame:
    """Enhanced Lee filter: the mean in even areas, the value at points, a damped mixture between."""
    rows = box_stats(df, value, size)
    ci = F.sqrt("variance") / F.col("mean")
    weight = F.when(ci <= low, 1.0).when(ci >= high, 0.0).otherwise(F.exp(-damping * (ci - low) / (high - ci)))
    mixed = F.col("mean") * weight + F.col(value) * (1 - weight)
    return rows.withColumn("filtered", F.when(F.col(value).isNotNull(), F.coalesce(mixed, F.col(value)))).drop("mean", "variance")


def guided(df: DataFrame, value: str, guide: str, radius: int = 1, eps: float = 3.0) -> DataFrame:
    """Guided filter: local linear models of the value in the guide, averaged."""
    size = 2 * radius + 1
    i, p = F.coalesce(F.col(guide), F.lit(0.0)), F.coalesce(F.col(value), F.lit(0.0))
    rows = box_sums(df, {"si": i, "sp": p, "sip": i * p, "sii": i * i, "cells": F.lit(1)}, size)
    rows = rows.withColumns({"mi": F.col("si") / F.col("cells"), "mp": F.col("sp") / F.col("cells")})
    a = (F.col("sip") / F.col("cells") - F.col("mi") * F.col("mp")) / (F.col("sii") / F.col("cells") - F.col("mi") * F.col("mi") + eps)
    rows = rows.withColumn("a", a).withColumn("b", F.col("mp") - F.col("a") * F.col("mi")).drop("si", "sp", "sip", "sii", "mi", "mp", "cells")
    rows = box_sums(rows, {"sa": F.col("a"), "sb": F.col("b"), "cells": F.lit(1)}, size)
    out = F.col("sa") / F.col("cells") * i + F.col("sb") / F.col("cells")
    return rows.withColumn("filtered", F.when(F.col(value).isNotNull(), out)).drop("a", "b", "sa", "sb", "cells")


def halo_apply(df: DataFrame, fn: Callable[[np.ndarray], np.ndarray], value: str, tile: int = 256, halo: int = 150, fill: float = 0.0) -> DataFrame:
    """``fn`` over square tiles with a halo, whose cells are dropped afterwards: (row, col, filtered).

    A task holds one tile with its halo; missing cells are ``fill`` for ``fn`` and missing again after. What a tile's edge
    does to a step of the filters below travels two cells at most, so 50 steps stay inside a halo of 150: the tiling doesn't show.
    """

    def reach(column: str) -> Column:
        return F.sequence(F.floor((F.col(column) - halo) / tile).cast("int"), F.floor((F.col(column) + halo) / tile).cast("int"))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(frame["row"].min()), int(frame["col"].min())
        grid = np.full((int(frame["row"].max()) - r0 + 1, int(frame["col"].max()) - c0 + 1), np.nan)
        grid[frame["row"] - r0, frame["col"] - c0] = frame["value"].astype(float)
        out = fn(np.where(np.isnan(grid), fill, grid))
        own = frame[(frame["row"] // tile == key[0]) & (frame["col"] // tile == key[1]) & frame["value"].notna()]
        return pd.DataFrame({"row": own["row"].astype("int32"), "col": own["col"].astype("int32"), "filtered": out[own["row"] - r0, own["col"] - c0]})

    ship(df.sparkSession)
    cells = df.select("row", "col", F.col(value).cast("double").alias("value")).withColumn("_r", F.explode(reach("row"))).withColumn("_c", F.explode(reach("col")))
    return cells.groupBy("_r", "_c").applyInPandas(run, "row int, col int, filtered double")


def total_variation(weight: float = 1.0, steps: int = 50) -> Callable[[np.ndarray], np.ndarray]:
    """Denoising by the dual projection method with a fixed number of steps."""

    def run(image: np.ndarray) -> np.ndarray:
        px, py = np.zeros_like(image), np.zeros_like(image)
        for _ in range(steps):
            div = np.diff(px, axis=0, prepend=0) + np.diff(py, axis=1, prepend=0)
            u = image + weight * div
            gx, gy = np.zeros_like(image), np.zeros_like(image)
            gx[:-1], gy[:, :-1] = np.diff(u, axis=0), np.diff(u, axis=1)
            norm = 1 + 0.25 / weight * np.hypot(gx, gy)
            px, py = (px + 0.25 / weight * gx) / norm, (py + 0.25 / weight * gy) / norm
            px[-1], py[:, -1] = 0, 0
        return image + weight * (np.diff(px, axis=0, prepend=0) + np.diff(py, axis=1, prepend=0))

    return run


def split_bregman(weight: float = 20.0, steps: int = 50) -> Callable[[np.ndarray], np.ndarray]:
    """Isotropic total-variation denoising by split Bregman iterations (smaller weights smooth more)."""

    def run(image: np.ndarray) -> np.ndarray:
        u = image.copy()
        dx, dy, bx, by = (np.zeros_like(image) for _ in range(4))
        lam = 2.0 * weight
        for _ in range(steps):
            rx, ry = dx - bx, dy - by
            around = np.pad(u, 1, mode="edge")
            side = around[2:, 1:-1] + around[:-2, 1:-1] + around[1:-1, 2:] + around[1:-1, :-2]
            split = -(np.diff(rx, axis=0, prepend=0) + np.diff(ry, axis=1, prepend=0))
            u = (weight * image + lam * (side + split)) / (weight + 4 * lam)
            gx, gy = np.zeros_like(u), np.zeros_like(u)
            gx[:-1], gy[:, :-1] = np.diff(u, axis=0), np.diff(u, axis=1)
            size = np.hypot(gx + bx, gy + by)
            scale = np.maximum(size - 1 / lam, 0) / np.maximum(size, 1e-12)
            dx, dy = scale * (gx + bx), scale * (gy + by)
            bx, by = bx + gx - dx, by + gy - dy
        return u

    return run


def filtered(df: DataFrame, value: str, method: str, **parameters) -> DataFrame:
    """(row, col, filtered) by the filter of that name: lee, guided, projected or bregman total variation.

    Total variation works on decibels, missing cells being -30 dB for it; its values come back as power.
    """
    if method == "lee":
        return lee(df, value, **parameters).select("row", "col", "filtered")
    decibels = df.withColumn("_db", 10 * F.log10(F.when(F.col(value) > 0, F.col(value))))
    if method == "guided":
        return guided(decibels, value, "_db", **parameters).select("row", "col", "filtered")
    smooth = {"projected": total_variation, "bregman": split_bregman}[method]
    out = halo_apply(decibels, smooth(**parameters), "_db", fill=-30.0)
    return out.withColumn("filtered", F.pow(F.lit(10.0), F.col("filtered") / 10))
