"""Neighbourhood operators on tiles: the formulas of ``focal`` as passes over grids.

Each works on a tile and the cells around it, so tables of tiles stay where they are and only the strips at tile borders move.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from ..sources.tiles import SIDE, tile_apply


def _shifted(grid: np.ndarray, step: int, axis: int) -> np.ndarray:
    """The neighbour ``step`` cells on along an axis; NaN beyond the grid."""
    out = np.full_like(grid, np.nan)
    to, of = [slice(None)] * 2, [slice(None)] * 2
    to[axis], of[axis] = (slice(0, -step), slice(step, None)) if step > 0 else (slice(-step, None), slice(0, step))
    out[tuple(to)] = grid[tuple(of)]
    return out


def _mirrored(grid: np.ndarray, axis: int) -> tuple[np.ndarray, np.ndarray]:
    """The neighbours ahead and behind; where there is none, the other one."""
    ahead, behind = _shifted(grid, 1, axis), _shifted(grid, -1, axis)
    return np.where(np.isnan(ahead), behind, ahead), np.where(np.isnan(behind), ahead, behind)


def slope(tiles: DataFrame, height: str, spacing: float = 30.0, side: int = SIDE) -> DataFrame:
    """Slope angle in degrees of a complete grid: Sobel differences over three spacings."""

    def run(wide: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        h = wide[height]
        east, west = _mirrored(h, 1)
        dx, sx = east - west, east + 2 * h + west
        (ahead, behind), (below, above) = _mirrored(dx, 0), _mirrored(sx, 0)
        gx, gy = (ahead + 2 * dx + behind) / 3 / spacing, (below - above) / 3 / spacing
        return {"slope": np.degrees(np.arctan(np.sqrt(gx * gx + gy * gy)))}

    return tile_apply(tiles, run, [height], ["slope"], 1, side)


def _box(grid: np.ndarray, size: int) -> np.ndarray:
    """Sums over the size x size box around every cell, what lies outside as 0: along lines, then along columns."""
    half = size // 2
    for axis in (1, 0):
        total = grid.copy()
        for step in range(1, half + 1):
            for s in (step, -step):
                total += np.nan_to_num(_shifted(grid, s, axis))
        grid = total
    return grid


def box_stats(tiles: DataFrame, value: str, size: int, most_missing: float = 0.2, side: int = SIDE) -> DataFrame:
    """Mean and variance over the box, missing cells as 0; missing where too much of the box is."""
    return tile_apply(tiles, lambda wide: dict(zip(("mean", "variance"), _stats(wide[value], size, most_missing))), [value], ["mean", "variance"], size // 2, side)


def _stats(grid: np.ndarray, size: int, most_missing: float) -> tuple[np.ndarray, np.ndarray]:
    area, known = float(size * size), ~np.isnan(grid)
    x = np.where(known, grid, 0.0)
    mean = _box(x, size) / area
    variance = np.maximum(_box(x * x, size) / area - mean * mean, 0.0)
    enough = 1 - _box(known.astype(float), size) / area <= most_missing
    return np.where(enough, mean, np.nan), np.where(enough, variance, np.nan)


def lee(tiles: DataFrame, value: str, size: int = 3, damping: float = 1.0, low: float = 0.523, high: float = 1.73, side: int = SIDE) -> DataFrame:
    """Enhanced Lee filter: the mean in even areas, the value at points, a damped mixture between."""

    def run(wide: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        grid = wide[value]
        mean, variance = _stats(grid, size, 0.2)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            ci = np.where(mean != 0, np.sqrt(variance) / mean, np.nan)
            weight = np.where(ci <= low, 1.0, np.where(ci >= high, 0.0, np.exp(-damping * (ci - low) / (high - ci))))
            mixed = mean * weight + grid * (1 - weight)
        return {"filtered": np.where(np.isnan(mixed), grid, mixed)}

    return tile_apply(tiles, run, [value], ["filtered"], size // 2, side)
