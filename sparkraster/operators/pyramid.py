"""Windows of every size from one pass over cells.

Cells are summed up into blocks of half the smallest window. Four blocks make a block of the next size, and four
blocks make a window, which begin every half window; what is known of a block, moments and histograms, adds up. So cells are
touched once, whatever the number of sizes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hist
from .morph import kept

KEYS = ["window_size", "window_row", "window_col"]


def halved(largest: int, smallest: int) -> tuple[int, ...]:
    """``largest`` and its even halves down to ``smallest``."""
    sizes = [largest]
    while sizes[-1] % 4 == 0 and sizes[-1] // 2 >= smallest:
        sizes.append(sizes[-1] // 2)
    return tuple(sizes)


def blocks(cells: DataFrame, side: int) -> DataFrame:
    """Cells with the block they lie in."""
    return cells.withColumns({f"block_{c}": F.expr(f"cast(floor({c} / {side}) as int)") for c in ("row", "col")})


def windows(found: DataFrame, sizes: tuple[int, ...], merge: Callable[[DataFrame, list[str]], DataFrame]) -> DataFrame:
    """(window_size, window_row, window_col, ..) of all sizes, from what is known of blocks of half the smallest one.

    ``merge`` adds up the rows that have equal keys.
    """
    ordered = sorted(sizes)
    if any(b != 2 * a for a, b in zip(ordered, ordered[1:])) or ordered[0] % 2:
        raise ValueError("each size is half of the next one, and the smallest is even")
    out, level = None, found
    index = ["block_row", "block_col"]
    for size in ordered:
        first = lambda c: F.explode(F.sequence(F.greatest(F.col(c) - 1, F.lit(0)), F.col(c)))
        spread = level.withColumn("window_row", first("block_row")).withColumn("window_col", first("block_col")).drop(*index)
        own = merge(spread, KEYS[1:]).withColumn("window_size", F.lit(size))
        out = own if out is None else out.unionByName(own)
        level = merge(level.withColumns({c: F.expr(f"cast(floor({c} / 2) as int)") for c in index}), index)
    return out


def _merged_moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Counts added up, means and squared deviations combined (four rows at most have equal keys)."""
    part = F.struct("mean", "m2", "valid", "wet", "cells")
    start = F.struct(F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"), *[F.lit(0).cast("long").alias(c) for c in ("valid", "wet", "cells")])

    def add(a, b):
        n = a["valid"] + b["valid"]
        gap = b["mean"] - a["mean"]
        share = F.when(n > 0, b["valid"] / n).otherwise(0.0)
        return F.struct(
            (a["mean"] + gap * share).alias("mean"), (a["m2"] + b["m2"] + gap * gap * a["valid"] * share).alias("m2"),
            n.alias("valid"), (a["wet"] + b["wet"]).alias("wet"), (a["cells"] + b["cells"]).alias("cells"),
        )

    whole = rows.groupBy(*keys).agg(F.aggregate(F.array_sort(F.collect_list(part)), start, add).alias("m"), F.sum("total").alias("total"))
    return whole.select(*keys, "m.*", "total")


def moments(cells: DataFrame, value: str, sizes: tuple[int, ...], water: str) -> DataFrame:
    """(window_size, window_row, window_col, mean, m2, valid, wet, cells, total): moments of the values that are there, and cells of known
    water, counted once a cell. Sums of whole numbers are exact."""
    placed = blocks(cells, min(sizes) // 2)
    own = placed.groupBy("block_row", "block_col").agg(
        F.coalesce(F.avg(value), F.lit(0.0)).alias("mean"), F.coalesce(F.var_pop(value) * F.count(value), F.lit(0.0)).alias("m2"), F.count(value).alias("valid"),
        F.count_if(F.col(water)).alias("wet"), F.count(water).alias("cells"), F.coalesce(F.sum(value), F.lit(0)).alias("total"),
    )
    return windows(kept(own, "blocks"), sizes, _merged_moments)


def _merged_halves(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "bin").agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2", "s3", "s4")])


def halves(cells: DataFrame, value: str, sizes: tuple[int, ...], low: float, high: float, n: int) -> DataFrame:
    """Half-bin histograms (``hist.halves``) of windows of all sizes."""

    own = hist.halves(blocks(cells, min(sizes) // 2), ["block_row", "block_col"], value, low, high, n)
    return windows(kept(own, "halves"), sizes, _merged_halves)


def cells_of(cells: DataFrame, chosen: DataFrame, half: int) -> DataFrame:
    """Cells with each of the ``chosen`` windows that covers them; ``half`` is half of the smallest size. Windows and cells meet on blocks."""
    span = lambda c: F.explode(F.sequence((F.col(c) * F.expr(f"window_size div {2 * half}")).cast("int"), ((F.col(c) + 2) * F.expr(f"window_size div {2 * half}") - 1).cast("int")))
    places = chosen.select(*KEYS).withColumn("block_row", span("window_row")).withColumn("block_col", span("window_col"))
    return blocks(cells, half).join(places, ["block_row", "block_col"]).drop("block_row", "block_col")
