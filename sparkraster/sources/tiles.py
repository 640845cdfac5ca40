"""Layers as tiles: a row per square of cells, its values as arrays.

A tile row holds the box of its cells (row0, col0, height, width), which of the box's cells are there (``here``),
and an array of values per layer, in line order; a missing value is null. So a join of aligned layers moves or meets
one row per tile in place of tens of thousands, and what neighbouring tiles tell each other are the strips at their borders.

Tables of tiles are bucketed by tile. Tables with one number of buckets join by tile without an exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .folders import scratch, ship

#: Lines and columns of a tile.
SIDE = 256
#: Where a tile lies, and its box.
PLACE, BOX = ("tile_row", "tile_col"), ("row0", "col0", "height", "width")


def groups(table: pa.Table | pa.RecordBatch, keys: list[str]) -> list[tuple[int, int]]:
    """Runs [a, b) of rows with equal keys, of rows sorted by them."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        codes = whole(table.column(k)).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    starts = np.flatnonzero(new).tolist()
    return list(zip(starts, [*starts[1:], table.num_rows]))


def whole(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def floats(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A column of numbers, null as NaN."""
    return whole(column).cast(pa.float64()).to_numpy(zero_copy_only=False)


def sorted_apply(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``fn`` over tables of whole groups: rows are dealt and sorted by the keys, so that one call gets many small groups (or a large one)."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = groups(batch, keys)[-1][0]
            goes_on = bool(held) and all(held[-1].column(k)[-1].as_py() == batch.column(k)[0].as_py() for k in keys)
            if last or not goes_on:
                done = [*held, batch.slice(0, last)] if last else held
                if done:
                    yield from fn(pa.Table.from_batches(done))
                held = []
            held.append(batch.slice(last))
        if held:
            yield from fn(pa.Table.from_batches(held))

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _schema(values: list[str]) -> tuple[str, pa.Schema]:
    names = ", ".join([f"{c} int" for c in (*PLACE, *BOX)] + ["here array<boolean>"] + [f"`{v}` array<double>" for v in values])
    fields = [(c, pa.int32()) for c in (*PLACE, *BOX)] + [("here", pa.list_(pa.bool_()))] + [(v, pa.list_(pa.float64())) for v in values]
    return names, pa.schema(fields)


def _row(place: tuple[int, int], box: tuple[int, int, int, int], here: np.ndarray, values: list[np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    size = pa.array([0, here.size], pa.int32())
    columns = [pa.array([v], pa.int32()) for v in (*place, *box)]
    columns.append(pa.ListArray.from_arrays(size, pa.array(here.ravel())))
    columns += [pa.ListArray.from_arrays(size, pa.array(v.ravel(), pa.float64(), from_pandas=True)) for v in values]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def to_tiles(cells: DataFrame, values: list[str], side: int = SIDE) -> DataFrame:
    """Cells (row, col, values) as tiles. Every cell is shuffled once; of a cell that occurs twice either row counts."""
    names, schema = _schema(values)

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        row, col = (whole(table.column(c)).to_numpy(zero_copy_only=False) for c in ("row", "col"))
        place = [whole(table.column(c)).to_numpy(zero_copy_only=False) for c in PLACE]
        held = [floats(table.column(v)) for v in values]
        for a, b in groups(table, list(PLACE)):
            r, c = row[a:b], col[a:b]
            r0, c0 = int(r.min()), int(c.min())
            shape = (int(r.max()) - r0 + 1, int(c.max()) - c0 + 1)
            here, grids = np.zeros(shape, bool), []
            here[r - r0, c - c0] = True
            for v in held:
                grids.append(np.full(shape, np.nan))
                grids[-1][r - r0, c - c0] = v[a:b]
            yield _row((int(place[0][a]), int(place[1][a])), (r0, c0, *shape), here, grids, schema)

    index = [F.expr(f"cast(floor({c} / {side}) as int)").alias(f"tile_{c}") for c in ("row", "col")]
    picked = cells.select(*index, F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), *[F.col(v).cast("double").alias(v) for v in values])
    return sorted_apply(picked, list(PLACE), run, names)


def to_cells(tiles: DataFrame, values: list[str]) -> DataFrame:
    """Tiles as cells again, in the JVM and without a shuffle."""
    parts = tiles.select("row0", "col0", "width", F.posexplode(F.arrays_zip("here", *values)).alias("_at", "_v")).where("_v.here")
    return parts.select(F.expr("cast(row0 + _at div width as int)").alias("row"), F.expr("cast(col0 + _at % width as int)").alias("col"), *[F.col(f"_v.{v}").alias(v) for v in values])


def join_tiles(tables: list[DataFrame]) -> DataFrame:
    """Aligned layers side by side: tables of tiles over the same cells, joined by tile. Bucketed ones meet without an exchange.

    Tables whose boxes differ aren't aligned, and stop the job.
    """
    out = tables[0]
    for table in tables[1:]:
        other = table.select(*PLACE, F.struct(*BOX).alias("_box"), *[c for c in table.columns if c not in (*PLACE, *BOX, "here")])
        out = out.join(other, list(PLACE))
        out = out.where(F.when(F.struct(*BOX) == F.col("_box"), True).otherwise(F.raise_error(F.lit("layers of different cells")).cast("boolean"))).drop("_box")
    return out


def write_tiles(tiles: DataFrame, name: str, buckets: int | None = None) -> DataFrame:
    """A bucketed table of tiles in the shared folder, sorted by tile; a bucket is one file. Returns the table.

    There are at least as many buckets as shuffle partitions, so that a join moves the other side to them, if any.
    """
    spark = tiles.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = tiles.repartition(n, *PLACE).sortWithinPartitions(*PLACE)
    rows.write.mode("overwrite").format("parquet").bucketBy(n, *PLACE).sortBy(*PLACE).option("path", scratch(spark, name)).saveAsTable(name)
    return spark.table(name)


def _grid(batch: pa.RecordBatch | dict, i: int, name: str) -> np.ndarray:
    """An array of row ``i`` as a grid."""
    shape = (batch.column("height")[i].as_py(), batch.column("width")[i].as_py())
    own = batch.column(name)[i].values
    return (own.to_numpy(zero_copy_only=False) if name == "here" else floats(own)).reshape(shape)


def strips(tiles: DataFrame, values: list[str], halo: int, side: int = SIDE) -> DataFrame:
    """What each tile tells its eight neighbours: the part of it within ``halo`` of them, under the neighbour's place."""
    names, schema = _schema(values)
    if halo > side:
        raise ValueError("a halo reaches no further than the next tile")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tr, tc, r0, c0, h, w = (batch.column(c)[i].as_py() for c in (*PLACE, *BOX))
                grids = [_grid(batch, i, c) for c in ("here", *values)]
                for dr in (-1, 0, 1):
                    for dc in (-1, 0, 1):
                        top, bottom = max(r0, (tr + dr) * side - halo), min(r0 + h, (tr + dr + 1) * side + halo)
                        left, right = max(c0, (tc + dc) * side - halo), min(c0 + w, (tc + dc + 1) * side + halo)
                        if (dr or dc) and top < bottom and left < right:
                            cut = [np.ascontiguousarray(g[top - r0 : bottom - r0, left - c0 : right - c0]) for g in grids]
                            if cut[0].any():
                                yield _row((tr + dr, tc + dc), (top, left, bottom - top, right - left), cut[0], cut[1:], schema)

    ship(tiles.sparkSession)
    return tiles.select(*PLACE, *BOX, "here", *values).mapInArrow(run, names)


def tile_apply(tiles: DataFrame, fn: Callable[[dict[str, np.ndarray]], dict[str, np.ndarray]], values: list[str], results: list[str], halo: int, side: int = SIDE) -> DataFrame:
    """``fn`` over every tile with the cells around it: tiles with ``results``.

    ``fn`` gets a grid of each value (missing as NaN) and ``here``, wider by ``halo`` on each side, and returns grids of that size. Only
    strips are shuffled; a bucketed table of tiles stays where it is.
    """
    names, schema = _schema(results)
    edge = strips(tiles, values, halo, side)
    edge = edge.groupBy(*PLACE).agg(F.collect_list(F.struct(*BOX, "here", *values)).alias("edge"))  # eight at most
    both = tiles.select(*PLACE, *BOX, "here", *values).join(edge, list(PLACE), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tr, tc, r0, c0, h, w = (batch.column(c)[i].as_py() for c in (*PLACE, *BOX))
                shape = (h + 2 * halo, w + 2 * halo)
                wide = {"here": np.zeros(shape, bool)} | {v: np.full(shape, np.nan) for v in values}
                inner = (slice(halo, halo + h), slice(halo, halo + w))
                for c in wide:
                    wide[c][inner] = _grid(batch, i, c)
                here = wide["here"][inner].copy()
                around = batch.column("edge")[i]
                pieces = pa.RecordBatch.from_struct_array(around.values) if around.is_valid else None
                for j in range(pieces.num_rows if pieces is not None else 0):
                    pr, pc, ph, pw = (pieces.column(c)[j].as_py() for c in BOX)
                    top, left = max(pr, r0 - halo), max(pc, c0 - halo)
                    bottom, right = min(pr + ph, r0 + h + halo), min(pc + pw, c0 + w + halo)
                    if top < bottom and left < right:
                        to = (slice(top - r0 + halo, bottom - r0 + halo), slice(left - c0 + halo, right - c0 + halo))
                        for c in wide:
                            wide[c][to] = _grid(pieces, j, c)[top - pr : bottom - pr, left - pc : right - pc]
                out = fn(wide)
                yield _row((tr, tc), (r0, c0, h, w), here, [np.ascontiguousarray(out[c][inner]) for c in results], schema)

    return both.mapInArrow(run, names)
