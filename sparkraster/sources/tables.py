"""Layer tables: scans with pushed-down band and row filters, and sinks partitioned for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One value of one band of one scene.
CELLS = "scene string, band string, row int, col int, value double"
#: Lines of a stored tile.
TILE_ROWS = 256


def read_layer(spark: SparkSession, path: str, band: str | None = None, rows: tuple[int, int] | None = None) -> DataFrame:
    """Cells of a stored layer table; band and row range prune partitions and row groups."""
    cells = spark.read.schema(CELLS + ", tile_row int").parquet(path)
    if band is not None:
        cells = cells.where(F.col("band") == band)
    if rows is not None:
        cells = cells.where(F.col("tile_row").between(rows[0] // TILE_ROWS, rows[1] // TILE_ROWS) & F.col("row").between(*rows))
    return cells.drop("tile_row")


def write_layer(cells: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store cells by band and line tile, clustered so that a writer holds few files."""
    tiled = cells.withColumn("tile_row", F.floor(F.col("row") / TILE_ROWS).cast("int"))
    tiled.repartition("band", "tile_row").sortWithinPartitions("band", "tile_row", "scene", "row", "col").write.mode(mode).partitionBy("band", "tile_row").parquet(path)


def write_points(points: DataFrame, path: str) -> None:
    """Threshold points as CSV: x, y, z."""
    points.select("x", "y", "z").write.mode("overwrite").csv(path)


def write_tags(tags: DataFrame, path: str) -> None:
    """Product tags (product, key, value) as JSON lines."""
    tags.write.mode("overwrite").json(path)


def constant_layer(spark: SparkSession, rows: int, cols: int, value: float) -> DataFrame:
    """A layer of one value."""
    cells = spark.range(rows * cols)
    return cells.select(F.expr(f"cast(id div {cols} as int)").alias("row"), (F.col("id") % cols).cast("int").alias("col"), F.lit(float(value)).alias("value"))


def clean_intensity(value: Column, ceiling: float = 500.0) -> Column:
    """Ingest cleaning: NaN and 0 are missing, infinities and values above the ceiling become the ceiling."""
    return F.when(value.isNull() | F.isnan(value), None).when((F.abs(value) == float("inf")) | (value > ceiling), F.lit(ceiling)).when(value == 0, None).otherwise(value)


def clean_mask(value: Column, missing: int = 255) -> Column:
    """Mask cleaning: what isn't finite becomes the missing code."""
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), F.lit(missing)).otherwise(value)
