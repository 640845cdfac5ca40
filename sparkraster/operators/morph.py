"""Binary morphology over masks given as sets of cells (row, col)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..sources.folders import scratch

FOUR = ((0, 1), (0, -1), (1, 0), (-1, 0))
#: Rows that may be sent whole to every executor: a broadcast of them takes some 5 MB of the driver.
SENT = 50_000


def moved(cells: DataFrame, offsets: list[tuple[int, int]] | tuple) -> DataFrame:
    """Every cell at every offset, once each; further columns are kept."""
    steps = F.explode(F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in offsets]))
    keep = [c for c in cells.columns if c not in ("row", "col")]
    return cells.withColumn("_o", steps).select((F.col("row") + F.col("_o.r")).alias("row"), (F.col("col") + F.col("_o.c")).alias("col"), *keep).distinct()


def line_runs(mask: DataFrame, group: list[str]) -> DataFrame:
    """(group, row, first, last): maximal runs of neighbouring cells in a line."""
    order = Window.partitionBy(*group, "row").orderBy("col")
    cells = mask.select(*group, "row", "col").distinct().withColumn("_i", F.col("col") - F.row_number().over(order))
    return cells.groupBy(*group, "row", "_i").agg(F.min("col").alias("first"), F.max("col").alias("last")).drop("_i")


def dilate(mask: DataFrame, n: int, within: DataFrame | None = None) -> DataFrame:
    """n steps to 4-neighbours: all cells at a Manhattan distance of n at most, inside ``within`` if given.

    A run of cells reaches one interval in each of 2n + 1 lines; intervals that touch are one before they become cells again.
    Columns besides row and col are groups of their own. Steps that a mask bounds go one frontier at a time; each new
    frontier is written, which cuts the lineage.
    """
    if within is None:
        group = [c for c in mask.columns if c not in ("row", "col")]
        reach = F.lit(n) - F.abs("_d")
        spread = line_runs(mask, group).withColumn("_d", F.explode(F.sequence(F.lit(-n), F.lit(n))))
        spread = spread.select(*group, (F.col("row") + F.col("_d")).cast("int").alias("row"), (F.col("first") - reach).cast("int").alias("first"), (F.col("last") + reach).cast("int").alias("last"))
        order = Window.partitionBy(*group, "row").orderBy("first", "last")
        before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
        opens = F.coalesce((F.col("first") > before + 1).cast("int"), F.lit(1))
        parts = spread.withColumn("_new", opens).withColumn("_part", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        whole = parts.groupBy(*group, "row", "_part").agg(F.min("first").alias("first"), F.max("last").alias("last"))
        out = whole.select("row", F.explode(F.sequence("first", "last")).alias("col"), *group)
        return unsent(out.select(*mask.columns))
    reached = frontier = mask.select("row", "col").distinct()
    before = frontier.limit(0)
    for _ in range(n):
        # A neighbour of the frontier is new, or lies in the frontier or in the one before it.
        step = moved(frontier, FOUR).join(within, ["row", "col"], "left_semi").join(frontier.unionByName(before), ["row", "col"], "left_anti")
        before, frontier = frontier, kept(step, "frontier")
        reached = reached.unionByName(frontier)
    return reached


def unsent(df: DataFrame) -> DataFrame:
    """A table of cells, as a side of a join that is never broadcast.

    Spark goes by the bytes of files. Those of runs, and of lines of equal or counted numbers, are a hundredth of the cells that they stand for.
    """
    return df.hint("merge")


def _written(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Written to the shared folder and read again, with the rows that were counted meanwhile."""
    path, seen = scratch(df.sparkSession, name), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read again; more rows than ``SENT`` are never broadcast."""
    out, rows = _written(df, name)
    return out if rows <= SENT else unsent(out)


def facts(df: DataFrame, name: str) -> DataFrame:
    """``kept`` facts that cells meet by a key that most of them may share: sent to all executors if they are counted few, so that the cells stay where they are."""
    out, rows = _written(df, name)
    return F.broadcast(out) if rows <= SENT else unsent(out)


def erode(mask: DataFrame, n: int) -> DataFrame:
    """n steps from the outside in; beyond the image is outside."""
    mask = mask.select("row", "col").distinct()
    rim = moved(mask, FOUR).join(mask, ["row", "col"], "left_anti")  # outside cells next to the mask
    lost = dilate(rim, n) if n else rim.limit(0)
    return unsent(mask.join(lost, ["row", "col"], "left_anti")) if n else mask


def boundary(mask: DataFrame) -> DataFrame:
    """Cells of the mask that one erosion removes."""
    return mask.select("row", "col").distinct().join(erode(mask, 1), ["row", "col"], "left_anti")


def reference_masks(normal: DataFrame, wider: int = 16, narrower: int = 10) -> DataFrame:
    """Normal, flood and drought extent: (name, row, col)."""
    named = lambda df, name: df.select(F.lit(name).alias("name"), "row", "col")
    return named(normal, "normal").unionByName(named(dilate(normal, wider), "flood")).unionByName(named(erode(normal, narrower), "drought"))


def grouped(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``kept``, as a bucketed table of whole groups: what is grouped or joined by all of the keys later isn't shuffled again."""
    spark = df.sparkSession
    path, table, n = scratch(spark, name), f"{name}_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return spark.table(table)
