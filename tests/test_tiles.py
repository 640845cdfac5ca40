"""Layers as tiles: values, plans and what is shuffled."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkraster.operators import focal, tiled
from sparkraster.sources import tiles
from sparkraster.sources.folders import scratch


def values(df, name):
    return {(r["row"], r["col"]): r[name] for r in df.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for k, v in a.items():
        assert (v is None) == (b[k] is None) and (v is None or abs(v - b[k]) < 1e-9), k


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(0)
    rows = [(r, c, float(rng.normal()), float(rng.exponential()) if rng.random() > 0.1 else None) for r in range(-9, 40) for c in range(50)]
    df = spark.createDataFrame(rows, "row int, col int, dem double, cross double")
    path = scratch(spark, "cells")
    df.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("side", [7, 16, 256])
def test_tiles_equal_cells(spark, cells, side):
    stored = tiles.write_tiles(tiles.to_tiles(cells, ["dem", "cross"], side), f"stored_{side}")
    close(values(tiles.to_cells(stored, ["cross"]), "cross"), values(cells, "cross"))
    close(values(tiles.to_cells(tiled.slope(stored, "dem", side=side), ["slope"]), "slope"), values(focal.slope(cells, "dem"), "slope"))
    for size in (3, 5):
        close(values(tiles.to_cells(tiled.lee(stored, "cross", size, side=side), ["filtered"]), "filtered"), values(focal.lee(cells, "cross", size), "filtered"))
        ours, theirs = tiles.to_cells(tiled.box_stats(stored, "cross", size, side=side), ["mean", "variance"]), focal.box_stats(cells, "cross", size)
        for name in ("mean", "variance"):
            close(values(ours, name), values(theirs, name))


def test_sparse_cells_and_empty_tables(spark, cells):
    some = cells.where("pmod(row * 31 + col * 17, 11) = 0")
    stored = tiles.to_tiles(some, ["cross"], 16)
    close(values(tiles.to_cells(stored, ["cross"]), "cross"), values(some, "cross"))
    close(values(tiles.to_cells(tiled.lee(stored, "cross", side=16), ["filtered"]), "filtered"), values(focal.lee(some, "cross"), "filtered"))
    assert tiles.to_tiles(some.limit(0), ["cross"]).count() == 0


def test_groups_across_batches(spark):
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), "id").withColumn("k", F.when(F.col("k") > 3, F.col("k")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:

        def run(table):
            import pyarrow as pa

            for a, b in tiles.groups(table, ["k"]):
                yield pa.RecordBatch.from_pydict({"k": table.column("k").slice(a, 1).to_pylist(), "n": [b - a]}, pa.schema([("k", pa.int64()), ("n", pa.int64())]))

        got = sorted((r["k"] or -1, r["n"]) for r in tiles.sorted_apply(df, ["k"], run, "k long, n long").collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == sorted((r["k"] or -1, r["count"]) for r in df.groupBy("k").count().collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan()


def shuffled(df):
    """Bytes that a query writes to shuffles."""
    df.collect()
    total, open_ = 0, [plan_of(df)]
    while open_:
        node = open_.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            open_.append(node.executedPlan())
            continue
        if kind.endswith("QueryStageExec"):
            open_.append(node.plan())
            continue
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleBytesWritten").value()
        children = node.children()
        open_ += [children.apply(i) for i in range(children.size())]
    return total


def test_aligned_layers_meet_without_an_exchange(spark, cells):
    parts = [tiles.write_tiles(tiles.to_tiles(cells.withColumn(n, F.col("dem") * k), [n], 16), f"aligned_{n}") for k, n in enumerate("abc", 1)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = tiles.to_cells(tiles.join_tiles(parts), ["a", "b", "c"])
        text = plan_of(joined).toString()
        rows = joined.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert len(rows) == cells.count() and all(abs(r["c"] - 3 * r["a"]) < 1e-12 for r in rows)
    other = tiles.to_tiles(cells.where("row > 3"), ["dem"], 16).withColumnRenamed("dem", "d")
    with pytest.raises(Exception, match="different cells"):
        tiles.join_tiles([parts[0], other]).collect()


def test_only_strips_are_shuffled(spark):
    wide = spark.range(300 * 300).select(F.expr("cast(id div 300 as int)").alias("row"), F.expr("cast(id % 300 as int)").alias("col"), F.rand(1).alias("dem"))
    path = scratch(spark, "wide")
    wide.write.parquet(path)
    wide = spark.read.parquet(path)
    stored = tiles.write_tiles(tiles.to_tiles(wide, ["dem"], 128), "wide")
    for of_tiles, of_cells in ((tiled.slope(stored, "dem", side=128), focal.slope(wide, "dem")), (tiled.lee(stored, "dem", side=128), focal.lee(wide, "dem"))):
        assert shuffled(of_tiles) * 5 < shuffled(of_cells)
