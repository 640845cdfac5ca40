"""Connected components over an edge table, in a few rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links to (node, component), the component being its smallest node.

    Large-star and small-star steps alternate: every node sends its larger, then
    its smaller neighbours to the smallest one it knows. The edges shrink to one
    star per component. Only a count comes back to the driver.
    """
    both = F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v"))))
    edges = stored(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    while True:
        around = edges.select(both.alias("e")).select("e.*")
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a != b").distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("m").alias("a"), F.explode(F.array("u", "v")).alias("b")).where("a != b").distinct()
        new = stored(small, "edges")
        same = new.join(edges, ["a", "b"], "left_semi").count()
        sizes = new.count(), edges.count()
        edges = new
        if same == sizes[0] == sizes[1]:
            break
    stars = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
