"""Comparison of two products: cells, first difference, tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Tags that may differ between runs.
VOLATILE = ("PROCESSING_DATETIME", "SOFTWARE_VERSION")


def differences(left: DataFrame, right: DataFrame, keys: list[str], value: str = "value", tolerance: float = 1e-6) -> DataFrame:
    """Cells that one side lacks, or whose values are ``tolerance`` or more apart."""
    both = left.select(*keys, F.col(value).alias("left_value")).join(right.select(*keys, F.col(value).alias("right_value")), keys, "full_outer")
    apart = F.abs(F.col("left_value") - F.col("right_value")) >= tolerance
    one = F.col("left_value").isNull() != F.col("right_value").isNull()
    return both.where(F.coalesce(apart, F.lit(False)) | one)


def first_difference(diff: DataFrame, keys: list[str]) -> DataFrame:
    """The first difference in key order, with the number of all."""
    return diff.agg(F.min(F.struct(*keys, "left_value", "right_value")).alias("first"), F.count("*").alias("n")).select("first.*", "n").where("n > 0")


def tag_differences(left: DataFrame, right: DataFrame, skip: Column | tuple[str, ...] = VOLATILE, lists: Column | tuple[str, ...] = ()) -> DataFrame:
    """Tags (key, value) on one side only or with other values; list tags compare sorted.

    ``skip`` and ``lists`` are keys, or conditions on the key.
    """

    def test(which: Column | tuple[str, ...]) -> Column:
        return which if isinstance(which, Column) else F.col("key").isin(*which) if which else F.lit(False)

    def plain(tags: DataFrame, name: str) -> DataFrame:
        ordered = F.concat_ws(", ", F.array_sort(F.split("value", ", *")))
        return tags.where(~test(skip)).select("key", F.when(test(lists), ordered).otherwise(F.col("value")).alias(name))

    return plain(left, "left_value").join(plain(right, "right_value"), "key", "full_outer").where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def grid_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """(product, what, left_value, right_value): products (product, bands, x0, y0, step, epsg) that one side lacks, or whose numbers of
    bands, geotransforms (to a thousandth) or projections differ."""

    def facts(df: DataFrame, name: str) -> DataFrame:
        place = F.format_string("%.3f %.3f %.3f", "x0", "y0", "step")
        return df.select("product", F.struct(F.col("bands").cast("string").alias("bands"), place.alias("geotransform"), F.col("epsg").cast("string").alias("projection"), F.lit("there").alias("product")).alias(name))

    both = facts(left, "l").join(facts(right, "r"), "product", "full_outer")
    rows = [F.struct(F.lit(what).alias("what"), F.col(f"l.{what}").alias("left_value"), F.col(f"r.{what}").alias("right_value")) for what in ("bands", "geotransform", "projection", "product")]
    apart = both.select("product", F.explode(F.array(*rows)).alias("d"), (F.col("l").isNull() | F.col("r").isNull()).alias("_lacks")).select("product", "d.*", "_lacks")
    differs = ~F.col("left_value").eqNullSafe(F.col("right_value"))
    return apart.where(differs & (~F.col("_lacks") | (F.col("what") == "product"))).drop("_lacks")
