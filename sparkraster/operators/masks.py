"""Predicates over cell layers. Every predicate is false where an input is missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import maths

#: Land-cover codes.
LANDCOVER = {
    "Tree Cover": 10, "Shrubs": 20, "Grassland": 30, "Crop": 40, "Urban": 50, "Bare sparse vegetation": 60, "Snow and Ice": 70,
    "Permanent water bodies": 80, "Herbaceous wetland": 90, "Mangrove": 95, "Moss and lichen": 100, "No_data": 0,
}
#: Land-cover codes of the second map that stand for inundated vegetation.
VEGETATION_RANGES = ("112-124", "200-207", "19-24", "125-148")


def sure(test: Column) -> Column:
    """The predicate, false where it is unknown."""
    return F.coalesce(test, F.lit(False))


def parse_ranges(ranges: Column) -> Column:
    """An array of 'a-b' and 'a' strings as the array of codes."""
    return F.flatten(F.transform(ranges, lambda x: F.sequence(F.split(x, "-")[0].cast("int"), F.element_at(F.split(x, "-"), -1).cast("int"))))


def landcover_mask(cover: Column, labels: list[str | int]) -> Column:
    """Cells of the given classes, by name or code."""
    return sure(cover.isin([LANDCOVER[x] if isinstance(x, str) else x for x in labels]))


def valid_only(df: DataFrame, column: str, missing: float | None = None) -> DataFrame:
    """Rows whose value is known and not the missing code."""
    keep = F.col(column).isNotNull()
    return df.where(keep if missing is None else keep & (F.col(column) != missing))


def flat_land(cover: Column, slope: Column, *cross_db: Column, slope_most: float = 5, dark: float = -18) -> Column:
    """Bare, shrub, grass or wetland on gentle slopes, dark in every cross band."""
    low = reduce(lambda a, b: a & b, [sure(x < dark) for x in cross_db])
    return landcover_mask(cover, ["Bare sparse vegetation", "Shrubs", "Grassland", "Herbaceous wetland"]) & sure(slope < slope_most) & low


def frequent_water(occurrence: Column, *cross_db: Column, low: float = 0.1, high: float = 0.9, dark: float = -18) -> Column:
    return sure((occurrence > low) & (occurrence < high)) & reduce(lambda a, b: a & b, [sure(x < dark) for x in cross_db])


def dark_water(occurrence: Column, *cross_db: Column, high: float = 0.9, dark: float = -24) -> Column:
    return sure(occurrence >= high) & reduce(lambda a, b: a & b, [sure(x < dark) for x in cross_db])


def dark_land(mask: Column, occurrence: Column, co_db: Column, cross_db: Column, share: float = 0.05, co: float = -14.6, cross: float = -22.8) -> Column:
    """Masked classes that are rarely water and dark in both bands."""
    return sure(mask) & sure(occurrence < share) & sure(co_db < co) & sure(cross_db < cross)


def repaired_occurrence(occurrence: Column, cover: Column, hand: Column, missing: float = 255, most: float = 100) -> Column:
    """Missing occurrence is full over permanent water and at drainage level, else none."""
    wet = sure(cover == LANDCOVER["Permanent water bodies"]) | sure(hand <= 0.002)
    return F.when(occurrence == missing, F.when(wet, F.lit(float(most))).otherwise(0.0)).otherwise(occurrence)


def reference_water(occurrence: Column, share: float = 0.9, missing: float = 255, most: float = 100) -> Column:
    return sure(F.when(occurrence == missing, F.lit(float(most))).otherwise(occurrence) / most > share)


def combined(tests: list[tuple[Column, int]], how: str = "and") -> Column:
    """Layers merged by their target values: all of them, or any."""
    hits = [sure(layer == value) for layer, value in tests]
    return reduce((lambda a, b: a & b) if how == "and" else (lambda a, b: a | b), hits)


#: Codes of the vegetation map that count as land in masking, and those of possible water. Fixed values.
LAND_CODES, WATER_CODES = (1, 24), (100, 230)


def not_water(cover: Column, missing: int = 0) -> Column:
    """All land cover that is known but permanent water."""
    return sure((cover != LANDCOVER["Permanent water bodies"]) & (cover != missing))


def vegetation_class(glad: Column, cover: Column) -> Column:
    """1 for a vegetation code, 2 where the code is missing and the other map says wetland, else 0."""
    codes = parse_ranges(F.array(*[F.lit(x) for x in VEGETATION_RANGES]))
    return F.when((glad == 255) & landcover_mask(cover, ["Herbaceous wetland"]), 2).when(sure(F.array_contains(codes, glad)), 1).otherwise(0)


def inundated_vegetation(ratio_db: Column, cross_db: Column, kind: Column, ratio: float = 8, cross: float = -26) -> Column:
    """2 where the ratio is high over a vegetation class, else 0."""
    return F.when(sure(ratio_db > ratio) & sure(cross_db > cross) & (kind > 0), 2).otherwise(0)


def partial_water(count: Column, full: int = 5) -> Column:
    """1 for a cell with enough water sub-cells, 8 for one with some, else 0."""
    return F.when(count >= full, 1).when(count > 0, 8).otherwise(0)


def validation(df: DataFrame, column: str, invalid: list[float]) -> DataFrame:
    """State of a layer: okay, invalid_found, nan_value or invalid_only."""
    bad = F.sum(F.col(column).isin(invalid).cast("long"))
    facts = df.agg(F.count("*").alias("cells"), F.count(column).alias("known"), F.coalesce(bad, F.lit(0)).alias("invalid"))
    state = F.when(F.col("invalid") == F.col("cells"), "invalid_only").when(F.col("known") == 0, "nan_value").when(F.col("invalid") > 0, "invalid_found").otherwise("okay")
    return facts.withColumn("state", state)


def membership(df: DataFrame, weights_area: bool = False) -> DataFrame:
    """Water membership of cells with columns co_z, cross_z, hand, slope, occurrence (and area)."""
    third = maths.smf("area", 0, 40) if weights_area else maths.smf("occurrence", 0.8, 0.95)
    others = (maths.zmf(F.coalesce("hand", F.lit(0.0)), 0, 15) + maths.zmf("slope", 0.5, 15) + third) / 3
    return df.withColumn("membership", 0.5 * maths.known_mean(F.col("co_z"), F.col("cross_z")) + 0.5 * others)
