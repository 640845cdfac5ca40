"""Classified products: layers of codes, their recoding and their coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .masks import sure

#: Product codes, lowest priority first.
CODES = {
    "nonwater": 0, "water": 1, "bright_water_fill": 2, "inundated_vegetation": 3, "partial_water": 8, "inundated_vegetation_conf": 5,
    "dark_land_mask": 6, "landcover_mask": 7, "wetland_nonwater": 30, "wetland_water": 31, "wetland_bright_water_fill": 32,
    "wetland_inundated_veg": 35, "wetland_dark_land_mask": 36, "wetland_landcover_mask": 37, "hand_mask": 250,
    "layover_shadow_mask": 251, "ocean_mask": 254, "no_data": 255,
}
#: Classes after collapsing; all others become missing.
COLLAPSED = {0: 0, 1: 1, 2: 1, 6: 0, 7: 0, 250: 250, 251: 251, 3: 3, 255: 255, 254: 254, 8: 1}


def classified(water: Column, base: Column | None = None, **masks: Column) -> Column:
    """Codes of all given masks over the water layer; inundated vegetation lies on top of everything."""
    out = F.when(sure(water), CODES["water"]).otherwise(0) if base is None else base
    for name, code in CODES.items():
        if name in masks and name != "inundated_vegetation":
            out = F.when(sure(masks[name]), code).otherwise(out)
    if "inundated_vegetation" in masks:
        out = F.when(sure(masks["inundated_vegetation"]), CODES["inundated_vegetation"]).otherwise(out)
    return out.cast("int")


def collapse(code: Column) -> Column:
    """Product classes from internal ones; an unknown class is missing."""
    table = F.create_map(*[F.lit(x) for pair in COLLAPSED.items() for x in pair])
    return F.coalesce(table[code], F.lit(255)).cast("int")


def browse(code: Column, collapsed: bool = True, no_vegetation: bool = False, no_land: bool = False, no_hand: bool = False, no_shadow: bool = False, no_ocean: bool = True) -> Column:
    """Codes for a browse image: vegetation shown as water, or classes set to missing."""
    out = collapse(code) if collapsed else code
    if no_vegetation:
        out = F.when(out == 3, 1).otherwise(out)
    for flag, value in ((no_land, 0), (no_hand, 250), (no_shadow, 251), (no_ocean, 254)):
        if flag:
            out = F.when(out == value, 255).otherwise(out)
    return out.cast("int")


def confidence(water: Column, grown: Column, landcover: Column, high_ratio: Column, vegetation: Column, wetland: Column, **masks: Column) -> Column:
    """The confidence layer from the stages' results."""
    cover = sure(grown == 1) & sure(landcover != 1)
    dark = sure(landcover == 1) & ~sure(water)
    bright = sure(landcover == 0) & sure(water)
    return classified(
        water, landcover_mask=cover, bright_water_fill=bright, dark_land_mask=dark,
        inundated_vegetation_conf=sure(high_ratio) & ~sure(wetland) & ~sure(water),
        wetland_nonwater=~sure(water) & wetland, wetland_water=sure(water) & wetland, wetland_bright_water_fill=bright & wetland,
        wetland_inundated_veg=sure(vegetation) & wetland, wetland_dark_land_mask=dark & wetland, wetland_landcover_mask=cover & wetland, **masks,
    )


def coverage(df: DataFrame, code: str = "code") -> DataFrame:
    """Valid share of all cells and shadow share of the valid ones, in percent to 4 decimals."""
    valid, shadow = F.sum((F.col(code) != 255).cast("long")), F.sum((F.col(code) == 251).cast("long"))
    return df.agg(
        F.round(100.0 * valid / F.count("*"), 4).alias("spatial_coverage"),
        F.when(valid > 0, F.round(100.0 * shadow / valid, 4)).otherwise(0.0).alias("shadow_coverage"),
    )


def vegetation_source(df: DataFrame, kind: str = "kind") -> DataFrame:
    """Which map the vegetation classes come from."""
    first, second = F.count_if(F.col(kind) == 1), F.count_if(F.col(kind) == 2)
    both = F.when((first > 0) & (second > 0), "GLAD/WorldCover").when(second > 0, "WorldCover").otherwise("GLAD")
    return df.agg(first.alias("first"), second.alias("second"), both.alias("source"))
