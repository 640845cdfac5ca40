"""Scene metadata: names, times, flags, frequencies and polarisations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import morph

#: Processing modes in order; the last that contains all bands found is meant.
MODES = {"MIX_SINGLE_POL": ["HH", "VV"], "MIX_DUAL_POL": ["HH", "HV", "VV", "VH"], "DV_POL": ["VV", "VH"], "SV_POL": ["VV"], "DH_POL": ["HH", "HV"], "SH_POL": ["HH"]}


def compact_time(time: Column) -> Column:
    return F.date_format(time, "yyyyMMdd'T'HHmmss'Z'")


def polarisation(name: Column) -> Column:
    """The last part of a file name before its ending."""
    return F.element_at(F.split(F.regexp_replace(name, r"\.tif$", ""), "_"), -1)


def short_platform(name: Column) -> Column:
    return F.concat(F.substring(name, 1, 1), F.element_at(F.split(name, "-"), -1))


def list_of(text: Column) -> Column:
    """A list written in a string, quotes of either kind."""
    return F.from_json(text, "array<string>")


def described(description: Column, path: Column, otherwise: str) -> Column:
    """The description, else the file's name, else a constant."""
    name = F.regexp_extract(path, "[^/]+$", 0)
    return F.coalesce(F.nullif(description, F.lit("")), F.nullif(name, F.lit("")), F.lit(otherwise))


def joined(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, sorted, in one string."""
    return df.agg(F.concat_ws(", ", F.array_sort(F.collect_set(column))).alias(column))


def time_range(df: DataFrame) -> DataFrame:
    return df.agg(compact_time(F.min("t_start")).alias("first"), compact_time(F.max("t_end")).alias("last"))


def interfered(likelihood: Column, limit: float = 0.1) -> Column:
    """Whether any band's interference likelihood is above the limit."""
    return F.exists(F.map_values(likelihood), lambda x: x > limit)


def within_posting(freqs: Column, limit: float) -> Column:
    """Frequencies whose spacing is fine enough."""
    return F.filter(freqs, lambda f: f["spacing"] <= limit)


def polarisation_order(bands: Column) -> Column:
    """Co-polarised bands first, then by name."""
    rank = lambda x: F.struct(F.when(x.isin("HH", "VV"), 0).otherwise(1).alias("r"), x.alias("b"))
    return F.transform(F.array_sort(F.transform(bands, rank)), lambda s: s["b"])


def mode(bands: Column) -> Column:
    """The last mode that contains all bands."""
    out: Column = F.lit(None).cast("string")
    for name, members in MODES.items():
        out = F.when(F.size(F.array_except(bands, F.array(*[F.lit(m) for m in members]))) == 0, F.lit(name)).otherwise(out)
    return out


def uniformity(df: DataFrame) -> DataFrame:
    """Per frequency: inputs, and whether spacing and polarisations agree; ``everywhere`` if all inputs have it."""
    inputs = df.agg(F.count("*").alias("inputs"))  # one row
    parts = df.select("granule", F.explode("freqs").alias("f")).select("granule", "f.*")
    out = parts.groupBy("freq").agg(
        F.countDistinct("granule").alias("having"), (F.countDistinct("spacing") == 1).cast("int").alias("one_spacing"),
        (F.countDistinct(F.array_sort("pols")) == 1).cast("int").alias("one_pols"),
    )
    return out.crossJoin(F.broadcast(inputs)).withColumn("everywhere", (F.col("having") == F.col("inputs")).cast("int")).drop("inputs")


def tags(df: DataFrame, columns: dict[str, Column], key: str) -> DataFrame:
    """Named values as (product, key, value) rows."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in columns.items()])
    return df.select(F.col(key).alias("product"), F.explode(entries).alias("t")).select("product", "t.key", "t.value")


#: Display names of threshold methods, and the tag that has one. Fixed values.
METHODS = {"ki": "Kittler-Illingworth", "otsu": "Otsu", "rg": "Region-growing based approach"}
METHOD_TAG = "PROCESSING_INFORMATION_THRESHOLDING"
#: Tags of a run's parameters and the paths of their values; several values become a list. Fixed values.
PARAMETER_TAGS = {"POLARIZATION": ("processing.polarizations",)} | {
    f"PROCESSING_INFORMATION_{name}": paths
    for name, paths in {
        "FILTER": ("filter.method",), "FILTER_ENABLED": ("filter.enabled",), "FILTER_OPTION": ("filter.window",), "THRESHOLDING": ("threshold.method",), "THRESHOLD_TILE_SELECTION": ("threshold.selection",),
        "THRESHOLD_TILE_AVERAGE": ("threshold.average",), "THRESHOLD_MULTI_THRESHOLD": ("threshold.multi",), "THRESHOLD_BIMODALITY": ("threshold.bimodality",), "THRESHOLD_TWELE": ("threshold.twele",),
        "THRESHOLD_BOUNDS": ("threshold.bounds.co", "threshold.bounds.cross"), "REGION_GROWING_INITIAL_SEED": ("growing.initial",), "REGION_GROWING_RELAXED_THRESHOLD": ("growing.relaxed",),
        "MASKING_ANCILLARY_CO_POL_THRESHOLD": ("masking.co",), "MASKING_ANCILLARY_CROSS_POL_THRESHOLD": ("masking.cross",), "MASKING_ANCILLARY_WATER_THRESHOLD": ("masking.water",),
        "FUZZY_VALUE_HAND": ("fuzzy.hand.min", "fuzzy.hand.max"), "FUZZY_VALUE_SLOPE": ("fuzzy.slope.min", "fuzzy.slope.max"), "FUZZY_VALUE_REFERENCE_WATER": ("fuzzy.reference.min", "fuzzy.reference.max"),
        "FUZZY_VALUE_AREA": ("fuzzy.area.min", "fuzzy.area.max"), "FUZZY_VALUE_DARK_AREA": ("fuzzy.dark.land", "fuzzy.dark.water"), "FUZZY_VALUE_HIGH_FREQUENT_AREA": ("fuzzy.frequent.min", "fuzzy.frequent.max"),
        "REFINE_BIMODALITY_MINIMUM_PIXEL": ("refine.minimum",), "REFINE_BIMODALITY_THRESHOLD": ("refine.ashman", "refine.bhattacharyya", "refine.bm", "refine.surface"), "INUNDATED_VEGETATION": ("vegetation.enabled",),
        "INUNDATED_VEGETATION_DUAL_POL_RATIO_MAX": ("vegetation.ratio.max",), "INUNDATED_VEGETATION_DUAL_POL_RATIO_MIN": ("vegetation.ratio.min",), "INUNDATED_VEGETATION_DUAL_POL_RATIO_THRESHOLD": ("vegetation.ratio.threshold",),
        "INUNDATED_VEGETATION_CROSS_POL_MIN": ("vegetation.cross",), "INUNDATED_VEGETATION_AREA_DATA_TYPE": ("vegetation.source",), "INUNDATED_VEGETATION_TARGET_CLASS": ("vegetation.classes",), "INUNDATED_VEGETATION_FILTER": ("vegetation.filter",),
    }.items()
}


def parameter_tags(df: DataFrame, parameters: str, key: str) -> DataFrame:
    """A map of parameters by path as (product, key, value) rows, one per tag; the threshold method by its display name."""
    one = lambda path: F.col(parameters)[F.lit(path)]
    listed = lambda paths: F.concat(F.lit("["), F.concat_ws(", ", *map(one, paths)), F.lit("]"))
    values = {tag: one(paths[0]) if len(paths) == 1 else listed(paths) for tag, paths in PARAMETER_TAGS.items()}
    shown = F.create_map(*[F.lit(x) for pair in METHODS.items() for x in pair])
    return tags(df, values | {METHOD_TAG: shown[values[METHOD_TAG]]}, key)


def numbered(df: DataFrame, order: str, name: str) -> DataFrame:
    """``df`` with ``name``, each row's place in the order of a column from 1.

    Rows are dealt to ranges, numbered within each, and shifted by the rows of the ranges before: no task sees them all.
    The ranges are written, since what is counted and what is numbered must be the same.
    """
    rows = morph.kept(df.repartitionByRange(F.col(order)).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    ahead = rows.groupBy("_range").agg(F.count("*").alias("_rows")).select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_ahead"))
    at = F.row_number().over(Window.partitionBy("_range").orderBy(order))
    return rows.withColumn("_at", at).join(F.broadcast(ahead), "_range").withColumn(name, (F.col("_at") + F.col("_ahead")).cast("int")).drop("_range", "_at", "_ahead")


def trimmed(text: Column, sides: int = 2) -> Column:
    """The text without its first and last signs: a list of one name, as it is written, to the name."""
    return F.substring(text, F.lit(1 + sides), F.greatest(F.lit(0), F.char_length(text) - 2 * sides))


#: What a product says of its type, source, spacecraft and sensor.
BASE_TAGS = {
    "one": {"PRODUCT_TYPE": "WATER-S1", "SPACECRAFT_NAME": "Sentinel-1", "SENSOR": "IW"},
    "two": {"PRODUCT_TYPE": "WATER-NI", "SPACECRAFT_NAME": "NISAR", "SENSOR": "LSAR"},
}


def base_tags(sensor: Column, version: Column, processed: Column) -> Column:
    """The tags that every product of a sensor has, as a map; ``processed`` is the time of its making."""
    both = F.create_map(F.lit("SOFTWARE_VERSION"), version, F.lit("PROCESSING_DATETIME"), F.date_format(processed, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    out: Column = both
    for name, tags in BASE_TAGS.items():
        own = F.create_map(*[F.lit(x) for pair in tags.items() for x in pair])
        out = F.when(sensor == name, F.map_concat(own, both)).otherwise(out)
    return out
