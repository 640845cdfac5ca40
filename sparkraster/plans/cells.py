"""Queries over cell layers: scales, masks, memberships, products."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import maths
from ..operators import hist, masks, product
from ..sources import fixtures, tables, tiles
from ..sources.fixtures import LAYERS_SQL

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def r6(x):
    return F.round(x, 6)


def db(spark: SparkSession, sf: str) -> DataFrame:
    """Layers with co_db, cross_db, occurrence, and a gentle stand-in slope (dem mod 10)."""
    return scaled(fixtures.layers(spark, sf))


def scaled(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"co_db": r6(maths.to_db("co")), "cross_db": r6(maths.to_db("cross")), "occurrence": maths.occurrence_share("refwater"), "slope": F.col("dem") % 10})


DB = f"""{LAYERS_SQL},
d AS (SELECT *, CASE WHEN co > 0 THEN round(10 * log10(co), 6) END AS co_db, CASE WHEN "cross" > 0 THEN round(10 * log10("cross"), 6) END AS cross_db,
  nullif(refwater, 255) / 100 AS occurrence, dem % 10 AS slope FROM l)"""


def smf(x: str, a: float, b: float) -> str:
    m = (a + b) / 2
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= {a!r}::DOUBLE THEN 0 WHEN {x} >= {b!r}::DOUBLE THEN 1 WHEN {x} <= {m!r}::DOUBLE THEN 2 * pow(({x} - {a!r}::DOUBLE) / ({b - a!r}::DOUBLE), 2) ELSE 1 - 2 * pow(({x} - {b!r}::DOUBLE) / ({b - a!r}::DOUBLE), 2) END)::DOUBLE"


def zmf(x: str, a: float, b: float) -> str:
    m = (a + b) / 2
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= {a!r}::DOUBLE THEN 1 WHEN {x} >= {b!r}::DOUBLE THEN 0 WHEN {x} <= {m!r}::DOUBLE THEN 1 - 2 * pow(({x} - {a!r}::DOUBLE) / ({b - a!r}::DOUBLE), 2) ELSE 2 * pow(({x} - {b!r}::DOUBLE) / ({b - a!r}::DOUBLE), 2) END)::DOUBLE"


@query(f"""WITH {DB} SELECT row, col, co_db, round(pow(10, co_db / 10), 6) AS co_back, round((co_db + 35) / 45, 6) AS scaled FROM d WHERE co_db > -35""")
def db_scale(spark, sf):
    rows = db(spark, sf).where("co_db > -35")
    return rows.select("row", "col", "co_db", r6(maths.to_power("co_db")).alias("co_back"), r6(maths.rescale("co_db", -35, 10)).alias("scaled"))


@query(f"""WITH {LAYERS_SQL} SELECT row, col, round(CASE WHEN "cross" = 0 THEN 0 ELSE co / "cross" END, 6) AS ratio, round(co + 2 * "cross", 9) AS span FROM l""")
def ratio_span(spark, sf):
    return fixtures.layers(spark, sf).select("row", "col", r6(maths.pol_ratio("co", "cross")).alias("ratio"), F.round(maths.span("co", "cross"), 9).alias("span"))


@query(f"""WITH {LAYERS_SQL} SELECT row, col, ("cross" IS NULL)::INT AS invalid, CASE WHEN "cross" > 0.03 THEN 0.03 WHEN "cross" = 0 THEN NULL ELSE "cross" END AS cleaned,
  CASE WHEN shadow = 0 THEN co END AS masked FROM l""")
def invalid_mask(spark, sf):
    rows = fixtures.layers(spark, sf)
    return rows.select("row", "col", F.col("cross").isNull().cast("int").alias("invalid"), tables.clean_intensity(F.col("cross"), 0.03).alias("cleaned"), F.when(F.col("shadow") == 0, F.col("co")).alias("masked"))


@query(f"""WITH {LAYERS_SQL} SELECT row, col, (landcover IN (60, 30, 90))::INT AS target, (glad BETWEEN 112 AND 148 OR glad BETWEEN 200 AND 207 OR glad BETWEEN 19 AND 24)::INT AS vegetation FROM l WHERE landcover <> 10""")
def class_mask(spark, sf):
    rows = masks.valid_only(fixtures.layers(spark, sf), "landcover", 10)
    codes = masks.parse_ranges(F.array(*[F.lit(x) for x in masks.VEGETATION_RANGES]))
    target = masks.landcover_mask(F.col("landcover"), ["Bare sparse vegetation", 30, "Herbaceous wetland"])
    return rows.select("row", "col", target.cast("int").alias("target"), F.array_contains(codes, F.col("glad")).cast("int").alias("vegetation"))


@query(f"""WITH {LAYERS_SQL}, r AS (SELECT unnest(list_distinct(flatten([range(112, 125), range(200, 208), range(19, 25), range(125, 149)])))::INT AS code)
SELECT row, col, code FROM l JOIN r ON code = glad""")
def range_codes(spark, sf):
    """Cells whose code is in one of the ranges, as text names them."""
    ranges = masks.parse_ranges(F.array(*[F.lit(x) for x in masks.VEGETATION_RANGES]))
    return fixtures.layers(spark, sf).select("row", "col", F.explode(ranges).alias("code"), "glad").where("code = glad").select("row", "col", "code")


@query(f"""WITH {DB} SELECT row, col, round({smf('occurrence', 0.8, 0.95)}, 6) AS rise FROM d""")
def membership_s(spark, sf):
    return db(spark, sf).select("row", "col", r6(maths.smf("occurrence", 0.8, 0.95)).alias("rise"))


@query(f"""WITH {DB} SELECT row, col, round({zmf('co_db', -18.0, -10.0)}, 6) AS fall, round({zmf('hand', 0.0, 15.0)}, 6) AS hand_fall FROM d""")
def membership_z(spark, sf):
    return db(spark, sf).select("row", "col", r6(maths.zmf("co_db", -18.0, -10.0)).alias("fall"), r6(maths.zmf("hand", 0.0, 15.0)).alias("hand_fall"))


@query(f"""WITH {DB} SELECT row, col, round({zmf('co_db', -18.0, -6.0)}, 6) AS fall FROM d""")
def membership_recentred(spark, sf):
    return db(spark, sf).select("row", "col", r6(maths.zmf_recentred("co_db", -18.0, -12.0)).alias("fall"))


def substituted(rows: DataFrame) -> DataFrame:
    """Memberships co_z, cross_z, one replaced by the other over frequent and dark water and flat land."""
    cross, occurrence = F.col("cross_db"), F.col("occurrence")
    swap = masks.frequent_water(occurrence, cross, dark=-16) | masks.flat_land(F.col("landcover"), F.col("slope"), cross, dark=-16)
    rows = rows.withColumns({"co_0": maths.zmf("co_db", -18.0, -8.0), "cross_0": maths.zmf("cross_db", -22.0, -14.0), "dark": masks.dark_water(occurrence, cross, dark=-17)})
    rows = rows.withColumn("cross_z", F.when(swap, F.col("co_0")).otherwise(F.col("cross_0")))
    return rows.withColumn("co_z", F.when(F.col("dark"), F.col("cross_z")).otherwise(F.col("co_0")))


SUBSTITUTED = f"""{DB},
m AS (SELECT *, {zmf('co_db', -18.0, -8.0)} AS co_0, {zmf('cross_db', -22.0, -14.0)} AS cross_0,
  coalesce((occurrence > 0.1 AND occurrence < 0.9 AND cross_db < -16) OR (landcover IN (60, 20, 30, 90) AND slope < 5 AND cross_db < -16), FALSE) AS swap, coalesce(occurrence >= 0.9 AND cross_db < -17, FALSE) AS dark FROM d),
n AS (SELECT *, CASE WHEN swap THEN co_0 ELSE cross_0 END AS cross_z FROM m),
z AS (SELECT *, CASE WHEN dark THEN cross_z ELSE co_0 END AS co_z FROM n)"""


@query(f"""WITH {SUBSTITUTED} SELECT row, col, round(CASE WHEN cross_z IS NULL THEN co_z WHEN co_z IS NULL THEN cross_z ELSE (co_z + cross_z) / 2 END, 6) AS mean_z FROM z""")
def band_mean_substitute(spark, sf):
    return substituted(db(spark, sf)).select("row", "col", r6(maths.known_mean(F.col("co_z"), F.col("cross_z"))).alias("mean_z"))


COMBINED = f"""{SUBSTITUTED},
c AS (SELECT *, 0.5 * CASE WHEN cross_z IS NULL THEN co_z WHEN co_z IS NULL THEN cross_z ELSE (co_z + cross_z) / 2 END
  + 0.5 * (({zmf('coalesce(hand, 0)', 0.0, 15.0)} + {zmf('slope', 0.5, 15.0)} + {smf('occurrence', 0.8, 0.95)}) / 3) AS membership FROM z),
f AS (SELECT *, CASE WHEN "cross" IS NULL THEN NULL WHEN hand > 200 THEN 0 ELSE round(membership, 6) END AS fuzzy FROM c)"""


def combined(spark: SparkSession, sf: str) -> DataFrame:
    return scored(db(spark, sf))


def scored(rows: DataFrame) -> DataFrame:
    """Membership in ``fuzzy``: 0 above the drainage limit, missing where a band is."""
    rows = masks.membership(substituted(rows))
    return rows.withColumn("fuzzy", F.when(F.col("cross").isNull(), None).when(F.col("hand") > 200, 0.0).otherwise(r6("membership")))


@query(f"""WITH {COMBINED} SELECT row, col, fuzzy FROM f""")
def membership_combined(spark, sf):
    """From stored tiles: the three layers meet by tile, and become cells where they lie."""
    layers = tiles.to_cells(tiles.join_tiles(list(fixtures.tiled(spark, sf).values())), [c for own in fixtures.TILED.values() for c in own])
    return scored(scaled(layers.withColumn("landcover", F.col("landcover").cast("int")))).select("row", "col", "fuzzy")


@query(f"""WITH {LAYERS_SQL} SELECT row, col, CASE WHEN refwater = 255 THEN CASE WHEN landcover = 80 OR coalesce(hand <= 0.002, FALSE) THEN 100 ELSE 0 END ELSE refwater END::DOUBLE AS repaired FROM l""")
def occurrence_repair(spark, sf):
    return fixtures.layers(spark, sf).select("row", "col", masks.repaired_occurrence(F.col("refwater"), F.col("landcover"), F.col("hand")).alias("repaired"))


@query(f"""WITH {DB} SELECT row, col FROM d WHERE landcover IN (60, 30) AND occurrence < 0.2 AND co_db < -6 AND cross_db < -16""")
def dark_land(spark, sf):
    rows = db(spark, sf)
    test = masks.dark_land(masks.landcover_mask(F.col("landcover"), [60, 30]), F.col("occurrence"), F.col("co_db"), F.col("cross_db"), 0.2, -6, -16)
    return rows.where(test).select("row", "col")


def vegetated(rows: DataFrame) -> DataFrame:
    """kind, high (ratio and cross band), veg."""
    rows = rows.withColumn("ratio_db", r6(maths.to_db(maths.pol_ratio("co", "cross"), 1e-5))).withColumn("kind", masks.vegetation_class(F.col("glad"), F.col("landcover")))
    rows = rows.withColumn("high", masks.sure(F.col("ratio_db") > 8) & masks.sure(F.col("cross_db") > -26))
    return rows.withColumn("veg", masks.inundated_vegetation(F.col("ratio_db"), F.col("cross_db"), F.col("kind")))


VEG = """v AS (SELECT *, CASE WHEN glad = 255 AND landcover = 90 THEN 2 WHEN glad BETWEEN 112 AND 148 OR glad BETWEEN 200 AND 207 OR glad BETWEEN 19 AND 24 THEN 1 ELSE 0 END::INT AS kind,
  coalesce(round(10 * log10(CASE WHEN "cross" = 0 THEN 0 ELSE co / "cross" END + 1e-5), 6) > 8 AND cross_db > -26, FALSE) AS high FROM f),
w AS (SELECT *, CASE WHEN high AND kind > 0 THEN 2 ELSE 0 END::INT AS veg, coalesce(co_db < -11, FALSE) AS water, coalesce(fuzzy > 0.5, FALSE)::INT AS grown,
  (landcover IN (60, 30))::INT AS cover FROM v)"""
PRODUCTS = f"{COMBINED}, {VEG}"


@query(f"""WITH {PRODUCTS} SELECT row, col, kind, veg, (veg = 2 AND water)::INT AS overlap FROM w""")
def inundated_vegetation(spark, sf):
    rows = vegetated(db(spark, sf))
    return rows.select("row", "col", "kind", "veg", F.when((F.col("veg") == 2) & masks.sure(F.col("co_db") < -11), 1).otherwise(0).alias("overlap"))


@query(f"""WITH {PRODUCTS} SELECT count(*) FILTER (kind = 1) AS first, count(*) FILTER (kind = 2) AS second,
  CASE WHEN count(*) FILTER (kind = 1) > 0 AND count(*) FILTER (kind = 2) > 0 THEN 'GLAD/WorldCover' WHEN count(*) FILTER (kind = 2) > 0 THEN 'WorldCover' ELSE 'GLAD' END AS source FROM w""")
def vegetation_source(spark, sf):
    return product.vegetation_source(vegetated(db(spark, sf)))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    """All layers that the products are made of."""
    rows = vegetated(combined(spark, sf))
    return rows.withColumns({"water": masks.sure(F.col("co_db") < -11), "grown": masks.sure(F.col("fuzzy") > 0.5).cast("int"), "cover": masks.landcover_mask(F.col("landcover"), [60, 30]).cast("int")})


def common_masks() -> dict:
    return {"hand_mask": F.col("hand") > 200, "layover_shadow_mask": F.col("shadow") > 0, "ocean_mask": F.col("glad") == 200, "no_data": F.col("cross").isNull()}


COMMON = "WHEN \"cross\" IS NULL THEN 255 WHEN glad = 200 THEN 254 WHEN shadow > 0 THEN 251 WHEN hand > 200 THEN 250"
WTR = f"{PRODUCTS}, wtr AS (SELECT *, CASE WHEN veg = 2 THEN 3 {COMMON} WHEN water THEN 1 ELSE 0 END::INT AS code FROM w)"


def water_codes(spark, sf):
    return staged(spark, sf).withColumn("code", product.classified(F.col("water"), inundated_vegetation=F.col("veg") == 2, **common_masks()))


@query(f"""WITH {WTR} SELECT row, col, code FROM wtr""")
def wtr(spark, sf):
    return water_codes(spark, sf).select("row", "col", "code")


@query(f"""WITH {PRODUCTS} SELECT row, col, CASE {COMMON} WHEN water OR veg = 2 THEN 1 ELSE 0 END::INT AS code FROM w""")
def bwtr(spark, sf):
    return staged(spark, sf).select("row", "col", product.classified(F.col("water") | (F.col("veg") == 2), **common_masks()).alias("code"))


@query(f"""WITH {PRODUCTS}, b AS (SELECT *, grown = 1 AND cover <> 1 AS lcm, cover = 1 AND NOT water AS dark2, cover = 0 AND water AS bright, kind > 0 AS wet FROM w)
SELECT row, col, CASE {COMMON} WHEN lcm AND wet THEN 37 WHEN dark2 AND wet THEN 36 WHEN veg = 2 AND wet THEN 35 WHEN bright AND wet THEN 32 WHEN water AND wet THEN 31 WHEN NOT water AND wet THEN 30
  WHEN lcm THEN 7 WHEN dark2 THEN 6 WHEN high AND NOT wet AND NOT water THEN 5 WHEN bright THEN 2 WHEN water THEN 1 ELSE 0 END::INT AS code FROM b""")
def conf(spark, sf):
    code = product.confidence(F.col("water"), F.col("grown"), F.col("cover"), F.col("high"), F.col("veg") == 2, F.col("kind") > 0, **common_masks())
    return staged(spark, sf).select("row", "col", code.alias("code"))


@query(f"""WITH {PRODUCTS} SELECT row, col, CASE {COMMON} ELSE coalesce(round_even(100 * fuzzy, 0)::INT, 255) END::INT AS code FROM w""")
def diag(spark, sf):
    return staged(spark, sf).select("row", "col", product.classified(F.col("water"), maths.diagnostic("fuzzy"), **common_masks()).alias("code"))


COLLAPSE = "CASE code WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 WHEN 6 THEN 0 WHEN 7 THEN 0 WHEN 8 THEN 1 WHEN 3 THEN 3 WHEN 250 THEN 250 WHEN 251 THEN 251 WHEN 254 THEN 254 ELSE 255 END"


@query(f"""WITH {WTR} SELECT row, col, ({COLLAPSE})::INT AS collapsed FROM wtr""")
def collapse_classes(spark, sf):
    return water_codes(spark, sf).select("row", "col", product.collapse(F.col("code")).alias("collapsed"))


@query(f"""WITH {WTR} SELECT row, col, (CASE {COLLAPSE} WHEN 3 THEN 1 WHEN 0 THEN 255 WHEN 251 THEN 255 WHEN 254 THEN 255 ELSE {COLLAPSE} END)::INT AS browse FROM wtr""")
def browse_recode(spark, sf):
    return water_codes(spark, sf).select("row", "col", product.browse(F.col("code"), no_vegetation=True, no_land=True, no_shadow=True).alias("browse"))


@query(f"""WITH {PRODUCTS} SELECT row, col, (grown = 1 AND cover = 1)::INT AS both, (grown = 1 OR cover = 1 OR shadow = 1)::INT AS anyone, (grown = 1 AND NOT cover = 1)::INT AS left_over FROM w""")
def merge_layers_and_or(spark, sf):
    rows = staged(spark, sf)
    g, c, s = F.col("grown"), F.col("cover"), F.col("shadow")
    return rows.select("row", "col", masks.combined([(g, 1), (c, 1)]).cast("int").alias("both"), masks.combined([(g, 1), (c, 1), (s, 1)], "or").cast("int").alias("anyone"), ((g == 1) & ~masks.sure(c == 1)).cast("int").alias("left_over"))


@query(f"""WITH {LAYERS_SQL} SELECT count(*) AS cells, count(refwater) AS known, count(*) FILTER (refwater IN (255)) AS invalid, 'invalid_found' AS state FROM l""")
def layer_validation(spark, sf):
    return masks.validation(fixtures.layers(spark, sf), "refwater", [255.0])


@query(f"""WITH {LAYERS_SQL} SELECT min(co) AS low, round(quantile_cont(co, 0.02), 6) AS p2, round(quantile_cont(co, 0.5), 6) AS median, round(quantile_cont(co, 0.98), 6) AS p98, max(co) AS high, count(co) AS n FROM l""")
def layer_summary(spark, sf):
    cells = fixtures.layers(spark, sf).select("co")
    ends = cells.agg(F.min("co").alias("low"), F.max("co").alias("high"), F.count("co").alias("n"))
    found = {"p2": 0.02, "median": 0.5, "p98": 0.98}
    ranks = hist.quantiles(cells, "co", list(found.values())).agg(*[r6(F.max(F.when(F.col("share") == p, F.col("quantile")))).alias(name) for name, p in found.items()])
    return ends.crossJoin(F.broadcast(ranks)).select("low", *found, "high", "n")


@query(f"""WITH {WTR} SELECT round(100.0::DOUBLE * count(*) FILTER (code <> 255) / count(*), 4) AS spatial_coverage,
  CASE WHEN count(*) FILTER (code <> 255) > 0 THEN round(100.0::DOUBLE * count(*) FILTER (code = 251) / count(*) FILTER (code <> 255), 4) ELSE 0 END AS shadow_coverage FROM wtr""")
def spatial_coverage(spark, sf):
    return product.coverage(water_codes(spark, sf))


@query(f"""WITH {PRODUCTS} SELECT row // 10 AS block, round(count(*) FILTER (water AND "cross" IS NOT NULL) / count(*) FILTER ("cross" IS NOT NULL)::DOUBLE, 6) AS fraction FROM w GROUP BY ALL""")
def water_fraction(spark, sf):
    rows = staged(spark, sf).where("cross is not null").groupBy(F.floor(F.col("row") / 10).cast("int").alias("block"))
    return rows.agg(r6(F.avg(F.col("water").cast("double"))).alias("fraction"))


@query(f"""WITH {PRODUCTS} SELECT count(*) FILTER (water AND cover = 1) AS removed, count(*) FILTER (water AND cover <> 1) AS kept FROM w""")
def removed_kept(spark, sf):
    return staged(spark, sf).agg(F.count_if(F.col("water") & (F.col("cover") == 1)).alias("removed"), F.count_if(F.col("water") & (F.col("cover") != 1)).alias("kept"))


@query(f"""WITH {DB} SELECT row, col, round(0.5 * exp(-(co_db + 18) * (co_db + 18) / 2 / 4), 6) + round(0.2 * exp(-(co_db + 8) * (co_db + 8) / 2 / 9), 6) AS both FROM d""")
def gaussian_eval(spark, sf):
    """Two modes at every cell's value."""
    rows = db(spark, sf)
    return rows.select("row", "col", (r6(maths.gaussian("co_db", -18, 2, 0.5)) + r6(maths.gaussian("co_db", -8, 3, 0.2))).alias("both"))


@query(f"""WITH {LAYERS_SQL}, m AS (SELECT max(row) + 1 AS rows, max(col) + 1 AS cols FROM l) SELECT r::INT AS row, c::INT AS col, 1.5::DOUBLE AS value FROM (SELECT unnest(range(rows)) AS r, cols FROM m), LATERAL (SELECT unnest(range(cols)) AS c)""")
def constant_layer(spark, sf):
    """One value on the whole grid of the layers."""
    size = fixtures.layers(spark, sf).agg(F.max("row") + 1, F.max("col") + 1).first()  # one row
    return tables.constant_layer(spark, size[0], size[1], 1.5)
