"""Queries over overlapping scenes and grids: mosaics, resampling, tiles, comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo
from ..operators import compare, masks, mosaic, resample
from ..sources import fixtures, tables
from ..sources.fixtures import GRANULES_SQL, LAYERS_SQL, SCENES_SQL, TILES_SQL
from .cells import DB, PRODUCTS, WTR, db, staged, water_codes

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"""WITH {SCENES_SQL} SELECT row, col, round(sum(value * looks) / sum(looks), 6) AS weighted, round(sum(value) / count(*) FILTER (value > 0), 6) AS plain, count(*)::INT AS scenes FROM s GROUP BY row, col""")
def mosaic_average(spark, sf):
    rows = fixtures.scenes(spark, sf)
    plain = mosaic.average(rows).select("row", "col", F.round("value", 6).alias("plain"))
    return mosaic.average(rows, "looks").select("row", "col", F.round("value", 6).alias("weighted"), "scenes").join(plain, ["row", "col"])


@query(f"""WITH {SCENES_SQL} SELECT row, col, min_by(value, scene) AS value, min(scene) AS scene FROM s GROUP BY row, col""")
def mosaic_first(spark, sf):
    return mosaic.first_valid(fixtures.scenes(spark, sf))


@query(f"""WITH {SCENES_SQL}, c AS (SELECT scene, avg(row) AS r0, avg(col) AS c0 FROM s GROUP BY scene),
d AS (SELECT s.*, round(pow(row - r0, 2) + pow(col - c0, 2), 6) AS far FROM s JOIN c USING (scene))
SELECT row, col, min_by(value, (far, -scene)) AS value, min_by(scene, (far, -scene)) AS scene FROM d GROUP BY row, col""")
def mosaic_centre(spark, sf):
    return mosaic.nearest_centre(fixtures.scenes(spark, sf))


@query(f"""WITH {GRANULES_SQL}, u AS (SELECT min(x0) AS start_x, max(x0 + side) AS end_x, max(y0 + side) AS start_y, min(y0) AS end_y, min(spacing_a) AS spacing, count(DISTINCT epsg) AS zones FROM g)
SELECT *, floor((end_x - start_x) / spacing)::INT AS width, floor((start_y - end_y) / spacing)::INT AS length, (zones = 1)::INT AS same_zone FROM u""")
def geogrid_union(spark, sf):
    return mosaic.geogrid(fixtures.granules(spark, sf).withColumn("spacing", F.col("freqs")[0]["spacing"]))


@query(f"""WITH {GRANULES_SQL}, c AS (SELECT epsg, count(*) AS n, min(key) AS first FROM g GROUP BY epsg) SELECT epsg, n FROM c ORDER BY n DESC, first LIMIT 1""")
def majority_value(spark, sf):
    return mosaic.majority(fixtures.granules(spark, sf), "epsg", "key")


@query(f"""WITH {DB} SELECT (row // 4)::INT AS row, (col // 4)::INT AS col, sum(shadow)::BIGINT AS total, count(*) FILTER (shadow > 0) AS positive,
  CASE WHEN count(*) FILTER (shadow > 0) > 0 THEN sum(shadow)::DOUBLE / count(*) FILTER (shadow > 0) END AS mean FROM d GROUP BY row // 4, col // 4 HAVING count(DISTINCT d.row) >= 3""")
def multilook(spark, sf):
    return resample.multilook(fixtures.layers(spark, sf), 4, "shadow")


@query(f"""WITH {DB}, k AS (SELECT unnest(range(9)) AS k), b AS (SELECT row * 3 + k // 3 AS r, col * 3 + k % 3 AS c, (co_db < -11)::INT AS water FROM d, k),
n AS (SELECT (r // 4)::INT AS row, (c // 4)::INT AS col, sum(water)::BIGINT AS n FROM b GROUP BY ALL)
SELECT row, col, n, CASE WHEN n >= 5 THEN 1 WHEN n > 0 THEN 8 ELSE 0 END::INT AS partial FROM n""")
def partial_water(spark, sf):
    rows = db(spark, sf).select("row", "col", masks.sure(F.col("co_db") < -11).cast("int").alias("n"))
    coarse = resample.regrid(rows, 30, 40, "n")
    return coarse.withColumn("partial", masks.partial_water(F.col("n")).cast("int"))


@query(f"""WITH {LAYERS_SQL}, f AS (SELECT unnest([4, 16, 64])::INT AS factor) SELECT factor, (row // factor)::INT AS row, (col // factor)::INT AS col,
  max(CASE WHEN l.row % factor = factor // 2 AND l.col % factor = factor // 2 THEN landcover END) AS landcover, avg(round(co * 1e8)::BIGINT) AS co FROM l, f GROUP BY factor, l.row // factor, l.col // factor""")
def overview(spark, sf):
    rows = fixtures.layers(spark, sf).withColumn("co", F.round(F.col("co") * 1e8).cast("long"))
    return resample.overviews(rows, (4, 16, 64), "landcover", "co")


@query(f"""WITH {LAYERS_SQL}, t AS (SELECT row, col, floor((row + 0.5) * 20 / 30)::INT AS r, floor((col + 0.5) * 20 / 30)::INT AS c FROM l)
SELECT t.row, t.col, coalesce(l.landcover, 0) AS landcover FROM t LEFT JOIN l ON l.row = t.r AND l.col = t.c""")
def resample_nearest(spark, sf):
    rows = fixtures.layers(spark, sf)
    return resample.nearest(rows.select("row", "col"), rows, 20.0, 30.0, missing=0, value="landcover").select("row", "col", "landcover")


@query(f"""WITH {LAYERS_SQL}, {TILES_SQL}, x AS (SELECT landcover, 500000 + (col + 0.5) * 300 AS x, 4100000 - (row + 0.5) * 300 AS y FROM l)
SELECT mgrs_tile, floor((ymax - y) / 300)::INT AS row, floor((x - xmin) / 300)::INT AS col, landcover FROM x JOIN t ON x >= xmin AND x < xmax AND y > ymin AND y <= ymax""")
def cut_tiles(spark, sf):
    rows = fixtures.layers(spark, sf).select("landcover", (500000 + (F.col("col") + 0.5) * 300).alias("x"), (4100000 - (F.col("row") + 0.5) * 300).alias("y"))
    return resample.cut_to_tiles(rows, fixtures.map_tiles(spark, sf), 300.0).select("mgrs_tile", "row", "col", "landcover")


@query(f"""WITH {LAYERS_SQL}, m AS (SELECT max(row) // 32 AS most FROM l), k AS (SELECT unnest(range(most + 1))::INT AS tile_row FROM m)
SELECT tile_row, count(*) AS cells, count(*) FILTER (row // 32 = tile_row) AS own, min(row) AS first, max(row) AS last FROM l JOIN k ON row BETWEEN tile_row * 32 - 8 AND tile_row * 32 + 39 GROUP BY tile_row""")
def block_halo(spark, sf):
    return _halo(fixtures.layers(spark, sf))


@query(f"""WITH {LAYERS_SQL}, m AS (SELECT max(row) // 32 AS most FROM l), k AS (SELECT unnest(range(most + 1))::INT AS tile_row FROM m)
SELECT tile_row, count(*) AS cells, count(*) FILTER (row // 32 = tile_row) AS own, min(row) AS first, max(row) AS last FROM l JOIN k ON row BETWEEN tile_row * 32 - 8 AND tile_row * 32 + 39 GROUP BY tile_row""")
def block_halo_all(spark, sf):
    return _halo(fixtures.layers(spark, sf))


def _halo(rows):
    most = rows.agg(F.floor(F.max("row") / 32).cast("int").alias("most"))
    rows = rows.crossJoin(F.broadcast(most))  # one row
    tiles = rows.withColumn("tile_row", F.explode(resample.halo_keys("row", 32, 8, "most")))
    return tiles.groupBy("tile_row").agg(F.count("*").alias("cells"), F.count_if(F.floor(F.col("row") / 32) == F.col("tile_row")).alias("own"), F.min("row").alias("first"), F.max("row").alias("last"))


@query(f"""WITH {WTR}, o AS (SELECT row, col, code AS value FROM wtr), nn AS (SELECT row, col, CASE WHEN (row * 7 + col) % 97 = 0 THEN code + 1 ELSE code END AS value FROM wtr WHERE (row + col) % 101 <> 0)
SELECT o.row, o.col, o.value AS left_value, nn.value AS right_value FROM o LEFT JOIN nn USING (row, col) WHERE nn.value IS NULL OR abs(o.value - nn.value) >= 1e-6""")
def product_diff(spark, sf):
    old, new = _variants(spark, sf)
    return compare.differences(old, new, ["row", "col"])


@query(f"""WITH {WTR}, nn AS (SELECT row, col, code AS left_value, CASE WHEN (row * 7 + col) % 97 = 0 THEN code + 1 WHEN (row + col) % 101 = 0 THEN NULL ELSE code END AS right_value FROM wtr),
x AS (SELECT row, col, left_value, CASE WHEN (row + col) % 101 = 0 THEN NULL ELSE right_value END AS right_value FROM nn),
y AS (SELECT * FROM x WHERE right_value IS NULL OR left_value <> right_value) SELECT *, (SELECT count(*) FROM y) AS n FROM y ORDER BY row, col LIMIT 1""")
def first_diff(spark, sf):
    old, new = _variants(spark, sf)
    return compare.first_difference(compare.differences(old, new, ["row", "col"]), ["row", "col"])


def _variants(spark, sf):
    old = water_codes(spark, sf).select("row", "col", F.col("code").alias("value"))
    new = old.where((F.col("row") + F.col("col")) % 101 != 0).withColumn("value", F.when((F.col("row") * 7 + F.col("col")) % 97 == 0, F.col("value") + 1).otherwise(F.col("value")))
    return old, new


@query(f"""WITH {GRANULES_SQL}, a AS (SELECT granule AS tag, CASE WHEN key % 5 = 0 THEN 'b, a' ELSE burst_id || track END AS value FROM g WHERE key % 10 <> 3),
b AS (SELECT granule AS tag, CASE WHEN key % 5 = 0 THEN 'a, b' WHEN key % 4 = 0 THEN 'other' ELSE burst_id || track END AS value FROM g WHERE key % 10 <> 7)
SELECT tag AS key, a.value AS left_value, b.value AS right_value FROM a FULL JOIN b USING (tag) WHERE tag NOT LIKE '%8' AND (CASE WHEN a.value = 'b, a' THEN 'a, b' ELSE a.value END) IS DISTINCT FROM b.value""")
def tag_diff(spark, sf):
    """Tags of all scenes in two versions; keys of every fifth hold lists, keys that end in 8 may differ."""
    rows = fixtures.granules(spark, sf)
    plain, five = F.concat("burst_id", F.col("track").cast("string")), F.col("key") % 5 == 0
    left = rows.where("key % 10 <> 3").select(F.col("granule").alias("key"), F.when(five, "b, a").otherwise(plain).alias("value"))
    right = rows.where("key % 10 <> 7").select(F.col("granule").alias("key"), F.when(five, "a, b").when(F.col("key") % 4 == 0, "other").otherwise(plain).alias("value"))
    return compare.tag_differences(left, right, F.col("key").endswith("8"), F.substring("key", 2, 20).cast("int") % 5 == 0)


@query(f"""WITH {LAYERS_SQL} SELECT (max(row) + 1)::INT AS length, (max(col) + 1)::INT AS width, 1::BIGINT AS bands, 500000.0::DOUBLE AS x0, 4000000.0 + 300 * (max(row) + 1) AS y0 FROM l""")
def raster_descriptor(spark, sf):
    rows = fixtures.layers(spark, sf).select("row", "col", F.lit("co").alias("band"))
    shape = rows.agg((F.max("row") + 1).cast("int").alias("length"), (F.max("col") + 1).cast("int").alias("width"), F.countDistinct("band").alias("bands"))
    # Corners lie half a cell outside the first cell's centre.
    return shape.withColumns({"x0": F.lit(500150.0) - 150.0, "y0": F.lit(4000000.0) + 300.0 * F.col("length")})


@query(f"""WITH {LAYERS_SQL} SELECT row, col, co AS value FROM l""")
def layer_roundtrip(spark, sf):
    return _read_back(spark, sf)


@query(f"""WITH {LAYERS_SQL} SELECT row, col, co AS value FROM l""")
def layer_roundtrip_all(spark, sf):
    return _read_back(spark, sf)


def _read_back(spark, sf):
    from ..sources.folders import scratch

    path = scratch(spark, "layers")
    rows = fixtures.layers(spark, sf)
    bands = F.explode(F.array(F.struct(F.lit("co").alias("band"), F.col("co").alias("value")), F.struct(F.lit("cross").alias("band"), F.col("cross").alias("value"))))
    tables.write_layer(rows.select(F.lit("one").alias("scene"), "row", "col", bands.alias("b")).select("scene", "b.band", "row", "col", "b.value"), path)
    return tables.read_layer(spark, path, "co").select("row", "col", "value")


@query(f"""WITH {PRODUCTS} SELECT row, col, CASE WHEN water AND veg = 2 THEN 3 WHEN water THEN 1 WHEN veg = 2 THEN 2 END::INT AS value FROM w WHERE water OR veg = 2""")
def merge_band_sets(spark, sf):
    rows = staged(spark, sf)
    first = rows.select("row", "col", F.when(F.col("water"), F.when(F.col("veg") == 2, 3).otherwise(1)).otherwise(255).alias("value"), F.lit(0).alias("order"))
    second = rows.select("row", "col", F.when(F.col("veg") == 2, 2).otherwise(255).alias("value"), F.lit(1).alias("order"))
    both = first.unionByName(second).where("value <> 255")
    return both.groupBy("row", "col").agg(F.min_by("value", "order").alias("value"))


@query(f"""WITH {SCENES_SQL}, g AS (SELECT scene, value, (row + floor((10 + 90 * scene) / 30.0 + 0.5))::INT AS row, (col + floor((30 * scene - 105) / 30.0 + 0.5))::INT AS col FROM s)
SELECT row, col, min_by(value, scene) AS value, min(scene) AS scene FROM g WHERE row >= 0 AND row < 1400 AND col >= 0 AND col < 90 GROUP BY row, col""")
def place_scenes(spark, sf):
    """Scenes with grids of their own, on the mosaic's, first valid."""
    rows = fixtures.scenes(spark, sf)
    grids = rows.select("scene").distinct().select("scene", (F.col("scene") * 30 - 105).cast("double").alias("x0"), (-10 - F.col("scene") * 90).cast("double").alias("y0"))
    return mosaic.first_valid(mosaic.placed(rows, grids, 30.0, 0.0, 0.0, 90, 1400))


def _inverse() -> str:
    """SQL: (x, y) of zone 10 to lon, lat, in steps."""
    x = " ".join(f"- {b!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(geo.BETA, 1))
    y = " ".join(f"- {b!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(geo.BETA, 1))
    k, e, sin = repr(geo.SCALE * geo.RADIUS), repr(geo.ECC), "s0"
    steps = []
    for i in range(1, 6):
        steps.append(f"i{i + 2} AS (SELECT *, tanh(psi + {e} * atanh({e} * {sin})) AS s{i} FROM i{i + 1})")
        sin = f"s{i}"
    return f"""i0 AS (SELECT *, y / {k} AS xi, (x - 500000) / {k} AS eta FROM c), i1 AS (SELECT *, xi {y} AS xi1, eta {x} AS eta1 FROM i0),
i2 AS (SELECT *, degrees(atan2(sinh(eta1), cos(xi1))) - 123 AS lon, sin(xi1) / cosh(eta1) AS s0, atanh(sin(xi1) / cosh(eta1)) AS psi FROM i1),
{", ".join(steps)}, geo AS (SELECT row, col, lon, degrees(asin({sin})) AS lat FROM i7)"""


def _forward() -> str:
    """SQL: lon, lat to (x, y) of zone 11."""
    e, k = repr(geo.ECC), repr(geo.SCALE * geo.RADIUS)
    x = " + ".join(["eta", *[f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)]])
    y = " + ".join(["xi", *[f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)]])
    return f"""f1 AS (SELECT *, radians(lon + 117) AS lam, sin(radians(lat)) AS si FROM geo), f2 AS (SELECT *, sinh(atanh(si) - {e} * atanh({e} * si)) AS t FROM f1),
f3 AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM f2), pr AS (SELECT row, col, 500000 + {k} * ({x}) AS px, {k} * ({y}) AS py FROM f3)"""


@query(f"""WITH {LAYERS_SQL}, c AS (SELECT row, col, 736000 + (col + 0.5) * 900 AS x, 4300000 - (row + 0.5) * 900 AS y FROM l), {_inverse()}, {_forward()},
k AS (SELECT row, col, floor((4300000 - py) / 900)::INT AS r, floor((px - 200000) / 900)::INT AS c FROM pr)
SELECT k.row, k.col, l.landcover FROM k LEFT JOIN l ON l.row = k.r AND l.col = k.c""")
def reproject_layer(spark, sf):
    """A layer of one zone on the grid of its neighbour, by the nearest cell."""
    rows = fixtures.layers(spark, sf)
    return resample.reprojected(rows, rows, 10, 11, 900.0, (736000.0, 4300000.0), (200000.0, 4300000.0), "landcover")


@query(f"""WITH {LAYERS_SQL}, f AS (SELECT unnest([4, 16, 64, 128])::INT AS factor) SELECT factor, (row // factor)::INT AS row, (col // factor)::INT AS col,
  max(CASE WHEN l.row % factor = factor // 2 AND l.col % factor = factor // 2 THEN landcover END) AS landcover, avg(round(co * 1e8)::BIGINT) AS co FROM l, f GROUP BY factor, l.row // factor, l.col // factor""")
def overview_all(spark, sf):
    """All four levels of the pyramid."""
    rows = fixtures.layers(spark, sf).withColumn("co", F.round(F.col("co") * 1e8).cast("long"))
    return resample.overviews(rows, (4, 16, 64, 128), "landcover", "co")


@query(f"""WITH {LAYERS_SQL} SELECT row, col, coalesce(shadow, 255)::INT AS shadow, CASE WHEN "cross" IS NULL THEN 255 ELSE "cross" END::DOUBLE AS cleaned FROM l""")
def mask_cleaning(spark, sf):
    """Masks with codes where values aren't finite."""
    rows = fixtures.layers(spark, sf)
    endless = F.when(F.col("cross").isNull(), F.lit(float("nan"))).otherwise(F.col("cross"))
    return rows.select("row", "col", tables.clean_mask(F.col("shadow")).cast("int").alias("shadow"), tables.clean_mask(endless).alias("cleaned"))


@query(f"""WITH {DB} SELECT (row // 10)::INT AS y, (col // 10)::INT AS x, round(avg(co_db), 6) AS z FROM d GROUP BY row // 10, col // 10""")
def points_roundtrip(spark, sf):
    """Threshold points, written as CSV and read again."""
    from ..sources.folders import scratch

    path = scratch(spark, "points")
    blocks = [F.floor(F.col(c) / 10).cast("int").alias(name) for c, name in (("row", "y"), ("col", "x"))]
    tables.write_points(db(spark, sf).groupBy(*blocks).agg(F.avg("co_db").alias("z")), path)
    return spark.read.schema("x int, y int, z double").csv(path).select("y", "x", F.round("z", 6).alias("z"))
