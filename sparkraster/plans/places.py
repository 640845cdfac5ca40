"""Queries over scene metadata and places: spatial joins, projection, names, frequencies."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import compare, meta, spatial
from ..sources import fixtures
from ..sources.fixtures import GRANULES_SQL, LAYERS_SQL, TILE_SETS_SQL, TILES_SQL

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _boxes(spark, sf):
    box = [F.col("x0").alias("axmin"), (F.col("x0") + F.col("side")).alias("axmax"), F.col("y0").alias("aymin"), (F.col("y0") + F.col("side")).alias("aymax")]
    return fixtures.granules(spark, sf).select("granule", "epsg", *box)


PAIRS = f"""{GRANULES_SQL}, {TILES_SQL}, pr AS (SELECT granule, g.epsg AS ge, mgrs_tile, t.epsg AS te, (least(x0 + side, xmax) - greatest(x0, xmin)) * (least(y0 + side, ymax) - greatest(y0, ymin)) AS area
  FROM g JOIN t ON x0 <= xmax AND x0 + side >= xmin AND y0 <= ymax AND y0 + side >= ymin)"""


@query(f"WITH {PAIRS} SELECT granule, mgrs_tile, area FROM pr")
def footprint_join(spark, sf):
    tiles = fixtures.map_tiles(spark, sf).drop("epsg")
    pairs = spatial.box_join(_boxes(spark, sf), tiles)
    touch = spatial.rings_touch(spatial.ring_of_box("axmin", "axmax", "aymin", "aymax"), spatial.ring_of_box("xmin", "xmax", "ymin", "ymax"))
    return pairs.where(touch).select("granule", "mgrs_tile", "area")


#: Footprints turn by angles whose sine and cosine are exact enough to be the same everywhere.
TURNS = ((1.0, 0.0), (0.8, 0.6), (0.6, 0.8), (0.96, 0.28))


def _footprints(spark, sf):
    """Scenes with their turned squares, counter-clockwise."""
    cos, sin = (F.element_at(F.array(*[F.lit(t[i]) for t in TURNS]), (F.col("key") % len(TURNS) + 1).cast("int")) for i in (0, 1))
    half = F.col("side") / 2
    corner = lambda x, y: F.struct((F.col("x0") + half + half * (x * cos - y * sin)).alias("x"), (F.col("y0") + half + half * (x * sin + y * cos)).alias("y"))
    return fixtures.granules(spark, sf).select("granule", "epsg", F.array(corner(-1, -1), corner(1, -1), corner(1, 1), corner(-1, 1)).alias("footprint"))


def _clip_sql(source: str, name: str, side: str) -> str:
    """One cut of ``ring`` in DuckDB; ``side`` says how far inside a corner {{p}} is."""
    a, b = side.format(p="ring[i]"), side.format(p="ring[i % len(ring) + 1]")
    cut = "{'x': ring[i].x + A / (A - B) * (ring[i % len(ring) + 1].x - ring[i].x), 'y': ring[i].y + A / (A - B) * (ring[i % len(ring) + 1].y - ring[i].y)}".replace("A", f"({a})").replace("B", f"({b})")
    return f"""{name} AS (SELECT * REPLACE (flatten(list_transform(range(1, len(ring) + 1), lambda i: list_concat(CASE WHEN {a} >= 0 THEN [ring[i]] ELSE [] END, CASE WHEN ({a} >= 0) <> ({b} >= 0) THEN [{cut}] ELSE [] END))) AS ring) FROM {source})"""


def _corner_sql(x: int, y: int) -> str:
    return f"{{'x': x0 + side / 2 + side / 2 * ({x} * co - {y} * si) - xmin, 'y': y0 + side / 2 + side / 2 * ({x} * si + {y} * co) - ymin}}"


TURNED = f"""{GRANULES_SQL}, {TILES_SQL}, tg AS (SELECT *, list_extract({[t[0] for t in TURNS]}, key % {len(TURNS)} + 1)::DOUBLE AS co, list_extract({[t[1] for t in TURNS]}, key % {len(TURNS)} + 1)::DOUBLE AS si FROM g),
c0 AS (SELECT granule, tg.epsg AS ge, mgrs_tile, t.epsg AS te, xmax - xmin AS wide, ymax - ymin AS high, [{_corner_sql(-1, -1)}, {_corner_sql(1, -1)}, {_corner_sql(1, 1)}, {_corner_sql(-1, 1)}] AS ring FROM tg, t),
{_clip_sql("c0", "c1", "({p}.y)")}, {_clip_sql("c1", "c2", "(wide - {p}.x)")}, {_clip_sql("c2", "c3", "(high - {p}.y)")}, {_clip_sql("c3", "c4", "({p}.x)")},
pt AS (SELECT granule, ge, mgrs_tile, te, round(coalesce(list_sum(list_transform(range(1, len(ring) + 1), lambda i: ring[i].x * ring[i % len(ring) + 1].y - ring[i % len(ring) + 1].x * ring[i].y)), 0) / 2, 2) AS area FROM c4)"""


def _turned_pairs(spark, sf, on=None):
    tiles = fixtures.map_tiles(spark, sf).withColumn("ring", spatial.ring_of_box("xmin", "xmax", "ymin", "ymax")).drop("xmin", "xmax", "ymin", "ymax")
    pairs = spatial.ring_join(_footprints(spark, sf), tiles if on else tiles.drop("epsg"), "footprint", "ring", on)
    return pairs.withColumn("area", F.round("area", 2)).where("area > 0")


@query(f"WITH {TURNED} SELECT granule, mgrs_tile, area FROM pt WHERE area > 0 QUALIFY row_number() OVER (PARTITION BY granule ORDER BY area DESC, mgrs_tile) = 1")
def largest_overlap(spark, sf):
    """By the area of turned footprints, not of their boxes."""
    return spatial.largest(_turned_pairs(spark, sf), ["granule"], "mgrs_tile").select("granule", "mgrs_tile", "area")


@query(f"WITH {TURNED} SELECT granule, mgrs_tile, area FROM pt WHERE area > 0 AND ge = te QUALIFY row_number() OVER (PARTITION BY granule ORDER BY area DESC, mgrs_tile) = 1")
def largest_overlap_keyed(spark, sf):
    return spatial.largest(_turned_pairs(spark, sf, ["epsg"]), ["granule"], "mgrs_tile").select("granule", "mgrs_tile", "area")


@query(f"""WITH {GRANULES_SQL}, {TILE_SETS_SQL}, k AS (SELECT key % 7 AS pass, list(DISTINCT burst_id) AS bursts FROM g GROUP BY ALL),
c AS (SELECT pass, mgrs_set_id, len(list_intersect(k.bursts, ts.bursts)) AS common FROM k, ts) SELECT pass, mgrs_set_id, common FROM c WHERE common > 0 QUALIFY rank() OVER (PARTITION BY pass ORDER BY common DESC) = 1""")
def member_overlap(spark, sf):
    groups = fixtures.granules(spark, sf).groupBy((F.col("key") % 7).alias("pass")).agg(F.collect_set("burst_id").alias("members"))
    return spatial.most_members(groups, fixtures.tile_sets(spark, sf), "members", "bursts", "pass")


@query(f"WITH {GRANULES_SQL}, {TILE_SETS_SQL} SELECT granule, mgrs_set_id, g.track FROM g JOIN ts ON g.track BETWEEN ts.track - 1 AND ts.track + 1")
def track_band(spark, sf):
    sets = fixtures.tile_sets(spark, sf).select("mgrs_set_id", F.explode(F.sequence(F.col("track") - 1, F.col("track") + 1)).alias("track"))
    return fixtures.granules(spark, sf).select("granule", "track").join(sets, "track")


LON = "CASE WHEN key % 4 = 0 THEN 179 - key % 25 * 0.1 ELSE key % 25 * 5 - 60 END"
RIGHT = "CASE WHEN key % 4 = 0 THEN -179 + key % 25 * 0.1 ELSE key % 25 * 5 - 58 END"


@query(f"""WITH {GRANULES_SQL}, b AS (SELECT granule, ({LON})::DOUBLE AS l, ({RIGHT})::DOUBLE AS r FROM g)
SELECT granule, l AS left_lon, CASE WHEN l > 0 AND r < 0 THEN 180 ELSE r END::DOUBLE AS right_lon FROM b UNION ALL SELECT granule, -180::DOUBLE, r FROM b WHERE l > 0 AND r < 0""")
def antimeridian_boxes(spark, sf):
    rows = fixtures.granules(spark, sf)
    return spatial.split_boxes(rows.select("granule", F.expr(f"cast({LON} as double)").alias("left_lon"), F.expr(f"cast({RIGHT} as double)").alias("right_lon")))


@query(f"""WITH {GRANULES_SQL}, b AS (SELECT granule, ({LON})::DOUBLE AS l, ({RIGHT})::DOUBLE AS r, (key % 100 - 50)::DOUBLE AS s FROM g)
SELECT granule, CASE WHEN greatest(l, r) - least(l, r) > 340 THEN least(CASE WHEN l < 0 THEN l + 360 ELSE l END, CASE WHEN r < 0 THEN r + 360 ELSE r END) ELSE least(l, r) END AS west,
  CASE WHEN greatest(l, r) - least(l, r) > 340 THEN greatest(CASE WHEN l < 0 THEN l + 360 ELSE l END, CASE WHEN r < 0 THEN r + 360 ELSE r END) ELSE greatest(l, r) END AS east, s AS south, s + 2 AS north FROM b""")
def corner_bbox(spark, sf):
    rows = fixtures.granules(spark, sf).select("granule", F.expr(f"cast({LON} as double)").alias("l"), F.expr(f"cast({RIGHT} as double)").alias("r"), (F.col("key") % 100 - 50).cast("double").alias("s"))
    box = spatial.wrapped_box(F.array("l", "r", "l", "r"), F.array(F.col("s"), F.col("s"), F.col("s") + 2, F.col("s") + 2))
    return rows.select("granule", box.alias("b")).select("granule", "b.*")


@query(f"""WITH {LAYERS_SQL}, {TILES_SQL}, c AS (SELECT row, col, 500000 + (col + 0.5) * 900 AS x, 4000000 + (row + 0.5) * 900 AS y FROM l),
e AS (SELECT mgrs_tile, xmin, ymin, xmax, ymax, unnest([[xmin, ymin, xmax, ymin], [xmax, ymin, xmin, ymax], [xmin, ymax, xmin, ymin]]) AS e FROM t),
k AS (SELECT row, col, mgrs_tile, count(*) FILTER ((e[2] > y) <> (e[4] > y) AND x < (e[3] - e[1]) * (y - e[2]) / (e[4] - e[2]) + e[1]) AS n FROM c JOIN e ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax GROUP BY ALL)
SELECT mgrs_tile, row, col FROM k WHERE n % 2 = 1""")
def polygon_cells(spark, sf):
    cells = fixtures.layers(spark, sf).select("row", "col", (500000 + (F.col("col") + 0.5) * 900).alias("x"), (4000000 + (F.col("row") + 0.5) * 900).alias("y"))
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    rings = fixtures.map_tiles(spark, sf).withColumn("ring", F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmin", "ymax")))
    points = cells.withColumns({"_x": F.floor(F.col("x") / spatial.STEP), "_y": F.floor(F.col("y") / spatial.STEP)})
    pairs = points.join(spatial.lattice(rings, ("xmin", "xmax", "ymin", "ymax")), ["_x", "_y"]).where("x between xmin and xmax and y between ymin and ymax")
    return pairs.where(spatial.inside_ring(F.col("x"), F.col("y"), F.col("ring"))).select("mgrs_tile", "row", "col")


def _krueger() -> str:
    e = repr(geo.ECC)
    x = " + ".join(["eta"] + [f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)])
    y = " + ".join(["xi"] + [f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(geo.ALPHA, 1)])
    k = repr(geo.SCALE * geo.RADIUS)
    return f"""ll AS (SELECT granule, zone, (zone * 6 - 183) + (x0 - 540000) / 40000 AS lon, (y0 - 3000000) / 40000 AS lat FROM (SELECT *, epsg - 32600 AS zone FROM g)),
k1 AS (SELECT *, radians(lon - (zone * 6 - 183)) AS lam, sin(radians(lat)) AS si FROM ll), k2 AS (SELECT *, sinh(atanh(si) - {e} * atanh({e} * si)) AS t FROM k1),
k3 AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM k2),
utm AS (SELECT granule, zone, lon, lat, 500000 + {k} * ({x}) AS x, {k} * ({y}) AS y FROM k3)"""


UTM = f"{GRANULES_SQL}, {_krueger()}"


def _utm(spark, sf):
    rows = fixtures.granules(spark, sf).withColumn("zone", F.col("epsg") - 32600)
    rows = rows.withColumns({"lon": (F.col("zone") * 6 - 183) + (F.col("x0") - 540000) / 40000, "lat": (F.col("y0") - 3000000) / 40000})
    return rows.withColumn("p", geo.to_utm(F.col("lon"), F.col("lat"), F.col("zone")))


@query(f"WITH {UTM} SELECT granule, round(x, 4) AS x, round(y, 4) AS y, round(lon, 6) AS lon_back, round(lat, 6) AS lat_back FROM utm")
def utm_project(spark, sf):
    rows = _utm(spark, sf).withColumn("b", geo.from_utm(F.col("p.x"), F.col("p.y"), F.col("zone")))
    return rows.select("granule", F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"), F.round("b.lon", 6).alias("lon_back"), F.round("b.lat", 6).alias("lat_back"))


@query(f"WITH {UTM} SELECT granule, round(x / 30) * 30 AS x, round(y / 30) * 30 AS y, ceil((round(x / 30) * 30 + 1234 - round(x / 30) * 30) / 60) * 60 + round(x / 30) * 30 AS x_end FROM utm")
def snap_corners(spark, sf):
    rows = _utm(spark, sf).select("granule", geo.snapped(F.col("p.x"), 30.0).alias("x"), geo.snapped(F.col("p.y"), 30.0).alias("y"))
    return rows.withColumn("x_end", geo.snapped_out(F.col("x"), F.col("x") + 1234, 60.0)["high"])


@query(f"WITH {GRANULES_SQL} SELECT granule, (spacing_a <> 20 OR epsg <> 32611 OR abs((x0 - 500010) / 20 - round((x0 - 500010) / 20)) > 1e-6)::INT AS needed FROM g")
def needs_reprojection(spark, sf):
    rows = fixtures.granules(spark, sf)
    return rows.select("granule", geo.needs_reprojection(F.col("freqs")[0]["spacing"], F.col("epsg"), F.col("x0"), 20.0, 32611, 500010.0).cast("int").alias("needed"))


@query(f"""WITH {UTM} SELECT DISTINCT lpad(zone::VARCHAR, 2, '0') || substr('CDEFGHJKLMNPQRSTUVWX', least(20, floor((lat + 80) / 8)::INT + 1), 1)
  || substr(CASE (zone - 1) % 3 WHEN 0 THEN 'ABCDEFGH' WHEN 1 THEN 'JKLMNPQR' ELSE 'STUVWXYZ' END, floor(x / 100000)::INT, 1)
  || substr('ABCDEFGHJKLMNPQRSTUV', ((floor(y / 100000)::INT + CASE WHEN zone % 2 = 0 THEN 5 ELSE 0 END) % 20 + 1)::INT, 1) AS code FROM utm""")
def tile_code(spark, sf):
    return _utm(spark, sf).select(geo.square_code(F.col("zone"), F.col("lat"), F.col("p.x"), F.col("p.y")).alias("code")).distinct()


@query(f"WITH {TILES_SQL} SELECT mgrs_tile, xmin, xmin + 109800 AS xmax, ymin - 9800 AS ymin, ymin + 100000 AS ymax FROM t")
def tile_box(spark, sf):
    return fixtures.map_tiles(spark, sf).select("mgrs_tile", geo.square_box(F.col("xmin"), F.col("ymin")).alias("b")).select("mgrs_tile", "b.*")


@query()
def hull(spark, sf):
    return spatial.hull(fixtures.patch(spark, sf).where("mask"), "scene")


@query(f"""WITH {GRANULES_SQL}, {TILE_SETS_SQL}, f AS (SELECT mgrs_set_id, n_expected, unnest(bursts) AS b FROM ts), h AS (SELECT DISTINCT burst_id FROM g WHERE key % 3 = 0)
SELECT mgrs_set_id, (n_expected - count(h.burst_id))::INT AS missing, coalesce(string_agg(b, ',' ORDER BY b) FILTER (h.burst_id IS NULL), '') AS names FROM f LEFT JOIN h ON h.burst_id = b GROUP BY mgrs_set_id, n_expected""")
def missing_members(spark, sf):
    sets = fixtures.tile_sets(spark, sf).select("mgrs_set_id", F.explode("bursts").alias("burst_id"))
    found = fixtures.granules(spark, sf).where("key % 3 = 0").select("burst_id").distinct().withColumn("here", F.lit(1))
    rows = sets.join(found, "burst_id", "left").groupBy("mgrs_set_id")
    names = F.concat_ws(",", F.array_sort(F.collect_list(F.when(F.col("here").isNull(), F.col("burst_id")))))
    return rows.agg((F.count("*") - F.count("here")).cast("int").alias("missing"), names.alias("names"))


@query(f"WITH {GRANULES_SQL} SELECT granule, array_to_string(list_filter(['VV', 'VH', 'HH'], lambda x: list_contains(pols, x)), ',') AS found FROM g")
def available_bands(spark, sf):
    both = F.array_intersect(F.array(F.lit("VV"), F.lit("VH"), F.lit("HH")), F.col("freqs")[0]["pols"])
    return fixtures.granules(spark, sf).select("granule", F.concat_ws(",", meta.polarisation_order(both)).alias("found"))


@query(f"WITH {GRANULES_SQL} SELECT granule, CASE WHEN key % 2 = 0 THEN 'DH_POL' ELSE 'DV_POL' END AS mode, 2 AS bands FROM g")
def band_mode(spark, sf):
    pols = F.col("freqs")[0]["pols"]
    return fixtures.granules(spark, sf).select("granule", meta.mode(pols).alias("mode"), F.size(pols).alias("bands"))


@query(f"WITH {GRANULES_SQL} SELECT strftime(min(t_start), '%Y%m%dT%H%M%SZ') AS first, strftime(max(t_end), '%Y%m%dT%H%M%SZ') AS last FROM g")
def time_range(spark, sf):
    return meta.time_range(fixtures.granules(spark, sf))


@query(f"WITH {GRANULES_SQL} SELECT string_agg(DISTINCT burst_id, ', ' ORDER BY burst_id) AS burst_id FROM g")
def distinct_join(spark, sf):
    return meta.joined(fixtures.granules(spark, sf), "burst_id")


@query(f"WITH {GRANULES_SQL} SELECT bool_or(rfi_available)::INT AS anyone, count(*) FILTER (rfi_available) AS n FROM g")
def flag_counts(spark, sf):
    return fixtures.granules(spark, sf).agg(F.bool_or("rfi_available").cast("int").alias("anyone"), F.count_if("rfi_available").alias("n"))


@query(f"WITH {GRANULES_SQL} SELECT burst_id, count(*) FILTER (rfi_vv > 0.1 OR rfi_vh > 0.1) AS frames FROM g GROUP BY burst_id")
def rfi_frames(spark, sf):
    return fixtures.granules(spark, sf).groupBy("burst_id").agg(F.count_if(meta.interfered(F.col("rfi_likelihood"))).alias("frames"))


@query(f"""WITH {GRANULES_SQL}, f AS (SELECT 'A' AS freq, granule, spacing_a AS spacing, pols FROM g UNION ALL SELECT 'B', granule, 80, pols FROM g WHERE has_b)
SELECT freq, count(DISTINCT granule) AS having, (count(DISTINCT spacing) = 1)::INT AS one_spacing, (count(DISTINCT pols) = 1)::INT AS one_pols, (count(DISTINCT granule) = (SELECT count(*) FROM g))::INT AS everywhere FROM f GROUP BY freq""")
def uniformity(spark, sf):
    return meta.uniformity(fixtures.granules(spark, sf))


@query(f"WITH {GRANULES_SQL} SELECT burst_id, min(spacing_a) AS spacing FROM g GROUP BY burst_id")
def finest_spacing(spark, sf):
    rows = fixtures.granules(spark, sf).select("burst_id", F.explode("freqs").alias("f"))
    return rows.groupBy("burst_id").agg(F.min("f.spacing").alias("spacing"))


@query(f"WITH {GRANULES_SQL} SELECT granule, 1 AS kept, CASE WHEN has_b THEN 1 ELSE 0 END AS dropped FROM g")
def posting_filter(spark, sf):
    kept = F.size(meta.within_posting(F.col("freqs"), 40.0))
    return fixtures.granules(spark, sf).select("granule", kept.alias("kept"), (F.size("freqs") - kept).alias("dropped"))


@query(f"WITH {GRANULES_SQL} SELECT granule, bandwidth_a AS \"A\", CASE WHEN has_b THEN 5.0::DOUBLE END AS \"B\" FROM g")
def bandwidth(spark, sf):
    rows = fixtures.granules(spark, sf).select("granule", F.explode("freqs").alias("f"))
    return rows.groupBy("granule").pivot("f.freq", ["A", "B"]).agg(F.max("f.bandwidth"))


@query(f"WITH {GRANULES_SQL}, f AS (SELECT granule, len(pols) + CASE WHEN has_b THEN 2 ELSE 0 END AS n FROM g) SELECT n::INT AS files, count(*) AS inputs, (SELECT count(DISTINCT n) = 1 FROM f)::INT AS equal FROM f GROUP BY n")
def files_per_input(spark, sf):
    rows = fixtures.granules(spark, sf).select("granule", F.explode("freqs").alias("f")).select("granule", F.explode("f.pols").alias("p"))
    counts = rows.groupBy("granule").agg(F.count("*").cast("int").alias("files"))
    return counts.groupBy("files").agg(F.count("*").alias("inputs")).withColumn("equal", (F.count("*").over(Window.partitionBy()) == 1).cast("int"))


@query(f"""WITH {GRANULES_SQL} SELECT granule, 'WATER_T' || burst_id || '_' || strftime(t_start, '%Y%m%dT%H%M%SZ') || '_S1A_30_v' || printf('%03d', track) AS name,
  pols[1] AS band, 'tile ' || granule AS described, 'S1A' AS platform, 3 AS members, granule AS stem FROM g WHERE t_start IS NOT NULL""")
def product_names(spark, sf):
    rows = fixtures.granules(spark, sf).where("t_start is not null")
    name = F.format_string("WATER_T%s_%s_%s_30_v%03d", "burst_id", meta.compact_time(F.col("t_start")), meta.short_platform(F.lit("Sentinel-1A")), "track")
    band = meta.polarisation(F.concat(F.lit("/in/scene_"), F.col("freqs")[0]["pols"][0], F.lit(".tif")))
    text = meta.described(F.lit(""), F.concat(F.lit("/data/tile "), F.col("granule")), "layer")
    stem = F.split(F.regexp_extract(F.concat(F.lit("/in/"), F.col("granule"), F.lit("-co.tif")), "[^/]+$", 0), "-")[0]
    return rows.select("granule", name.alias("name"), band.alias("band"), text.alias("described"), meta.short_platform(F.lit("Sentinel-1A")).alias("platform"), F.size(meta.list_of(F.lit("['a', 'b', 'c']"))).alias("members"), stem.alias("stem"))


@query(f"""WITH {GRANULES_SQL} SELECT granule AS product, unnest(['TRACK', 'ZONE', 'RFI', 'METHOD']) AS key, unnest([track::VARCHAR, epsg::VARCHAR, rfi_available::VARCHAR, CASE track % 2 WHEN 0 THEN 'Kittler-Illingworth' ELSE 'Otsu' END]) AS value FROM g""")
def tags_flat(spark, sf):
    method = F.create_map(F.lit(0), F.lit("Kittler-Illingworth"), F.lit(1), F.lit("Otsu"))[F.col("track") % 2]
    return meta.tags(fixtures.granules(spark, sf), {"TRACK": F.col("track"), "ZONE": F.col("epsg"), "RFI": F.col("rfi_available"), "METHOD": method}, "granule")


#: Parameters of a run by their path: expressions that both engines read.
PARAMETERS = {
    "processing.polarizations": "concat('[', CASE WHEN key % 2 = 0 THEN 'HH, HV' ELSE 'VV, VH' END, ']')", "filter.method": "'lee'", "filter.enabled": "'True'", "filter.window": "cast(3 + key % 3 * 2 as string)",
    "threshold.method": "CASE track % 3 WHEN 0 THEN 'ki' WHEN 1 THEN 'otsu' ELSE 'rg' END", "threshold.selection": "'combined'", "threshold.average": "'True'", "threshold.multi": "'True'", "threshold.bimodality": "'0.7'",
    "threshold.twele": "'[0.09, 0.8, 0.97]'", "threshold.bounds.co": "'[-28, -11]'", "threshold.bounds.cross": "'[-28, -18]'", "growing.initial": "'0.81'", "growing.relaxed": "'0.51'",
    "masking.co": "cast(-14 - key % 2 as string)", "masking.cross": "'-26'", "masking.water": "'0.05'", "fuzzy.hand.min": "'0'", "fuzzy.hand.max": "'15'", "fuzzy.slope.min": "'0.5'", "fuzzy.slope.max": "'15'",
    "fuzzy.reference.min": "'0.8'", "fuzzy.reference.max": "'0.95'", "fuzzy.area.min": "'0'", "fuzzy.area.max": "'40'", "fuzzy.dark.land": "'-18'", "fuzzy.dark.water": "'-24'", "fuzzy.frequent.min": "'0.1'",
    "fuzzy.frequent.max": "'0.9'", "refine.minimum": "cast(4 + 36 * (key % 2) as string)", "refine.ashman": "'1.5'", "refine.bhattacharyya": "'0.97'", "refine.bm": "'0.7'", "refine.surface": "'0.1'", "vegetation.enabled": "'True'",
    "vegetation.ratio.max": "'12'", "vegetation.ratio.min": "'7'", "vegetation.ratio.threshold": "'8'", "vegetation.cross": "'-26'", "vegetation.source": "'auto'", "vegetation.classes": "'[112-124, 200-207]'", "vegetation.filter": "'lee'",
}


def _parameter_sql() -> str:
    names, values = [], []
    for tag, paths in meta.PARAMETER_TAGS.items():
        own = [f"({PARAMETERS[x]})" for x in paths]
        value = own[0] if len(own) == 1 else "concat('[', " + ", ', ', ".join(own) + ", ']')"
        if tag == meta.METHOD_TAG:
            value = f"CASE {value} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in meta.METHODS.items()) + " END"
        names.append(f"'{tag}'")
        values.append(value)
    return f"WITH {GRANULES_SQL} SELECT granule AS product, unnest([{', '.join(names)}]) AS key, unnest([{', '.join(values)}]) AS value FROM g"


@query(_parameter_sql())
def parameter_tags(spark, sf):
    """All parameters of each scene's run as flat tags."""
    values = F.map_from_arrays(F.array(*[F.lit(k) for k in PARAMETERS]), F.array(*[F.expr(v) for v in PARAMETERS.values()]))
    return meta.parameter_tags(fixtures.granules(spark, sf).withColumn("parameters", values), "parameters", "granule")


@query(f"""WITH {GRANULES_SQL}, a AS (SELECT granule AS product, len(pols) AS bands, x0, y0, spacing_a AS step, epsg FROM g),
b AS (SELECT product, bands + (product LIKE '%1')::INT AS bands, x0 + CASE WHEN product LIKE '%2' THEN step / 2 ELSE 0 END AS x0, y0, step, epsg + (product LIKE '%3')::INT AS epsg FROM a WHERE product NOT LIKE '%4'),
j AS (SELECT a.product, unnest(['bands', 'geotransform', 'projection', 'product']) AS what,
  unnest([a.bands::VARCHAR, printf('%.3f %.3f %.3f', a.x0, a.y0, a.step), a.epsg::VARCHAR, 'there']) AS left_value, unnest([b.bands::VARCHAR, printf('%.3f %.3f %.3f', b.x0, b.y0, b.step), b.epsg::VARCHAR, CASE WHEN b.product IS NOT NULL THEN 'there' END]) AS right_value, b.product IS NULL AS lacks
  FROM a LEFT JOIN b USING (product))
SELECT product, what, left_value, right_value FROM j WHERE (lacks AND what = 'product') OR (NOT lacks AND left_value <> right_value)""")
def grid_diff(spark, sf):
    """Band counts, geotransforms and projections of all scenes in two versions."""
    rows = fixtures.granules(spark, sf)
    left = rows.select(F.col("granule").alias("product"), F.size(F.col("freqs")[0]["pols"]).alias("bands"), "x0", "y0", F.col("freqs")[0]["spacing"].alias("step"), "epsg")
    ends = lambda d: F.col("product").endswith(d)
    right = left.where(~ends("4")).withColumns({"bands": F.col("bands") + ends("1").cast("int"), "x0": F.col("x0") + F.when(ends("2"), F.col("step") / 2).otherwise(0), "epsg": F.col("epsg") + ends("3").cast("int")})
    return compare.grid_differences(left, right)


@query(f"WITH {GRANULES_SQL} SELECT granule, x0 - spacing_a / 2 AS corner_x, y0 + side + spacing_a / 2 AS corner_y, row_number() OVER (ORDER BY granule)::INT AS turn, (side / spacing_a)::INT AS width FROM g")
def granule_geo(spark, sf):
    rows = fixtures.granules(spark, sf).withColumn("s", F.col("freqs")[0]["spacing"])
    corner = [(F.col("x0") - F.col("s") / 2).alias("corner_x"), (F.col("y0") + F.col("side") + F.col("s") / 2).alias("corner_y")]
    return meta.numbered(rows.select("granule", *corner, (F.col("side") / F.col("s")).cast("int").alias("width")), "granule", "turn")


@query(f"WITH {TILE_SETS_SQL} SELECT DISTINCT unnest(mgrs_tiles) AS tile FROM ts")
def tile_list(spark, sf):
    return fixtures.tile_sets(spark, sf).select(F.explode("mgrs_tiles").alias("tile")).distinct()




def _near_ring() -> str:
    parts = []
    for x1, y1, x2, y2 in (("xmin", "ymin", "xmax", "ymin"), ("xmax", "ymin", "xmin", "ymax"), ("xmin", "ymax", "xmin", "ymin")):
        dx, dy = f"({x2} - {x1})", f"({y2} - {y1})"
        t = f"greatest(0.0::DOUBLE, least(1.0::DOUBLE, ((x - {x1}) * {dx} + (y - {y1}) * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
        parts.append(f"sqrt(pow(x - {x1} - {t} * {dx}, 2) + pow(y - {y1} - {t} * {dy}, 2))")
    return f"least({', '.join(parts)})"


@query(f"""WITH {LAYERS_SQL}, {TILES_SQL}, c AS (SELECT row, col, 500000 + (col + 0.5) * 900 AS x, 4000000 + (row + 0.5) * 900 AS y FROM l)
SELECT mgrs_tile, row, col, round({_near_ring()}, 6) AS far FROM c JOIN t ON x BETWEEN xmin - 5000 AND xmax + 5000 AND y BETWEEN ymin - 5000 AND ymax + 5000 WHERE {_near_ring()} <= 5000""")
def shoreline_cells(spark, sf):
    """Cells within 5 km of a polygon's edges, on either side."""
    cells = fixtures.layers(spark, sf).select("row", "col", (500000 + (F.col("col") + 0.5) * 900).alias("x"), (4000000 + (F.col("row") + 0.5) * 900).alias("y"))
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    rings = fixtures.map_tiles(spark, sf).withColumn("ring", F.array(corner("xmin", "ymin"), corner("xmax", "ymin"), corner("xmin", "ymax")))
    wide = rings.withColumns({"xmin": F.col("xmin") - 5000, "xmax": F.col("xmax") + 5000, "ymin": F.col("ymin") - 5000, "ymax": F.col("ymax") + 5000})
    points = cells.withColumns({"_x": F.floor(F.col("x") / spatial.STEP), "_y": F.floor(F.col("y") / spatial.STEP)})
    pairs = points.join(spatial.lattice(wide, ("xmin", "xmax", "ymin", "ymax")), ["_x", "_y"]).where("x between xmin and xmax and y between ymin and ymax")
    far = spatial.distance_to_ring(F.col("x"), F.col("y"), F.col("ring"))
    return pairs.withColumn("far", far).where("far <= 5000").select("mgrs_tile", "row", "col", F.round("far", 6).alias("far"))


@query(f"""WITH {GRANULES_SQL}, b AS (SELECT granule, zone, (zone * 6 - 183) + (x0 - 540000) / 40000 AS lon, -((y0 - 3000000) / 40000) AS lat FROM (SELECT *, epsg - 32600 AS zone FROM g)),
{_krueger().split(",", 1)[0].split(" AS ")[0]} AS (SELECT * FROM b), {_krueger()[_krueger().index("k1 AS"):]}
SELECT granule, round(x, 4) AS x, round(10000000 + y, 4) AS y, round(lon, 6) AS lon_back, round(lat, 6) AS lat_back FROM utm""")
def utm_south(spark, sf):
    """Southern zones and back."""
    south = F.lit(True)
    rows = _utm(spark, sf).withColumn("lat", -F.col("lat")).withColumn("p", geo.to_utm(F.col("lon"), F.col("lat"), F.col("zone"), south))
    rows = rows.withColumn("b", geo.from_utm(F.col("p.x"), F.col("p.y"), F.col("zone"), south))
    return rows.select("granule", F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"), F.round("b.lon", 6).alias("lon_back"), F.round("b.lat", 6).alias("lat_back"))


@query(f"""WITH {GRANULES_SQL}, m AS (SELECT granule, unnest(CASE key % 2 WHEN 0 THEN [['PRODUCT_TYPE', 'WATER-S1'], ['SPACECRAFT_NAME', 'Sentinel-1'], ['SENSOR', 'IW']]
  ELSE [['PRODUCT_TYPE', 'WATER-NI'], ['SPACECRAFT_NAME', 'NISAR'], ['SENSOR', 'LSAR']] END || [['SOFTWARE_VERSION', '1.' || track], ['PROCESSING_DATETIME', strftime(t_end, '%Y-%m-%dT%H:%M:%SZ')], ['INPUT', granule]]) AS kv FROM g)
SELECT granule AS product, kv[1] AS key, kv[2] AS value FROM m WHERE kv[2] IS NOT NULL""")
def base_tags(spark, sf):
    """Every product's base tags and its input's name out of the list that names it, written and read again."""
    from ..sources import tables
    from ..sources.folders import scratch

    rows = fixtures.granules(spark, sf)
    sensor = F.when(F.col("key") % 2 == 0, "one").otherwise("two")
    own = meta.base_tags(sensor, F.concat(F.lit("1."), F.col("track")), F.col("t_end"))
    named = F.create_map(F.lit("INPUT"), meta.trimmed(F.concat(F.lit("['"), F.col("granule"), F.lit("']"))))
    path = scratch(spark, "tags")
    tables.write_tags(rows.select(F.col("granule").alias("product"), F.explode(F.map_concat(own, named))).where("value is not null"), path)
    return spark.read.schema("product string, key string, value string").json(path)
