"""Raster-like views over star-schema tables, as in FIXTURES.md."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tiles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per cell; sums run over whole cents, so that no order of adding shows. Columns: row, col, co, cross, landcover, glad, refwater, hand, dem, shadow."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.sum(cents) / 1e9).alias("cross"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    first = F.substring("o_orderpriority", 1, 1)
    cover = F.create_map(*[F.lit(x) for pair in zip("12345", (10, 30, 60, 80, 90)) for x in pair])
    return orders.select(
        F.expr("cast(o_orderkey div 100 as int)").alias("row"),
        F.expr("cast(o_orderkey % 100 as int)").alias("col"),
        (F.col("o_totalprice") / 1e6).alias("co"),
        "cross",
        cover[first].alias("landcover"),
        F.expr("cast(if(o_custkey % 13 = 0, 255, (o_orderkey * 37) % 255) as int)").alias("glad"),
        F.expr("cast(if(o_custkey % 17 = 0, 255, o_custkey % 101) as double)").alias("refwater"),
        (F.greatest(F.col("c_acctbal"), F.lit(0.0)) / 40).alias("hand"),
        F.expr("cast(100 + o_custkey % 50 as double)").alias("dem"),
        (F.col("o_orderstatus") == "P").cast("int").alias("shadow"),
    )


#: Layers that are stored together.
TILED = {"radar": ["co", "cross"], "cover": ["landcover", "refwater"], "terrain": ["hand", "dem"]}
_TILED: dict[tuple[str, str], dict[str, DataFrame]] = {}


def tiled(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The layers as three bucketed tables of tiles, which a session writes once for each folder."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _TILED:
        name = f"fx_{uuid.uuid4().hex}"
        whole = tiles.write_tiles(tiles.to_tiles(layers(spark, sf_dir), [c for own in TILED.values() for c in own]), name)
        _TILED[at] = {k: tiles.write_tiles(whole.select(*tiles.PLACE, *tiles.BOX, "here", *own), f"{name}_{k}") for k, own in TILED.items()}
    return _TILED[at]


LAYERS_SQL = """fx_lines AS (SELECT l_orderkey, sum(round(l_extendedprice * 100)::BIGINT)::DOUBLE / 1e9 AS "cross" FROM lineitem GROUP BY l_orderkey),
l AS (SELECT (o_orderkey // 100)::INT AS row, (o_orderkey % 100)::INT AS col, o_totalprice / 1e6 AS co, "cross",
  (CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 10 WHEN '2' THEN 30 WHEN '3' THEN 60 WHEN '4' THEN 80 WHEN '5' THEN 90 END)::INT AS landcover,
  (CASE WHEN o_custkey % 13 = 0 THEN 255 ELSE (o_orderkey * 37) % 255 END)::INT AS glad,
  (CASE WHEN o_custkey % 17 = 0 THEN 255 ELSE o_custkey % 101 END)::DOUBLE AS refwater,
  greatest(c_acctbal, 0) / 40 AS hand, (100 + o_custkey % 50)::DOUBLE AS dem, (o_orderstatus = 'P')::INT AS shadow
  FROM orders LEFT JOIN fx_lines ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey)"""


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping observations: scene, row, col, value (whole cents), looks."""
    lines = table(spark, sf_dir, "lineitem")
    keys = [F.col("l_linenumber").alias("scene"), F.expr("cast(l_orderkey div 100 as int)").alias("row"), F.expr("cast(l_orderkey % 100 as int)").alias("col")]
    return lines.groupBy(*keys).agg(F.round(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")) / F.count("*")).alias("value"), F.sum("l_quantity").alias("looks"))


SCENES_SQL = """s AS (SELECT l_linenumber AS scene, (l_orderkey // 100)::INT AS row, (l_orderkey % 100)::INT AS col,
  round(sum(round(l_extendedprice * 100)::BIGINT)::DOUBLE / count(*)) AS value, sum(l_quantity) AS looks FROM lineitem GROUP BY ALL)"""


def patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small images: scene, row, col, value, mask."""
    rows = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("scene"), F.posexplode("embedding").alias("pos", "value"))
    value = F.col("value").cast("double")
    return rows.select("scene", F.expr("cast(pos div 8 as int)").alias("row"), F.expr("cast(pos % 8 as int)").alias("col"), value.alias("value"), (value > 0.1).alias("mask"))


PATCH_SQL = """fx_pos AS (SELECT vec_id AS scene, unnest(embedding)::DOUBLE AS value, unnest(range(len(embedding))) AS pos FROM embeddings),
p AS (SELECT scene, (pos // 8)::INT AS row, (pos % 8)::INT AS col, value, value > 0.1 AS mask FROM fx_pos)"""


def granules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per scene with its metadata."""
    times = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.min("l_shipdate").alias("t_start"), F.max("l_shipdate").alias("t_end"))
    rows = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left").join(times, F.col("s_suppkey") == F.col("l_suppkey"), "left")
    pols = "if(s_suppkey % 2 = 0, array('HH', 'HV'), array('VV', 'VH'))"
    return rows.select(
        F.format_string("S%06d", "s_suppkey").alias("granule"),
        F.col("s_suppkey").cast("long").alias("key"),
        F.col("s_nationkey").cast("int").alias("track"),
        F.col("n_name").alias("burst_id"),
        "t_start",
        "t_end",
        (F.col("s_acctbal") < 0).alias("rfi_available"),
        F.expr("map('VV', abs(s_acctbal) / 10000, 'VH', (s_suppkey % 10) / 20)").alias("rfi_likelihood"),
        F.expr(f"filter(array(named_struct('freq', 'A', 'spacing', if(s_suppkey % 2 = 0, 10.0D, 20.0D), 'bandwidth', cast(20 + s_suppkey % 3 * 20 as double), 'pols', {pols}),"
               f" if(s_suppkey % 3 = 0, named_struct('freq', 'B', 'spacing', 80.0D, 'bandwidth', 5.0D, 'pols', {pols}), null)), f -> f is not null)").alias("freqs"),
        F.expr("cast(32610 + s_nationkey % 3 as int)").alias("epsg"),
        F.expr("cast(500000 + 10000 * (s_suppkey % 10) as double)").alias("x0"),
        F.expr("cast(4000000 + 10000 * (s_suppkey div 10 % 10) as double)").alias("y0"),
        F.lit(15000.0).alias("side"),
    )


GRANULES_SQL = """fx_times AS (SELECT l_suppkey, min(l_shipdate) AS t_start, max(l_shipdate) AS t_end FROM lineitem GROUP BY l_suppkey),
g AS (SELECT printf('S%06d', s_suppkey) AS granule, s_suppkey::BIGINT AS key, s_nationkey::INT AS track, n_name AS burst_id, t_start, t_end, s_acctbal < 0 AS rfi_available,
  abs(s_acctbal) / 10000 AS rfi_vv, (s_suppkey % 10) / 20.0::DOUBLE AS rfi_vh, (CASE WHEN s_suppkey % 2 = 0 THEN 10.0 ELSE 20.0 END)::DOUBLE AS spacing_a,
  (20 + s_suppkey % 3 * 20)::DOUBLE AS bandwidth_a, s_suppkey % 3 = 0 AS has_b, CASE WHEN s_suppkey % 2 = 0 THEN ['HH', 'HV'] ELSE ['VV', 'VH'] END AS pols,
  (32610 + s_nationkey % 3)::INT AS epsg, (500000 + 10000 * (s_suppkey % 10))::DOUBLE AS x0, (4000000 + 10000 * (s_suppkey // 10 % 10))::DOUBLE AS y0, 15000.0::DOUBLE AS side
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN fx_times ON s_suppkey = l_suppkey)"""


def map_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map tiles: a box of 25 km per nation."""
    x = F.expr("cast(500000 + 20000 * (n_nationkey % 5) as double)")
    y = F.expr("cast(4000000 + 20000 * (n_nationkey div 5) as double)")
    rows = table(spark, sf_dir, "nation")
    return rows.select(F.col("n_name").alias("mgrs_tile"), x.alias("xmin"), (x + 25000).alias("xmax"), y.alias("ymin"), (y + 25000).alias("ymax"), F.expr("cast(32610 + n_nationkey % 3 as int)").alias("epsg"))


TILES_SQL = """t AS (SELECT n_name AS mgrs_tile, (500000 + 20000 * (n_nationkey % 5))::DOUBLE AS xmin, (525000 + 20000 * (n_nationkey % 5))::DOUBLE AS xmax,
  (4000000 + 20000 * (n_nationkey // 5))::DOUBLE AS ymin, (4025000 + 20000 * (n_nationkey // 5))::DOUBLE AS ymax, (32610 + n_nationkey % 3)::INT AS epsg FROM nation)"""


def tile_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile sets: a region with its nations as tiles and bursts."""
    rows = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    names = F.array_sort(F.collect_list("n_name"))
    return rows.groupBy(F.col("r_name").alias("mgrs_set_id")).agg(names.alias("mgrs_tiles"), names.alias("bursts"), F.min("n_nationkey").cast("int").alias("track"), F.count("*").cast("int").alias("n_expected"))


TILE_SETS_SQL = """ts AS (SELECT r_name AS mgrs_set_id, list_sort(list(n_name)) AS mgrs_tiles, list_sort(list(n_name)) AS bursts, min(n_nationkey)::INT AS track, count(*)::INT AS n_expected
  FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)"""
