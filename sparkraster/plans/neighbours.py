"""Queries over neighbourhoods: slope, filters, morphology, components, growth."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import maths
from ..operators import components, focal, morph, tiled
from ..sources import fixtures, tiles
from ..sources.fixtures import LAYERS_SQL, PATCH_SQL
from .cells import COMBINED, DB, combined, db

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _r(column: str, digits: int):
    return F.round(column, digits).alias(column)


@query(f"""WITH {LAYERS_SQL}, a AS (SELECT row, col, dem, coalesce(lead(dem) OVER x, lag(dem) OVER x) AS e, coalesce(lag(dem) OVER x, lead(dem) OVER x) AS w FROM l WINDOW x AS (PARTITION BY row ORDER BY col)),
b AS (SELECT row, col, e - w AS dx, e + 2 * dem + w AS sx FROM a),
c AS (SELECT row, col, (coalesce(lead(dx) OVER y, lag(dx) OVER y) + 2 * dx + coalesce(lag(dx) OVER y, lead(dx) OVER y)) / 3 / 30 AS gx, (coalesce(lead(sx) OVER y, lag(sx) OVER y) - coalesce(lag(sx) OVER y, lead(sx) OVER y)) / 3 / 30 AS gy FROM b WINDOW y AS (PARTITION BY col ORDER BY row))
SELECT row, col, round(degrees(atan(sqrt(gx * gx + gy * gy))), 6) AS slope FROM c""")
def slope(spark, sf):
    """From stored tiles."""
    return tiles.to_cells(tiled.slope(fixtures.tiled(spark, sf)["terrain"], "dem"), ["slope"]).select("row", "col", _r("slope", 6))


BOX = f"""{LAYERS_SQL}, o AS (SELECT i, j FROM range(-1, 2) a(i), range(-1, 2) b(j)),
x AS (SELECT l.row, l.col, sum(coalesce(n."cross", 0)) AS s1, sum(coalesce(n."cross", 0) * coalesce(n."cross", 0)) AS s2, count(n."cross") AS known FROM l, o JOIN l n ON n.row = l.row + i AND n.col = l.col + j GROUP BY ALL),
st AS (SELECT row, col, CASE WHEN 1 - known / 9.0 <= 0.2 THEN s1 / 9 END AS mean, CASE WHEN 1 - known / 9.0 <= 0.2 THEN greatest(s2 / 9 - (s1 / 9) * (s1 / 9), 0) END AS variance FROM x)"""


@query(f"""WITH {BOX} SELECT row, col, round(mean, 9) AS mean, round(variance, 10) AS variance FROM st""")
def box_stats(spark, sf):
    return focal.box_stats(fixtures.layers(spark, sf), "cross", 3).select("row", "col", _r("mean", 9), _r("variance", 10))


@query(f"""WITH {BOX}, c AS (SELECT row, col, "cross" AS v, mean, sqrt(variance) / mean AS ci FROM l JOIN st USING (row, col)),
w AS (SELECT *, CASE WHEN ci IS NULL THEN NULL WHEN ci <= 0.523 THEN 1 WHEN ci >= 1.73 THEN 0 ELSE exp(-(ci - 0.523) / (1.73 - ci)) END AS weight FROM c)
SELECT row, col, round(CASE WHEN v IS NULL THEN NULL ELSE coalesce(mean * weight + v * (1 - weight), v) END, 10) AS filtered FROM w""")
def lee_filter(spark, sf):
    """From stored tiles."""
    return tiles.to_cells(tiled.lee(fixtures.tiled(spark, sf)["radar"], "cross", 3), ["filtered"]).select("row", "col", _r("filtered", 10))


@query(f"""WITH {DB}, o AS (SELECT i, j FROM range(-1, 2) a(i), range(-1, 2) b(j)), q AS (SELECT row, col, coalesce(co_db, 0) AS i0, coalesce(co, 0) AS p0, co FROM d),
x AS (SELECT q.row, q.col, count(*) AS k, sum(n.i0) AS si, sum(n.p0) AS sp, sum(n.i0 * n.p0) AS sip, sum(n.i0 * n.i0) AS sii FROM q, o JOIN q n ON n.row = q.row + o.i AND n.col = q.col + o.j GROUP BY ALL),
y AS (SELECT row, col, (sip / k - si / k * (sp / k)) / (sii / k - si / k * (si / k) + 3) AS a, sp / k AS mp, si / k AS mi FROM x), z AS (SELECT row, col, a, mp - a * mi AS b FROM y),
s AS (SELECT z.row, z.col, count(*) AS k, sum(n.a) AS sa, sum(n.b) AS sb FROM z, o JOIN z n ON n.row = z.row + o.i AND n.col = z.col + o.j GROUP BY ALL)
SELECT row, col, round(CASE WHEN co IS NOT NULL THEN sa / k * i0 + sb / k END, 8) AS filtered FROM s JOIN q USING (row, col)""")
def guided_filter(spark, sf):
    return focal.guided(db(spark, sf), "co", "co_db").select("row", "col", _r("filtered", 8))


@query()
def tv_filter(spark, sf):
    """Both total-variation filters, over tiles with a halo."""
    rows = db(spark, sf)
    one = focal.halo_apply(rows, focal.total_variation(1.0), "co_db", 256, 150, -30.0).select("row", "col", F.col("filtered").alias("projected"))
    two = focal.halo_apply(rows, focal.split_bregman(20.0), "co_db", 256, 150, -30.0).select("row", "col", F.col("filtered").alias("bregman"))
    return one.join(two, ["row", "col"])


@query()
def filter_stage(spark, sf):
    """The filter stage: missing cells filled, each band filtered, restored, then the ratio and span."""
    rows = db(spark, sf)
    out = rows.select("row", "col")
    for band in ("co", "cross"):
        filled = rows.withColumn("_f", F.coalesce(maths.to_db(band), F.lit(-30.0)))
        part = focal.halo_apply(filled, focal.total_variation(1.0), "_f", 256, 150, -30.0).select("row", "col", maths.to_power("filtered").alias(f"{band}_filtered"))
        out = out.join(part, ["row", "col"])
    out = out.join(rows.select("row", "col", "cross"), ["row", "col"]).withColumn("cross_filtered", F.when(F.col("cross").isNotNull(), F.col("cross_filtered"))).drop("cross")
    return out.withColumns({"ratio": maths.pol_ratio("co_filtered", "cross_filtered"), "span": maths.span("co_filtered", "cross_filtered")})


MASK = f"""{LAYERS_SQL}, m AS (SELECT row, col FROM l WHERE CASE WHEN refwater = 255 THEN 100 ELSE refwater END / 100 > 0.8)"""
WIDE = f"""{LAYERS_SQL}, m AS (SELECT row, col FROM l WHERE refwater < 80)"""


def _mask(spark, sf):
    return fixtures.layers(spark, sf).where("if(refwater = 255, 100, refwater) / 100 > 0.8").select("row", "col")


def _wide(spark, sf):
    return fixtures.layers(spark, sf).where("refwater < 80").select("row", "col")


def _ball(n: int) -> str:
    return f"SELECT i, j FROM range(-{n}, {n + 1}) a(i), range(-{n}, {n + 1}) b(j) WHERE abs(i) + abs(j) <= {n}"


def _dilated(n: int, source: str = "m") -> str:
    return f"SELECT DISTINCT (row + i)::INT AS row, (col + j)::INT AS col FROM {source}, ({_ball(n)})"


def _eroded(n: int, source: str = "m") -> str:
    return f"SELECT row, col FROM {source} WHERE (SELECT count(*) FROM ({_ball(n)}) o JOIN {source} x ON x.row = {source}.row + i AND x.col = {source}.col + j) = (SELECT count(*) FROM ({_ball(n)}))"


def _eroded_join(n: int, source: str = "m") -> str:
    size = 2 * n * (n + 1) + 1
    return f"SELECT {source}.row, {source}.col FROM {source}, ({_ball(n)}) o JOIN {source} x ON x.row = {source}.row + o.i AND x.col = {source}.col + o.j GROUP BY ALL HAVING count(*) = {size}"


@query(f"WITH {MASK} {_dilated(3)}")
def dilate(spark, sf):
    return morph.dilate(_mask(spark, sf), 3)


@query(f"WITH {WIDE} {_eroded_join(1)}")
def erode(spark, sf):
    return morph.erode(_wide(spark, sf), 1)


@query(f"WITH {WIDE} SELECT row, col FROM m EXCEPT ({_eroded_join(1)})")
def boundary(spark, sf):
    return morph.boundary(_wide(spark, sf))


@query(f"WITH {WIDE} SELECT 'normal' AS name, row, col FROM m UNION ALL SELECT 'flood', row, col FROM ({_dilated(4)}) UNION ALL SELECT 'drought', row, col FROM ({_eroded_join(1)})")
def three_masks(spark, sf):
    return morph.reference_masks(_wide(spark, sf), 4, 1)


def _reach(edges: str) -> str:
    return f"""c AS (SELECT scene, row, col, row * 8 + col AS k FROM p WHERE mask),
n AS (SELECT a.scene, a.k AS a, b.k AS b FROM c a JOIN c b ON a.scene = b.scene AND {edges}),
r AS (SELECT scene, k, k AS reached FROM c UNION SELECT r.scene, r.k, n.b FROM r JOIN n ON n.scene = r.scene AND n.a = r.reached),
lb AS (SELECT scene, (k // 8)::INT AS row, (k % 8)::INT AS col, (min(reached) // 8)::INT AS comp_row, (min(reached) % 8)::INT AS comp_col FROM r GROUP BY scene, k)"""


EIGHT = "abs(a.row - b.row) <= 1 AND abs(a.col - b.col) <= 1"
LABELS = f"RECURSIVE {PATCH_SQL}, {_reach(EIGHT)}"


def _labels(spark, sf):
    return components.label(fixtures.patch(spark, sf).where("mask"), ["scene"])


@query(f"WITH {LABELS} SELECT * FROM lb")
def connected_components(spark, sf):
    return _labels(spark, sf)


STATS = "SELECT scene, comp_row, comp_col, count(*) AS size, min(row) AS min_row, max(row) AS max_row, min(col) AS min_col, max(col) AS max_col, greatest(1, floor((sqrt(2) - 1.2) * sqrt(count(*)))::INT) AS margin FROM lb GROUP BY scene, comp_row, comp_col"


@query(f"WITH {LABELS} {STATS}")
def component_stats(spark, sf):
    return components.stats(_labels(spark, sf), ["scene"])


@query(f"WITH {LABELS} SELECT lb.* FROM lb JOIN ({STATS}) s USING (scene, comp_row, comp_col) WHERE size > 2")
def remove_small(spark, sf):
    return components.larger_than(_labels(spark, sf), 2, ["scene"])


@query(f"WITH {LABELS} SELECT p.scene, p.row, p.col, coalesce(size, 0) AS area FROM p LEFT JOIN lb USING (scene, row, col) LEFT JOIN ({STATS}) s USING (scene, comp_row, comp_col)")
def area_raster(spark, sf):
    labels = _labels(spark, sf)
    area = components.with_attributes(labels, components.stats(labels, ["scene"]).select("scene", "comp_row", "comp_col", "size"), ["scene"]).select("scene", "row", "col", "size")
    return fixtures.patch(spark, sf).join(area, ["scene", "row", "col"], "left").select("scene", "row", "col", F.coalesce("size", F.lit(0)).alias("area"))


@query(f"""WITH {LABELS} SELECT scene, comp_row, comp_col, round(avg((value > 0.15)::INT), 6) AS portion, (avg((value > 0.15)::INT) > 0.5)::INT AS flag FROM lb JOIN p USING (scene, row, col) GROUP BY ALL""")
def component_portion(spark, sf):
    mask = fixtures.patch(spark, sf).where("value > 0.15").select("scene", "row", "col")
    return components.portion(_labels(spark, sf), mask, ["scene"]).withColumn("portion", F.round("portion", 6))


@query(f"""WITH {LABELS}, e AS (SELECT lb.scene, lb.row, lb.col FROM lb, (VALUES (0, 0), (0, 1), (0, -1), (1, 0), (-1, 0)) o(i, j) JOIN lb x ON x.scene = lb.scene AND x.row = lb.row + o.i AND x.col = lb.col + o.j GROUP BY ALL HAVING count(*) = 5),
b AS (SELECT lb.*, value FROM lb JOIN p USING (scene, row, col) ANTI JOIN e USING (scene, row, col))
SELECT scene, comp_row, comp_col, round(coalesce(stddev_pop(value), 0), 6) AS deviation, round(quantile_cont(value, 0.5), 9) AS median, round(quantile_cont(value, 0.15), 9) AS low FROM b GROUP BY ALL""")
def boundary_terrain(spark, sf):
    labels = _labels(spark, sf)
    near = morph.moved(labels.select("row", "col", "scene"), morph.FOUR)
    rim = near.join(labels.select("scene", "row", "col"), ["scene", "row", "col"], "left_anti")
    edge = morph.moved(rim, morph.FOUR)
    cells = morph.unsent(labels.join(edge, ["scene", "row", "col"], "left_semi")).join(fixtures.patch(spark, sf).select("scene", "row", "col", "value"), ["scene", "row", "col"])
    out = cells.groupBy("scene", "comp_row", "comp_col").agg(F.stddev_pop("value").alias("deviation"), F.expr("percentile(value, array(0.5, 0.15))").alias("q"))
    return out.select("scene", "comp_row", "comp_col", _r("deviation", 6), F.round(F.col("q")[0], 9).alias("median"), F.round(F.col("q")[1], 9).alias("low"))


FOUR = "(VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) o(i, j)"


def _grown(allowed: str) -> str:
    return f"""a AS (SELECT row, col FROM f WHERE {allowed}), s0 AS (SELECT row, col FROM f WHERE fuzzy > 0.7),
r AS (SELECT row, col FROM s0 UNION SELECT a.row, a.col FROM r, {FOUR} JOIN a ON a.row = r.row + o.i AND a.col = r.col + o.j)"""


@query(f"""WITH RECURSIVE {COMBINED}, {_grown('fuzzy > 0.4')} SELECT row, col FROM r""")
def region_grow(spark, sf):
    return components.grow(combined(spark, sf), "fuzzy", 0.7, 0.4)


@query(f"""WITH RECURSIVE {COMBINED}, {_grown('fuzzy > 0.4 AND shadow = 0')} SELECT row, col FROM r""")
def region_grow_excluded(spark, sf):
    rows = combined(spark, sf)
    return components.grow(rows, "fuzzy", 0.7, 0.4, excluded=rows.where("shadow = 1"))


@query(f"""WITH RECURSIVE {COMBINED}, a AS (SELECT row, col FROM f WHERE fuzzy > 0.4), r AS (SELECT row, col, 0 AS k FROM f WHERE fuzzy > 0.7 UNION SELECT a.row, a.col, k + 1 FROM r, {FOUR} JOIN a ON a.row = r.row + o.i AND a.col = r.col + o.j WHERE k < 3)
SELECT DISTINCT row, col FROM r""")
def region_grow_steps(spark, sf):
    return components.grow_steps(combined(spark, sf), "fuzzy", 0.7, 0.4, 3)


@query(f"""WITH {LABELS} SELECT scene, comp_row, comp_col, round(max(value) - min(value), 9) AS spread FROM lb JOIN p USING (scene, row, col) GROUP BY ALL""")
def component_ranges(spark, sf):
    """A function of the user's own over the cells of each component."""

    def spread(frame):
        return frame.head(1)[["scene", "comp_row", "comp_col"]].assign(spread=round(float(frame["value"].max() - frame["value"].min()), 9))

    return components.component_apply(_labels(spark, sf), fixtures.patch(spark, sf).select("scene", "row", "col", "value"), spread, "scene long, comp_row int, comp_col int, spread double", ["scene"])


@query(f"""WITH {BOX}, c AS (SELECT row, col, "cross" AS v, mean, sqrt(variance) / mean AS ci FROM l JOIN st USING (row, col)),
w AS (SELECT *, CASE WHEN ci IS NULL THEN NULL WHEN ci <= 0.523 THEN 1 WHEN ci >= 1.73 THEN 0 ELSE exp(-(ci - 0.523) / (1.73 - ci)) END AS weight FROM c),
le AS (SELECT row, col, CASE WHEN v IS NULL THEN NULL ELSE coalesce(mean * weight + v * (1 - weight), v) END AS lee FROM w),
o2 AS (SELECT i, j FROM range(-1, 2) a(i), range(-1, 2) b(j)), q AS (SELECT row, col, coalesce(10 * log10(CASE WHEN co > 0 THEN co END), 0) AS i0, coalesce(co, 0) AS p0, co FROM l),
x2 AS (SELECT q.row, q.col, count(*) AS k, sum(n.i0) AS si, sum(n.p0) AS sp, sum(n.i0 * n.p0) AS sip, sum(n.i0 * n.i0) AS sii FROM q, o2 JOIN q n ON n.row = q.row + o2.i AND n.col = q.col + o2.j GROUP BY ALL),
y AS (SELECT row, col, (sip / k - si / k * (sp / k)) / (sii / k - si / k * (si / k) + 3) AS a, sp / k AS mp, si / k AS mi FROM x2), z AS (SELECT row, col, a, mp - a * mi AS b FROM y),
s AS (SELECT z.row, z.col, count(*) AS k, sum(n.a) AS sa, sum(n.b) AS sb FROM z, o2 JOIN z n ON n.row = z.row + o2.i AND n.col = z.col + o2.j GROUP BY ALL)
SELECT row, col, round(lee, 9) AS "cross", round(CASE WHEN co IS NOT NULL THEN sa / k * i0 + sb / k END, 8) AS co FROM s JOIN q USING (row, col) JOIN le USING (row, col)""")
def filter_choice(spark, sf):
    """A filter of its own for each band, chosen by name."""
    rows = fixtures.layers(spark, sf)
    out = None
    for band, method, digits in (("cross", "lee", 9), ("co", "guided", 8)):
        part = focal.filtered(rows, band, method).select("row", "col", _r("filtered", digits).alias(band))
        out = part if out is None else out.join(part, ["row", "col"])
    return out
