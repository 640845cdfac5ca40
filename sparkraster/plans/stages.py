"""Queries over fits, refinement and whole stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import maths
from ..operators import bimodal, components, focal, hist, masks, morph, product, refine, thresholds
from ..sources import fixtures
from .cells import DB, SUBSTITUTED, db, smf, substituted, vegetated, zmf
from .neighbours import FOUR

#: Window tests that the layers' wide distributions can pass.
WINDOW_TESTS = {"share": 0.5, "low": 0.2, "high": 2.0}

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql):
    """Registers a query, with its SQL where it has one."""
    if callable(sql):
        QUERIES[sql.__name__] = sql
        return sql

    def keep(f):
        SQL[f.__name__] = sql
        return query(f)

    return keep


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """Layers as the refinement wants them: dark, water, land, reference."""
    rows = db(spark, sf)
    return rows.withColumns({
        "dark": masks.sure(F.col("co_db") < -6), "water": masks.sure(F.col("occurrence") > 0.97),
        "land": masks.not_water(F.col("landcover")).cast("int"), "reference": masks.reference_water(F.col("refwater"), 0.4).cast("int"),
    })


def dark(spark: SparkSession, sf: str) -> DataFrame:
    """Water to refine: dark cells."""
    return morph.kept(cells(spark, sf).where("co_db < -5").select("row", "col"), "dark")


@query
def bimodal_metrics(spark, sf):
    """Fits and verdicts of all patches."""
    return bimodal.verdict(fixtures.patch(spark, sf), ["scene"], "value", -0.5, 0.5, 20)


@query
def window_thresholds(spark, sf):
    """Thresholds of all windows, by minimum error and by equal variance, relaxed by growth."""
    rows = thresholds.windows(db(spark, sf).select("row", "col", "co_db"), 40)
    keys = ["window_row", "window_col"]
    rows = morph.grouped(rows.select(*keys, "row", "col", "co_db"), keys, "windows")
    least = refine.window_thresholds(rows, keys, "co_db", (-28.0, -3.0)).withColumn("method", F.lit("ki"))
    even = morph.kept(refine.window_thresholds(rows, keys, "co_db", (-28.0, -3.0), method="otsu"), "even")
    modes = bimodal.fit(hist.histogram(rows, keys, "co_db", -35.0, 10.0, 450), keys, -35.0, 10.0, 450).select(*keys, F.col("mu1").alias("mean1"), F.col("sd1").alias("std1"), F.col("amp1"))
    grown = refine.grown_threshold(rows, keys, "co_db", morph.kept(even.join(modes, keys), "start")).withColumns({"mode": F.lit(None).cast("double"), "method": F.lit("rg")})
    return least.unionByName(even.withColumn("method", F.lit("otsu"))).unionByName(grown.select(least.columns))


EIGHT = "(VALUES (0, 1), (0, -1), (1, 0), (-1, 0), (1, 1), (1, -1), (-1, 1), (-1, -1)) o(i, j)"


@query(f"""WITH RECURSIVE {DB}, c AS (SELECT row, col, landcover, coalesce(co_db < -6, FALSE) AS dark, coalesce(occurrence > 0.97, FALSE) AS wet FROM d),
s AS (SELECT row, col FROM c WHERE landcover = 60 AND dark), big AS (SELECT DISTINCT s.row, s.col FROM s, {EIGHT} JOIN s t ON t.row = s.row + o.i AND t.col = s.col + o.j),
near AS (SELECT row, col FROM c WHERE wet UNION SELECT row + i, col + j FROM c, {FOUR} WHERE wet),
v AS (SELECT row, col, CASE WHEN near.row IS NOT NULL THEN 0 WHEN big.row IS NOT NULL THEN 1 WHEN landcover IN (30, 90) AND dark THEN 0.75 ELSE 0 END AS v
  FROM c LEFT JOIN near USING (row, col) LEFT JOIN big USING (row, col)),
r AS (SELECT row, col FROM v WHERE v > 0.9 UNION SELECT a.row, a.col FROM r, {FOUR} JOIN v a ON a.row = r.row + o.i AND a.col = r.col + o.j WHERE a.v > 0.7) SELECT row, col FROM r""")
def extend_land(spark, sf):
    return refine.extended_land(cells(spark, sf), ["Bare sparse vegetation"], ["Grassland", "Herbaceous wetland"], least=1, buffer=1)


#: Least cells that dark ones are linked with, spread until nothing changes.
BODIES = f"""{DB}, w AS MATERIALIZED (SELECT row, col, hand, row * 100000 + col AS k FROM d WHERE co_db < -5),
nb AS MATERIALIZED (SELECT w.k AS a, x.k AS b FROM w, {EIGHT} JOIN w x ON x.row = w.row + o.i AND x.col = w.col + o.j),
lb(k, comp) USING KEY (k) AS (SELECT k, k FROM w UNION (SELECT DISTINCT ON (old.k) old.k, lb.comp FROM lb JOIN nb ON nb.a = lb.k JOIN recurring.lb old ON old.k = nb.b WHERE lb.comp < old.comp ORDER BY old.k, lb.comp))"""


@query(f"""WITH RECURSIVE {DB}, c AS (SELECT row, col, landcover, coalesce((landcover = 60 OR glad BETWEEN 1 AND 24) AND occurrence < 0.2 AND co_db < -6 AND cross_db < -16, FALSE) AS seed,
  coalesce(occurrence > 0.5, FALSE) OR coalesce(glad BETWEEN 100 AND 230, FALSE) AS barred FROM d),
s AS (SELECT row, col FROM c WHERE seed), big AS (SELECT DISTINCT s.row, s.col FROM s, {EIGHT} JOIN s t ON t.row = s.row + o.i AND t.col = s.col + o.j),
near AS (SELECT row, col FROM c WHERE landcover = 80 UNION SELECT row + i, col + j FROM c, {FOUR} WHERE landcover = 80),
v AS (SELECT row, col, barred, CASE WHEN near.row IS NOT NULL THEN 0 WHEN landcover IN (30, 90) THEN 0.75 WHEN big.row IS NOT NULL THEN 1 ELSE 0 END AS v FROM c LEFT JOIN near USING (row, col) LEFT JOIN big USING (row, col)),
r AS (SELECT row, col FROM v WHERE v > 0.9 UNION SELECT a.row, a.col FROM r, {FOUR} JOIN v a ON a.row = r.row + o.i AND a.col = r.col + o.j WHERE a.v > 0.9 OR (a.v > 0.7 AND NOT a.barred)) SELECT row, col FROM r""")
def extend_land_from(spark, sf):
    """Land grown from dark cells of either map, kept out of possible water."""
    rows = db(spark, sf)
    either = masks.landcover_mask(F.col("landcover"), [60]) | masks.sure(F.col("glad").between(*masks.LAND_CODES))
    seed = masks.dark_land(either, F.col("occurrence"), F.col("co_db"), F.col("cross_db"), 0.2, -6, -16)
    barred = masks.sure(F.col("occurrence") > 0.5) | masks.sure(F.col("glad").between(*masks.WATER_CODES))
    marked = morph.kept(rows.select("row", "col", "landcover", masks.sure(seed).alias("seed"), barred.alias("barred")), "marked")
    return refine.extended_land_from(marked, ["Grassland", "Herbaceous wetland"], least=1, buffer=1)


SIZES = BODIES + ", sz AS (SELECT lb.k, count(*) OVER (PARTITION BY comp) AS area FROM lb)"
AREA = SUBSTITUTED[len(DB) :]


@query(f"""WITH RECURSIVE {SIZES}{AREA}, q AS (SELECT z.*, coalesce(sz.area, 0)::DOUBLE AS area FROM z LEFT JOIN sz ON sz.k = z.row * 100000 + z.col)
SELECT row, col, round(0.5 * CASE WHEN cross_z IS NULL THEN co_z WHEN co_z IS NULL THEN cross_z ELSE (co_z + cross_z) / 2 END
  + 0.5 * (({zmf('coalesce(hand, 0)', 0.0, 15.0)} + {zmf('slope', 0.5, 15.0)} + {smf('area', 0.0, 40.0)}) / 3), 6) AS membership FROM q""")
def membership_area(spark, sf):
    """Memberships with the size of a cell's dark body in place of its occurrence."""
    labels = morph.kept(components.label(dark(spark, sf)), "bodies")
    sizes = components.with_attributes(labels, components.stats(labels)).select("row", "col", F.col("size").cast("double").alias("area"))
    rows = substituted(db(spark, sf)).join(sizes, ["row", "col"], "left").na.fill(0.0, ["area"])
    return masks.membership(rows, weights_area=True).select("row", "col", F.round("membership", 6).alias("membership"))


@query
def false_water(spark, sf):
    return refine.false_water(dark(spark, sf), cells(spark, sf), "co_db")


@query
def fill_bright(spark, sf):
    return refine.filled_gaps(dark(spark, sf), cells(spark, sf), "co_db")


@query(f"""WITH RECURSIVE {BODIES}, c AS (SELECT w.*, comp FROM w JOIN lb USING (k)),
e AS (SELECT c.k FROM c, {FOUR} JOIN c x ON x.row = c.row + o.i AND x.col = c.col + o.j GROUP BY c.k HAVING count(*) = 4),
f AS (SELECT comp, stddev_pop(hand) AS s, quantile_cont(hand, 0.5) AS m FROM c ANTI JOIN e USING (k) GROUP BY comp HAVING stddev_pop(hand) > 2.5),
h AS (SELECT c.row, c.col, c.k FROM c JOIN f USING (comp) WHERE c.hand > round(m + s, 9)),
r AS (SELECT row, col FROM h ANTI JOIN e USING (k) UNION SELECT h.row, h.col FROM r, {FOUR} JOIN h ON h.row = r.row + o.i AND h.col = r.col + o.j)
SELECT row, col FROM c ANTI JOIN r USING (row, col)""")
def terrain_erode(spark, sf):
    return refine.terrain_eroded(dark(spark, sf), cells(spark, sf), "hand")


@query
def split_water(spark, sf):
    """Bands taken out of large bodies, in both modes."""
    water, rows = dark(spark, sf), cells(spark, sf)
    one = refine.split_water(water, rows, "co_db", 20).withColumn("mode", F.lit("v1"))
    return one.unionByName(refine.split_water(water, rows, "co_db", 20, "v2").withColumn("mode", F.lit("v2")))


@query
def threshold_stage(spark, sf):
    """Thresholds of the windows that pass all tests, as a surface, and the initial water."""
    rows = db(spark, sf).select("row", "col", "co_db", masks.sure(F.col("occurrence") > 0.5).alias("known"))
    return refine.threshold_stage(rows, "co_db", water="known", **WINDOW_TESTS)


@query
def threshold_stage_growth(spark, sf):
    """The same with thresholds relaxed by growth."""
    rows = db(spark, sf).select("row", "col", "co_db", masks.sure(F.col("occurrence") > 0.5).alias("known"))
    return refine.threshold_stage(rows, "co_db", water="known", method="rg", **WINDOW_TESTS)


@query
def mask_stage(spark, sf):
    return refine.mask_stage(cells(spark, sf), dark(spark, sf), "co_db")


@query
def mask_stage_two(spark, sf):
    """The masking of the second sensor."""
    return refine.mask_stage(cells(spark, sf), dark(spark, sf), "co_db", mode="v2", vegetation="glad")


@query
def refine_stage(spark, sf):
    return refine.refine_stage(cells(spark, sf), dark(spark, sf), "co_db")


def workflow(spark: SparkSession, sf: str, ratio: bool) -> DataFrame:
    """Filter, threshold, membership, growth, masks, refinement, vegetation, classification: (row, col, code)."""
    rows = focal.slope(fixtures.layers(spark, sf), "dem")
    smooth = focal.lee(rows.select("row", "col", "co"), "co").select("row", "col", F.col("filtered").alias("co"))
    rows = rows.drop("co").join(smooth, ["row", "col"]).withColumns({"co_db": maths.to_db("co"), "cross_db": maths.to_db("cross"), "occurrence": maths.occurrence_share("refwater")})
    rows = morph.kept(rows, "filtered")
    known = rows.select("row", "col", "co_db", masks.sure(F.col("occurrence") > 0.5).alias("known"))
    surface = refine.threshold_stage(known, "co_db", water="known", **WINDOW_TESTS).select("row", "col", "threshold", F.col("water").alias("initial"))
    valley = F.coalesce("threshold", F.lit(-50.0))  # no window passed: no water by this band
    fall = maths.zmf_recentred("co_db", valley - 4, valley) if ratio else maths.zmf("co_db", valley - 4, valley + 2)
    scored = rows.join(surface, ["row", "col"], "left").withColumns({"co_z": fall, "cross_z": maths.zmf("cross_db", -22.0, -14.0)})
    scored = masks.membership(scored).withColumn("fuzzy", F.when(F.col("cross").isNull(), None).when(F.col("hand") > 200, 0.0).otherwise(F.col("membership")))
    scored = morph.kept(scored, "scored")
    grown = morph.kept(components.grow(scored, "fuzzy", 0.6, 0.45), "grown")
    layers = scored.withColumns({
        "dark": masks.sure(F.col("co_db") < -6), "water": masks.sure(F.col("occurrence") > 0.97), "land": masks.not_water(F.col("landcover")).cast("int"),
        "reference": masks.reference_water(F.col("refwater")).cast("int"),
    })
    # The second sensor masks by its vegetation map too, judges bodies at their edges and refines from 4 cells on.
    masked = refine.mask_stage(layers, grown, "co_db", mode="v2", vegetation="glad") if ratio else refine.mask_stage(layers, grown, "co_db")
    final = refine.refine_stage(layers, morph.kept(masked, "masked"), "co_db", 4 if ratio else 40)
    out = vegetated(scored).join(final.withColumn("is_water", F.lit(True)), ["row", "col"], "left")
    code = product.classified(
        F.col("is_water"), inundated_vegetation=F.col("veg") == 2, hand_mask=F.col("hand") > 200, layover_shadow_mask=F.col("shadow") > 0, no_data=F.col("cross").isNull()
    )
    return out.select("row", "col", code.alias("code"))


@query
def workflow_one(spark, sf):
    """The first sensor's workflow, end to end."""
    return workflow(spark, sf, False)


@query
def workflow_two(spark, sf):
    """The second sensor's workflow: recentred memberships, classes collapsed to the product's."""
    return workflow(spark, sf, True).withColumn("code", product.collapse(F.col("code")))
