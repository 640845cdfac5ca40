"""Queries over histograms, thresholds and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import hist, morph, pyramid, thresholds
from ..sources import fixtures
from ..sources.fixtures import LAYERS_SQL, PATCH_SQL
from .cells import DB, db

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _bin(v: str, low: float, high: float, n: int) -> str:
    return f"(CASE WHEN {v} >= {low!r}::DOUBLE AND {v} <= {high!r}::DOUBLE THEN least(floor(({v} - {low!r}::DOUBLE) / {(high - low) / n!r}::DOUBLE)::INT, {n - 1}) END)"


LOW, HIGH, BINS = -0.5, 0.5, 20
STEP = (HIGH - LOW) / BINS
HIST = f"{PATCH_SQL}, h0 AS (SELECT scene, {_bin('value', LOW, HIGH, BINS)} AS bin FROM p), h AS (SELECT scene, bin, count(*) AS n FROM h0 WHERE bin IS NOT NULL GROUP BY ALL)"
DENSE = f"{HIST}, e AS (SELECT s.scene, b.bin::INT AS bin, coalesce(h.n, 0) AS n FROM (SELECT DISTINCT scene FROM h) s CROSS JOIN range({BINS}) b(bin) LEFT JOIN h ON h.scene = s.scene AND h.bin = b.bin)"


@query(f"""WITH {HIST} SELECT scene, bin, n, round(n / (sum(n) OVER (PARTITION BY scene) * {STEP!r}::DOUBLE), 6) AS density FROM h""")
def histogram(spark, sf):
    return hist.histogram(fixtures.patch(spark, sf), ["scene"], "value", LOW, HIGH, BINS).withColumn("density", F.round("density", 6))


def _own(n: int) -> str:
    return f"""{PATCH_SQL}, r AS (SELECT scene, min(value) AS low, max(value) AS high FROM p GROUP BY scene HAVING max(value) > min(value)),
b AS (SELECT p.scene, least(floor((value - low) / ((high - low) / {n}))::INT, {n - 1}) AS bin, low, (high - low) / {n} AS step FROM p JOIN r USING (scene)),
c AS (SELECT scene, bin, count(*) AS n, max(low) AS low, max(step) AS step FROM b GROUP BY ALL),
q AS (SELECT *, (sum(n) OVER w)::BIGINT AS n1, (sum(n * bin) OVER w)::BIGINT AS s1, (sum(n) OVER (PARTITION BY scene))::BIGINT AS nt, (sum(n * bin) OVER (PARTITION BY scene))::BIGINT AS st FROM c WINDOW w AS (PARTITION BY scene ORDER BY bin))"""


@query(f"""WITH {_own(256)} SELECT scene, round(arg_max(low + (bin + 0.5) * step, (round(n1 * (nt - n1) * pow(s1 / n1 - (st - s1) / (nt - n1), 2), 6), -bin)), 6) AS threshold FROM q WHERE nt > n1 GROUP BY scene""")
def otsu(spark, sf):
    return hist.otsu(fixtures.patch(spark, sf), ["scene"], "value").withColumn("threshold", F.round("threshold", 6))


@query(f"""WITH {_own(32)}, a AS (SELECT x.scene, x.bin AS i, y.bin AS j, x.low, x.step, round(pow(x.s1, 2) / x.n1 + pow(y.s1 - x.s1, 2) / (y.n1 - x.n1) + pow(x.st - y.s1, 2) / (x.nt - y.n1), 6) AS score
  FROM q x JOIN q y ON x.scene = y.scene AND x.bin < y.bin WHERE y.n1 < y.nt)
SELECT scene, round(arg_max(low + (i + 0.5) * step, (score, -i, -j)), 6) AS low_threshold, round(arg_max(low + (j + 0.5) * step, (score, -i, -j)), 6) AS high_threshold FROM a GROUP BY scene""")
def multi_otsu(spark, sf):
    out = hist.multi_otsu(fixtures.patch(spark, sf), ["scene"], "value", 32)
    return out.select("scene", F.round("low_threshold", 6).alias("low_threshold"), F.round("high_threshold", 6).alias("high_threshold"))


@query(f"""WITH {DENSE}, x AS (SELECT *, {LOW!r}::DOUBLE + bin * {STEP!r}::DOUBLE AS x FROM e),
f AS (SELECT *, (sum(n) OVER w)::BIGINT AS n1, sum(n * x) OVER w AS s1, sum(n * x * x) OVER w AS q1 FROM x WINDOW w AS (PARTITION BY scene ORDER BY bin)),
t AS (SELECT *, max_by(n1, bin) OVER (PARTITION BY scene) - n1 AS n2, max_by(s1, bin) OVER (PARTITION BY scene) - s1 AS s2, max_by(q1, bin) OVER (PARTITION BY scene) - q1 AS q2 FROM f),
v AS (SELECT *, greatest(1e-5, least(1 - 1e-5, n1 / (n1 + n2))) AS p, sqrt(CASE WHEN n1 > 0 AND q1 / n1 - pow(s1 / n1, 2) > 1e-12 THEN q1 / n1 - pow(s1 / n1, 2) ELSE 1e-5 END) AS d1,
  sqrt(CASE WHEN n2 > 0 AND q2 / n2 - pow(s2 / n2, 2) > 1e-12 THEN q2 / n2 - pow(s2 / n2, 2) ELSE 1e-5 END) AS d2 FROM t),
k AS (SELECT *, round(p * ln(d1) + (1 - p) * ln(d2) - p * ln(p) - (1 - p) * ln(1 - p), 8) AS error FROM v)
SELECT scene, arg_min(bin, (error, bin)) AS bin, round({LOW!r}::DOUBLE + arg_min(bin, (error, bin)) * {STEP!r}::DOUBLE, 6) AS threshold FROM k GROUP BY scene""")
def ki_threshold(spark, sf):
    return hist.minimum_error(fixtures.patch(spark, sf), ["scene"], "value", LOW, HIGH, BINS).withColumn("threshold", F.round("threshold", 6))


@query(f"""WITH {PATCH_SQL}, u AS (SELECT scene, var_pop(value) AS variance FROM p GROUP BY scene), b AS (SELECT scene, value, {_bin('value', LOW, HIGH, 2 * BINS)} AS bin FROM p),
c AS (SELECT scene, bin, count(*) AS n, sum(value) AS s FROM b WHERE bin IS NOT NULL GROUP BY ALL),
e AS (SELECT s.scene, k.bin::INT AS bin, coalesce(c.n, 0) AS n, coalesce(c.s, 0) AS s FROM (SELECT DISTINCT scene FROM c) s CROSS JOIN range({2 * BINS}) k(bin) LEFT JOIN c ON c.scene = s.scene AND c.bin = k.bin),
f AS (SELECT *, (sum(n) OVER w)::BIGINT AS c, sum(s) OVER w AS t, (sum(n) OVER (PARTITION BY scene))::BIGINT AS all_n, sum(s) OVER (PARTITION BY scene) AS all_s FROM e WINDOW w AS (PARTITION BY scene ORDER BY bin)),
g AS (SELECT *, lead(c) OVER (PARTITION BY scene ORDER BY bin) AS upto, coalesce(lag(c) OVER (PARTITION BY scene ORDER BY bin), 0) AS below FROM f)
SELECT scene, round(max(upto / all_n * ((all_n - below) / all_n) * pow(t / c - (all_s - t) / (all_n - c), 2) / variance), 6) AS share FROM g JOIN u USING (scene) WHERE bin % 2 = 0 AND c > 0 AND c < all_n AND variance > 0 GROUP BY scene""")
def between_class_share(spark, sf):
    return hist.between_class_share(fixtures.patch(spark, sf), ["scene"], "value", LOW, HIGH, BINS).withColumn("share", F.round("share", 6))


@query(f"""WITH {DENSE}, u AS (SELECT scene, var_samp(value) AS variance FROM p GROUP BY scene HAVING count(*) > 2),
c AS (SELECT *, 0.2261 * coalesce(lag(n) OVER w, 0) + 0.5478 * n + 0.2261 * coalesce(lead(n) OVER w, 0) AS c, {LOW!r}::DOUBLE + (bin + 0.5) * {STEP!r}::DOUBLE AS x FROM e WINDOW w AS (PARTITION BY scene ORDER BY bin)),
m AS (SELECT scene, bin, c::DOUBLE AS c, c::DOUBLE * x AS m FROM c),
f AS (SELECT *, sum(c) OVER (PARTITION BY scene) AS al, sum(c) OVER l AS cl, sum(m) OVER l AS ml, sum(m * m) OVER l AS ql, count(*) OVER l AS kl, sum(c) OVER r AS cr, sum(m) OVER r AS mr, sum(m * m) OVER r AS qr, count(*) OVER r AS kr
  FROM m WINDOW l AS (PARTITION BY scene ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), r AS (PARTITION BY scene ORDER BY bin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
d AS (SELECT *, ml / cl AS al1, mr / cr AS ar1, sqrt(greatest(ql - 2 * (ml / cl) * ml + kl * (ml / cl) * (ml / cl), 0)) / cl AS dl, sqrt(greatest(qr - 2 * (mr / cr) * mr + kr * (mr / cr) * (mr / cr), 0)) / cr AS dr FROM f WHERE cl > 1e-9 AND cr > 1e-9)
SELECT scene, round(max(cl / al * (cr / al) * pow(al1 - ar1, 2) / variance), 6) AS share, round(max(sqrt(2.0) * abs(al1 - ar1) / sqrt(pow(dl, 2) + pow(dr, 2))), 6) AS separation FROM d JOIN u USING (scene) WHERE variance > 0 GROUP BY scene""")
def histogram_bimodality(spark, sf):
    out = hist.histogram_bimodality(fixtures.patch(spark, sf), ["scene"], "value", LOW, HIGH, BINS)
    return out.select("scene", F.round("share", 6).alias("share"), F.round("separation", 6).alias("separation"))


def _peaks(name: str, test: str) -> str:
    return f"""{name}0 AS (SELECT *, CASE WHEN n = lag(n) OVER (PARTITION BY landcover ORDER BY bin) THEN 0 ELSE 1 END AS new FROM e WHERE {test}),
{name}1 AS (SELECT *, sum(new) OVER (PARTITION BY landcover ORDER BY bin) AS run FROM {name}0),
{name}2 AS (SELECT landcover, run, max(n) AS n, floor((min(bin) + max(bin)) / 2)::INT AS bin FROM {name}1 GROUP BY ALL),
{name}3 AS (SELECT *, coalesce(lag(n) OVER w < n AND lead(n) OVER w < n, FALSE)::INT AS peak FROM {name}2 WINDOW w AS (PARTITION BY landcover ORDER BY run)),
{name} AS (SELECT landcover, arg_max(bin, (peak, n, -bin)) AS peak FROM {name}3 GROUP BY landcover)"""


@query(f"""WITH {DB}, h AS (SELECT landcover, {_bin('co_db', -35.0, 0.0, 70)} AS bin FROM d), c AS (SELECT landcover, bin, count(*) AS n FROM h WHERE bin IS NOT NULL GROUP BY ALL),
e AS (SELECT s.landcover, b.bin::INT AS bin, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT landcover FROM c) s CROSS JOIN range(70) b(bin) LEFT JOIN c ON c.landcover = s.landcover AND c.bin = b.bin),
{_peaks('lo', 'bin <= 46')}, {_peaks('hi', 'bin >= 46')} SELECT landcover, lo.peak AS low_peak, hi.peak AS high_peak FROM lo JOIN hi USING (landcover)""")
def histogram_peaks(spark, sf):
    bins = hist.histogram(db(spark, sf), ["landcover"], "co_db", -35.0, 0.0, 70)
    return hist.tallest_peaks(bins, ["landcover"], 70, 46)


def _windows(size: int) -> str:
    h = size // 2
    return f"""SELECT {size} AS window_size, (row // {h} - i)::INT AS window_row, (col // {h} - j)::INT AS window_col, u, water FROM y, range(2) a(i), range(2) b(j) WHERE row // {h} >= i AND col // {h} >= j"""


STATS = f"""{DB}, y AS (SELECT row, col, round(co * 1e8)::BIGINT AS u, coalesce(co_db < -11, FALSE) AS water FROM d), z AS ({_windows(40)} UNION ALL {_windows(20)} UNION ALL {_windows(10)}),
o AS (SELECT avg(u) AS overall FROM y),
st AS (SELECT window_size, window_row, window_col, avg(u) AS mean, stddev_pop(u) AS deviation, count(u) AS valid, avg(water::INT) AS water FROM z GROUP BY ALL),
w AS (SELECT st.*, deviation / mean AS variation, mean / overall AS ratio FROM st, o WHERE valid > window_size * window_size / 3)"""


def _stats(spark, sf):
    rows = db(spark, sf).select("row", "col", F.round(F.col("co") * 1e8).cast("long").alias("u"), F.coalesce(F.col("co_db") < -11, F.lit(False)).alias("water"))
    return thresholds.window_stats(rows, "u", (40, 20, 10), "water")


@query(f"""WITH {STATS} SELECT window_size, window_row, window_col, valid, round(mean, 3) AS mean, round(deviation, 3) AS deviation, round(variation, 6) AS variation, round(ratio, 6) AS ratio, round(water, 6) AS water FROM w""")
def window_stats(spark, sf):
    r = lambda c, k: F.round(c, k).alias(c)
    return _stats(spark, sf).select("window_size", "window_row", "window_col", "valid", r("mean", 3), r("deviation", 3), r("variation", 6), r("ratio", 6), r("water", 6))


@query(f"""WITH {STATS}, k AS (SELECT * FROM w WHERE water > 0.02 AND water < 0.98 AND variation >= 0.09 AND ratio BETWEEN 0.8 AND 0.97),
n AS (SELECT window_size, (SELECT count(*) FROM k WHERE k.window_size > s.window_size) AS earlier FROM (SELECT DISTINCT window_size FROM w) s)
SELECT window_size, window_row, window_col, round(ratio, 6) AS ratio FROM k JOIN n USING (window_size) WHERE earlier <= 20""")
def window_select(spark, sf):
    return thresholds.selected(_stats(spark, sf)).select("window_size", "window_row", "window_col", F.round("ratio", 6).alias("ratio"))


_ERF = """(1 - (((((1.061405429 * q) - 1.453152027) * q + 1.421413741) * q - 0.284496736) * q + 0.254829592) * q * exp(-z * z))"""


def _cdf(name: str, mean: str, std: str, source: str) -> str:
    return f"""{name}0 AS (SELECT *, (spot - {mean}) / {std} / sqrt(2.0) AS z FROM {source}), {name}1 AS (SELECT *, 1 / (1 + 0.3275911 * abs(z)) AS q FROM {name}0),
{name} AS (SELECT * EXCLUDE (z, q), 0.5 * (1 + CASE WHEN z < 0 THEN -{_ERF} ELSE {_ERF} END) AS {name}_cdf FROM {name}1)"""


@query(f"""WITH {PATCH_SQL}, m AS (SELECT scene, (-20 + scene % 5)::DOUBLE AS threshold, (-22)::DOUBLE AS mean1, 1.5::DOUBLE AS std1, (-12)::DOUBLE AS mean2, (1 + scene % 3)::DOUBLE AS std2 FROM (SELECT DISTINCT scene FROM p)),
k AS (SELECT m.*, k::INT AS k, mean2 - (mean2 - threshold) * pow(0.95, k) AS spot FROM m, range(101) r(k)), {_cdf('c1', 'mean1', 'std1', 'k')}, {_cdf('c2', 'mean2', 'std2', 'c1')}
SELECT scene, threshold, arg_min(k, k)::INT AS steps, round(arg_min(spot, k), 6) AS moved FROM c2 WHERE NOT (c1_cdf < 0.98 AND c2_cdf < 0.02) OR k = 100 GROUP BY scene, threshold""")
def threshold_walk(spark, sf):
    scenes = fixtures.patch(spark, sf).select("scene").distinct()
    d = lambda e: F.expr(f"cast({e} as double)")
    modes = scenes.select("scene", d("-20 + scene % 5").alias("threshold"), d("-22").alias("mean1"), d("1.5").alias("std1"), d("-12").alias("mean2"), d("1 + scene % 3").alias("std2"))
    return thresholds.walked(modes).select("scene", "threshold", "steps", F.round("moved", 6).alias("moved"))


#: Over all cells; holes are where data are missing.
MEDIANS = f"""{DB}, md AS (SELECT (row // 10)::INT AS row, (col // 10)::INT AS col, quantile_cont(co_db, 0.5) AS value FROM d WHERE co_db IS NOT NULL GROUP BY row // 10, col // 10)"""


def _medians(spark, sf):
    rows = db(spark, sf).where("co_db is not null").select(F.floor(F.col("row") / 10).cast("int").alias("row"), F.floor(F.col("col") / 10).cast("int").alias("col"), F.col("co_db").alias("value"))
    return thresholds.block_median(rows, ["row", "col"], "value")


@query(f"""WITH {MEDIANS} SELECT row, col, round(value, 8) AS value FROM md""")
def block_median(spark, sf):
    return _medians(spark, sf).withColumn("value", F.round("value", 8))


@query(f"""WITH {MEDIANS} SELECT row, col, round(value, 8) AS value FROM md""")
def block_median_all(spark, sf):
    return _medians(spark, sf).withColumn("value", F.round("value", 8))


SURFACE = f"""{MEDIANS}, bl AS (SELECT DISTINCT (row // 10)::INT AS row, (col // 10)::INT AS col FROM d),
pr AS (SELECT bl.row, bl.col, md.row AS r2, md.col AS c2, md.value, pow(bl.row - md.row, 2) + pow(bl.col - md.col, 2) AS far FROM bl, md),
nr AS (SELECT row, col, sum(value / pow(far + 1, 0.25)) / sum(1 / pow(far + 1, 0.25)) AS value FROM pr WHERE abs(row - r2) <= 2 AND abs(col - c2) <= 2 GROUP BY row, col),
fl AS (SELECT row, col, arg_min(value, (far, r2, c2)) AS value FROM pr GROUP BY row, col),
sf AS (SELECT fl.row, fl.col, round(coalesce(nr.value, fl.value), 8) AS value FROM fl LEFT JOIN nr USING (row, col))"""


def _surface(spark, sf):
    blocks = db(spark, sf).select(F.floor(F.col("row") / 10).cast("int").alias("row"), F.floor(F.col("col") / 10).cast("int").alias("col")).distinct()
    return thresholds.inverse_distance(blocks, _medians(spark, sf)).withColumn("value", F.round("value", 8))


@query(f"""WITH {SURFACE} SELECT * FROM sf""")
def idw_surface(spark, sf):
    return _surface(spark, sf)


@query(f"""WITH {SURFACE} SELECT d.row, d.col, coalesce(co_db < sf.value, FALSE)::INT AS water FROM d LEFT JOIN sf ON sf.row = d.row // 10 AND sf.col = d.col // 10""")
def initial_water(spark, sf):
    out = thresholds.below(db(spark, sf), _surface(spark, sf), 10, "co_db")
    return out.select("row", "col", F.col("water").cast("int").alias("water"))


@query(f"""WITH {SURFACE} SELECT * FROM sf""")
def idw_surface_all(spark, sf):
    return _surface(spark, sf)


@query(f"""WITH {SURFACE} SELECT d.row, d.col, coalesce(co_db < sf.value, FALSE)::INT AS water FROM d LEFT JOIN sf ON sf.row = d.row // 10 AND sf.col = d.col // 10""")
def initial_water_all(spark, sf):
    out = thresholds.below(db(spark, sf), _surface(spark, sf), 10, "co_db")
    return out.select("row", "col", F.col("water").cast("int").alias("water"))


@query(f"""WITH {DB} SELECT round(greatest(quantile_cont(co_db, 0.995), avg(co_db)) + 2 * stddev_pop(co_db), 6) AS bound FROM d WHERE CASE WHEN refwater = 255 THEN 100 ELSE refwater END / 100 > 0.9""")
def upper_bound(spark, sf):
    rows = db(spark, sf).where("if(refwater = 255, 100, refwater) / 100 > 0.9")
    return thresholds.upper_bound(rows, "co_db", "co_db is not null").withColumn("bound", F.round("bound", 6))


@query(f"""WITH {LAYERS_SQL}, t AS (SELECT DISTINCT (row // 20 * 20)::INT AS row0, (col // 20 * 20)::INT AS col0 FROM l)
SELECT row0, col0, (row0 + 20)::DOUBLE AS centre_row, (col0 + 20)::DOUBLE AS centre_col, (CASE (row0 // 20 + col0 // 20) % 3 WHEN 2 THEN 0 ELSE -35 END)::DOUBLE AS low,
  (CASE (row0 // 20 + col0 // 20) % 3 WHEN 2 THEN 15 ELSE 10 END)::DOUBLE AS high FROM t""")
def window_centres(spark, sf):
    """Corners and centres of all windows, and the histogram ranges of each one's band."""
    rows = fixtures.layers(spark, sf).select(*[F.expr(f"cast({c} div 20 * 20 as int)").alias(f"{c}0") for c in ("row", "col")]).distinct()
    ranges = F.create_map(*[x for k, (a, b) in enumerate([(-35.0, 10.0), (-35.0, 10.0), (0.0, 15.0)]) for x in (F.lit(k), F.struct(F.lit(a).alias("low"), F.lit(b).alias("high")))])
    kind = ranges[F.expr("cast((row0 div 20 + col0 div 20) % 3 as int)")]
    return rows.select("row0", "col0", (F.col("row0") + 20).cast("double").alias("centre_row"), (F.col("col0") + 20).cast("double").alias("centre_col"), kind["low"].alias("low"), kind["high"].alias("high"))


VALLEY = "sum(0.3 * exp(-(x - mu) * (x - mu) / 2 / 4))"


@query(f"""WITH {DB}, m AS (SELECT (row // 20)::INT AS block, avg(co_db) + 2 AS mu, min(co_db) AS low_peak, max(co_db) AS high_peak FROM d GROUP BY row // 20),
b AS (SELECT m.*, bin, -35 + (bin + 0.5) * 0.1 AS x FROM m, range(450) r(bin)), c AS (SELECT *, {VALLEY} OVER (PARTITION BY block ORDER BY bin) / {VALLEY} OVER (PARTITION BY block) AS upto FROM b)
SELECT block, round(coalesce(max(x) FILTER (x > low_peak AND x < high_peak AND x < mu AND upto < 0.03), max(low_peak)), 6) AS valley FROM c GROUP BY block""")
def valley_mode(spark, sf):
    """Where less than three hundredths of a block's second mode lie below."""
    from ..operators import bimodal

    modes = db(spark, sf).groupBy(F.floor(F.col("row") / 20).cast("int").alias("block")).agg((F.avg("co_db") + 2).alias("mu"), F.min("co_db").alias("low_peak"), F.max("co_db").alias("high_peak"))
    modes = modes.withColumns({"sd": F.lit(2.0), "amp": F.lit(0.3), "threshold": F.col("mu")})
    return bimodal.valley_mode(modes, ["block"], -35.0, 10.0, 450).withColumn("valley", F.round("valley", 6))


@query()
def window_select_all(spark, sf):
    """Windows that pass all tests: mixture, variation, two modes, variance between classes. No SQL: modes are fitted."""
    cells = db(spark, sf).select("row", "col", F.round(F.col("co_db"), 6).alias("u"), F.coalesce(F.col("co_db") < -11, F.lit(False)).alias("water"))
    sizes, bins = (40, 20, 10), (-35.0, 0.0, 70)
    stats = morph.kept(thresholds.window_stats(cells.withColumn("u", F.pow(F.lit(10.0), F.col("u") / 10)), "u", sizes, "water"), "stats")
    return thresholds.selected_by_all(stats, pyramid.halves(cells, "u", sizes, *bins), bins, 0.5, low=0.2, high=2.0)


@query()
def upper_bound_by_modes(spark, sf):
    """Upper bounds from one mode of the reference water where it has two. No SQL: modes are fitted."""
    return thresholds.upper_bound_by_modes(db(spark, sf), "co_db", "if(refwater = 255, 100, refwater) / 100 > 0.9")


@query()
def linear_surface(spark, sf):
    """A threshold for every block from those blocks that hold both water and land: linear between them, the nearest's outside."""
    block = [F.floor(F.col(c) / 10).cast("int").alias(c) for c in ("row", "col")]
    rows = db(spark, sf).select(*block, "co_db").groupBy("row", "col").agg(F.avg("co_db").alias("value"), F.stddev_pop("co_db").alias("spread"))
    rows = morph.kept(rows, "blocks")
    points = rows.join(F.broadcast(rows.agg(F.avg("spread").alias("usual"))), F.col("spread") > F.col("usual"))  # one row
    points = morph.kept(points.select(F.col("row").alias("pr"), F.col("col").alias("pc"), "value"), "points")
    return thresholds.filled_points(rows.select("row", "col"), points, 4)
