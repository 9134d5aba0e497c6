"""Polygons, lines, rasters, smoothing, orbits, clusters, kriging."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions.metrics import correlation, scores
from dustline.functions.quantiles import exact_quantiles
from dustline.operators import clusters, fires, kriging, spatial
from dustline.registry import feeds as X
from dustline.registry.core import query
from dustline.registry.feeds import r, sr
from dustline.registry.joins import _EDGES, CSPOTS, RES, cell_spots, residual_rows
from dustline.session import written

CORNERS = ((-1.0, 0.0), (0.0, -1.0), (1.0, 0.0), (0.0, 1.0))
_EDGE_ROWS = ", ".join(f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for a, b in zip(CORNERS, CORNERS[1:] + CORNERS[:1]))
EDGES = f"edges AS (SELECT site_id AS feature_id, lon + ax * 0.61 AS x1, lat + ay * 0.43 AS y1, lon + bx * 0.61 AS x2, lat + by_ * 0.43 AS y2 FROM stations, (VALUES {_EDGE_ROWS}) e(ax, ay, bx, by_))"


def diamonds(stations, width=0.61, height=0.43, feature="site_id"):
    sides = [F.struct((F.col("lon") + a[0] * width).alias("x1"), (F.col("lat") + a[1] * height).alias("y1"), (F.col("lon") + b[0] * width).alias("x2"), (F.col("lat") + b[1] * height).alias("y2"))
             for a, b in zip(CORNERS, CORNERS[1:] + CORNERS[:1])]
    return stations.select(F.col(feature).alias("feature_id"), F.explode(F.array(*sides)).alias("e")).select("feature_id", "e.*")


INSIDE = "inside AS (SELECT cell, feature_id FROM spots JOIN edges ON (y1 > lat) <> (y2 > lat) AND lon < x1 + (lat - y1) * (x2 - x1) / (y2 - y1) GROUP BY ALL HAVING count(*) % 2 = 1)"


@query("D15 L18 T10", X.with_(X.STATIONS, CSPOTS, EDGES, INSIDE) + "SELECT cell, coalesce(max(feature_id), -1) AS region FROM spots LEFT JOIN inside USING (cell) GROUP BY cell")
def polygon_index_of_cells(spark, sf):
    return spatial.assign_polygon(cell_spots(spark, sf), diamonds(X.stations(spark, sf)), ["cell"], "region").select("cell", "region")


@query("D16", X.with_(X.STATIONS) + """, c AS (SELECT country AS region, site_id // 1 AS k, avg(lat) AS clat, avg(lon) AS clon FROM stations GROUP BY ALL), hub AS (SELECT network AS hub, avg(lat) AS hlat, avg(lon) AS hlon FROM stations GROUP BY network)
SELECT hub, k AS site_id FROM c, hub WHERE abs(clon - hlon) / 1.3 + abs(clat - hlat) / 1.1 < 1""")
def features_inside_regions(spark, sf):
    """Features whose centroid lies inside a region polygon."""
    st = X.stations(spark, sf)
    centroid = st.groupBy("site_id").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    hubs = st.groupBy(F.col("network").alias("hub")).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    edges = diamonds(hubs, 1.3, 1.1, "hub").withColumnRenamed("feature_id", "hub")
    return spatial.polygon_cells(centroid, edges, ["site_id"], feature="hub").select("hub", "site_id")


LINES = "segs AS (SELECT lon AS x1, lat AS y1, lon + 0.31 AS x2, lat + 0.17 AS y2 FROM stations)"


@query("L17", X.with_(X.STATIONS, CSPOTS, LINES) + f""", s AS (SELECT x1 * k AS ax, y1 AS ay, x2 * k AS bx, y2 AS by_ FROM segs, (SELECT cos(radians(8.0::DOUBLE)) AS k)),
d AS (SELECT cell, min(sqrt(power(px - (ax + t * (bx - ax)), 2) + power(py - (ay + t * (by_ - ay)), 2))) * 111.32 AS d FROM (SELECT *, least(greatest(((px - ax) * (bx - ax) + (py - ay) * (by_ - ay)) / (power(bx - ax, 2) + power(by_ - ay, 2)), 0), 1) AS t
  FROM (SELECT cell, lon * cos(radians(8.0::DOUBLE)) AS px, lat AS py FROM spots), s) GROUP BY cell)
SELECT cell, {sr('d','dist_line_km')} FROM d""")
def distance_to_coastline(spark, sf):
    st = X.stations(spark, sf)
    segs = st.select(F.col("lon").alias("x1"), F.col("lat").alias("y1"), (F.col("lon") + 0.31).alias("x2"), (F.col("lat") + 0.17).alias("y2"))
    return spatial.distance_to_lines(cell_spots(spark, sf), segs, ["cell"], 8.0).select("cell", r("dist_line_km"))


ROADS = "roads AS (SELECT lon AS x1, lat AS y1, lon + ((cell % 7) - 3) * 0.013 AS x2, lat + ((cell % 5) - 2) * 0.011 AS y2 FROM spots)"


def road_segments(spark, sf):
    c = cell_spots(spark, sf)
    return c.select(F.col("lon").alias("x1"), F.col("lat").alias("y1"), (F.col("lon") + (F.pmod("cell", F.lit(7)) - 3) * 0.013).alias("x2"), (F.col("lat") + (F.pmod("cell", F.lit(5)) - 2) * 0.011).alias("y2"))


@query("L15 K3", X.with_(CSPOTS, ROADS) + f""", l AS (SELECT *, sqrt(power((x2 - x1) * 111.32 * cos(radians(y1)), 2) + power((y2 - y1) * 111.32, 2)) AS len FROM roads), k AS (SELECT *, greatest(1, CAST(floor(len / 0.05) AS INTEGER)) AS k FROM l),
p AS (SELECT *, (o + 0.5) / k AS t FROM k, LATERAL (SELECT unnest(range(k)) AS o)), b AS (SELECT CAST(floor((11.2 - (y1 + (y2 - y1) * t)) / 0.01) AS BIGINT) AS row, CAST(floor((x1 + (x2 - x1) * t - (-3.3)) / 0.01) AS BIGINT) AS col, len / k AS part FROM p)
SELECT row, col, {sr('sum(part)','length_km')} FROM b WHERE row BETWEEN 0 AND 649 AND col BETWEEN 0 AND 454 GROUP BY ALL""")
def road_length_per_cell(spark, sf):
    return spatial.road_length(road_segments(spark, sf), P.GRID_LON_MIN, P.GRID_LAT_MAX, P.GRID_ROWS, P.GRID_COLS).select("row", "col", r("length_km"))


GRID = "grid AS (SELECT c_custkey // 50 AS row, c_custkey % 50 AS col, c_acctbal AS v FROM customer)"


def customer_grid(spark, sf):
    return X.table(spark, sf, "customer").select(F.floor(F.col("c_custkey") / 50).alias("row"), F.pmod("c_custkey", F.lit(50)).alias("col"), F.col("c_acctbal").alias("v"))


@query("L16", X.with_(GRID) + f"SELECT a.row, a.col, {sr('least(coalesce(min(sqrt(power(a.row - b.row, 2) + power(a.col - b.col, 2))) * 1.1132, 100.0), 100.0)','dist_road')} FROM grid a LEFT JOIN grid b ON b.v > 9800 GROUP BY ALL")
def distance_to_road_cell(spark, sf):
    g = customer_grid(spark, sf)
    return spatial.nearest_occupied_cell(g, g.where("v > 9800"), cap_km=100.0).select("row", "col", r("dist_road"))


def _smooth_sql(km: float, alias: str) -> str:
    w = spatial.gaussian_weights(km / 1.1132)
    rad = len(w) // 2
    vals = ", ".join(f"({k - rad}, {x!r}::DOUBLE)" for k, x in enumerate(w))
    return f"""w_{alias}(o, w) AS (VALUES {vals}), r1_{alias} AS (SELECT g.row, g.col, sum(n.v * w) AS v FROM grid g, w_{alias}, (SELECT max(row) AS mr FROM grid) JOIN grid n ON n.col = g.col AND n.row = least(greatest(g.row + o, 0), mr) GROUP BY ALL),
{alias} AS (SELECT g.row, g.col, sum(n.v * w) AS {alias} FROM grid g, w_{alias} JOIN r1_{alias} n ON n.row = g.row AND n.col = least(greatest(g.col + o, 0), 49) GROUP BY ALL)"""


@query("L14", X.with_(GRID, _smooth_sql(3, "s3")) + f"SELECT row, col, {sr('s3','s3')}, {sr('v - s3','relative')} FROM grid JOIN s3 USING (row, col)")
def gaussian_neighbourhood(spark, sf):
    g = customer_grid(spark, sf)
    rows = g.agg(F.max("row") + 1).first()[0]
    s = spatial.gaussian_smooth(g.select("row", "col", F.col("v").alias("s3")), ["s3"], 3.0, rows, 50, block=8)
    return g.join(s, ["row", "col"]).select("row", "col", r("s3"), r(F.col("v") - F.col("s3"), alias="relative"))


_CLASSES = "SELECT c_custkey // 250 AS row, (c_custkey % 50) // 5 AS col, CASE WHEN c_nationkey < 3 THEN 0 ELSE c_nationkey % 10 * 10 END AS code FROM customer"


@query("E37", "SELECT row, col, " + ", ".join(f"round(CASE WHEN count(*) FILTER (code > 0) > 0 THEN count(*) FILTER (code = {k}) / greatest(count(*) FILTER (code > 0), 1) ELSE {1.0 if n == 'water' else 0.0} END, 6) + 0.0 AS lc_{n}" for k, n in P.LAND_COVER.items()) + f" FROM ({_CLASSES}) GROUP BY ALL")
def land_cover_fractions(spark, sf):
    c = X.table(spark, sf, "customer")
    p = c.select(F.floor(F.col("c_custkey") / 50).alias("y"), F.pmod("c_custkey", F.lit(50)).alias("x"), F.when(F.col("c_nationkey") < 3, 0).otherwise(F.col("c_nationkey") % 10 * 10).alias("code"))
    f = spatial.class_fractions(p, 5, P.LAND_COVER)
    return f.select("row", "col", *[(F.round(f"lc_{n}", 6) + 0.0).alias(f"lc_{n}") for n in P.LAND_COVER.values()])


@query("E38 I22", f"SELECT cell, {sr('max(v)','overlay')}, {sr('quantile_cont(v, 0.5)','median')} FROM (SELECT o_custkey AS cell, month(o_orderdate) % 4 AS layer, avg(o_totalprice) / 1000 AS v FROM orders GROUP BY ALL) GROUP BY cell")
def raster_overlay(spark, sf):
    """Largest value of overlapping layers and the median over the four monthly ones."""
    o = X.table(spark, sf, "orders")
    layers = o.groupBy(F.col("o_custkey").alias("cell"), (F.month("o_orderdate") % 4).alias("layer")).agg((F.avg("o_totalprice") / 1000).alias("v"))
    top = spatial.overlay_max(layers, ["cell"], "v")
    med = layers.groupBy("cell").agg(F.percentile("v", F.lit(0.5)).alias("median"))  # four layers per cell
    return top.join(med, "cell").select("cell", r("v", alias="overlay"), r("median"))


# ---- orbit catalogue: orders as granules of a day -------------------------------
def granules(spark, sf):
    o = X.table(spark, sf, "orders")
    t = F.pmod("o_orderkey", F.lit(1440)) * 1.0
    return o.select(F.to_date("o_orderdate").alias("day"), F.concat(F.lit("g"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("key"), t.alias("minute"), (t + 0.7).alias("t_min"),
                    (F.lit(-85.0) + X._frac("o_orderkey", 7919, 10007) * 170.0).alias("nadir_lat"), (F.lit(-180.0) + X._frac("o_orderkey", 104729, 10007) * 360.0).alias("nadir_lon"), (F.col("o_custkey") % 2 == 0).alias("ascending"))


_I = "radians(98.72::DOUBLE)"
_U = "CASE WHEN ascending THEN degrees(asin(s)) ELSE 180.0 - degrees(asin(s)) END"
GRAN = f"""g AS (SELECT o_orderdate::DATE AS day, 'g' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS key, (o_orderkey % 1440) * 1.0::DOUBLE AS minute, (o_orderkey % 1440) + 0.7::DOUBLE AS t_min, -85.0::DOUBLE + ((o_orderkey * 7919) % 10007) / 10007.0::DOUBLE * 170.0::DOUBLE AS nadir_lat,
  -180.0::DOUBLE + ((o_orderkey * 104729) % 10007) / 10007.0::DOUBLE * 360.0::DOUBLE AS nadir_lon, o_custkey % 2 = 0 AS ascending FROM orders),
u AS (SELECT *, {_U} AS u FROM (SELECT *, sin(radians(nadir_lat)) / sin({_I}) AS s FROM g) WHERE abs(s) <= 1),
nodes AS (SELECT *, nadir_lon - degrees(atan2(cos({_I}) * sin(radians(u)), cos(radians(u)))) + {P.EARTH_ROTATION!r}::DOUBLE * (t_min - node_t) AS node_lon FROM (SELECT *, t_min - u / 360.0 * 101.44 AS node_t FROM u))"""
ORBITS = f"""orbits AS (SELECT day, count(*) AS n_nodes, quantile_cont(t, 0.5) AS node_t, degrees(atan2(quantile_cont(sin(l), 0.5), quantile_cont(cos(l), 0.5))) AS node_lon FROM (
 SELECT day, node_t - k * 101.44 AS t, radians(node_lon + k * {P.EARTH_ROTATION!r}::DOUBLE * 101.44) AS l FROM (SELECT n.*, round_even((node_t - t0) / 101.44, 0) AS k FROM nodes n JOIN (SELECT day, arg_min(node_t, key) AS t0 FROM nodes GROUP BY day) USING (day))) GROUP BY day)"""


@query("L19", X.with_(GRAN, ORBITS) + f"SELECT day, n_nodes, {sr('node_t','node_t')}, {sr('node_lon','node_lon',3)} FROM orbits")
def folded_orbits(spark, sf):
    return fires.fold_orbits(fires.ascending_node(granules(spark, sf))).select("day", "n_nodes", r("node_t"), r("node_lon", 3))


def _passes_sql() -> str:
    out = []
    for o in (-0.3, 0.7, 1.7):
        t = f"(minute + {o} - node_t)"
        u = f"radians({t} * 360.0 / 101.44)"
        lat = f"degrees(asin(sin({_I}) * sin({u})))"
        raw = f"(node_lon + degrees(atan2(cos({_I}) * sin({u}), cos({u}))) - {P.EARTH_ROTATION!r}::DOUBLE * {t} + 180.0)"
        lon = f"((({raw} % 360.0) + 360.0) % 360.0 - 180.0)"
        out.append(f"({lat} > -5.0 AND {lat} < 23.5 AND greatest(0.0, -10.0 - {lon}, {lon} - 10.0) < 19.6)")
    return " OR ".join(out)


@query("L19 L20 I15", X.with_(GRAN, ORBITS) + f"SELECT day, count(*) AS n_granules, count(*) FILTER (coalesce(n_nodes, 0) < 3 OR {_passes_sql()}) AS n_selected FROM g LEFT JOIN orbits USING (day) GROUP BY day")
def selected_granules(spark, sf):
    g = granules(spark, sf)
    orbits = fires.fold_orbits(fires.ascending_node(g))
    sel = fires.select_granules(g, orbits).groupBy("day").agg(F.count(F.lit(1)).alias("n_selected"))
    return g.groupBy("day").agg(F.count(F.lit(1)).alias("n_granules")).join(sel, "day", "left").select("day", "n_granules", F.coalesce("n_selected", F.lit(0)).alias("n_selected"))


@query("L20", X.with_(GRAN) + "SELECT m AS day, key FROM (SELECT date_trunc('month', day)::DATE AS m, key, row_number() OVER (PARTITION BY date_trunc('month', day) ORDER BY key) AS rn FROM g) WHERE (rn - 1) % 50 = 0")
def probe_granules(spark, sf):
    g = granules(spark, sf).select(F.trunc("day", "month").alias("day"), "key")
    return fires.probe_sample(g)


@query("L21", X.with_(X.FIRES) + f""", d AS (SELECT date, count(*) AS n_full, count(*) FILTER (latitude > 5) AS n_sel, sum(frp) AS f_full, sum(frp) FILTER (latitude > 5) AS f_sel FROM fires GROUP BY date)
SELECT count(*) AS days, {sr('avg(n_sel / greatest(n_full, 1))','capture_count')}, {sr('avg(f_sel / greatest(f_full, 1e-6))','capture_frp')}, {sr('corr(ln(f_full), ln(f_sel))','log_frp_r')}, {sr('quantile_cont(f_sel / f_full, 0.5)','median_ratio')} FROM d WHERE f_sel > 0 AND f_full > 0""")
def fire_selection_quality(spark, sf):
    f = X.fire_rows(spark, sf)
    north = F.col("latitude") > 5
    d = f.groupBy("date").agg(F.count(F.lit(1)).alias("n_full"), F.count_if(north).alias("n_sel"), F.sum("frp").alias("f_full"), F.sum(F.when(north, F.col("frp"))).alias("f_sel")).where("f_sel > 0 and f_full > 0")
    a = d.agg(F.count(F.lit(1)).alias("days"), F.avg(F.col("n_sel") / F.greatest("n_full", F.lit(1))).alias("capture_count"), F.avg(F.col("f_sel") / F.greatest("f_full", F.lit(1e-6))).alias("capture_frp"),
              correlation(F.ln("f_full"), F.ln("f_sel")).alias("log_frp_r"))
    q = exact_quantiles(d, [], F.col("f_sel") / F.col("f_full"), {"median_ratio": 0.5})
    return a.join(F.broadcast(q)).select("days", r("capture_count"), r("capture_frp"), r("log_frp_r"), r("median_ratio"))


# ---- clusters and kriging --------------------------------------------------------
@query("L13 I3")
def city_clusters(spark, sf):
    return clusters.site_clusters(X.stations(spark, sf).select("site_id", "lat", "lon"))


@query("L7 D23", X.with_(X.STATIONS, X.SITE_DAYS, RES) + f"""SELECT bin, km, {sr('sum(prod) / count(*) / any_value(v)','corr',6)}, count(*) AS n_pairs FROM (
 SELECT CAST(len(list_filter({_EDGES}, lambda e: e <= d)) - 1 AS INTEGER) AS bin, prod FROM (
  SELECT {X.hav('a.lat','a.lon','b.lat','b.lon')} AS d, a.resid * b.resid AS prod FROM res a JOIN res b ON a.date = b.date AND a.site_id < b.site_id)) JOIN (VALUES {", ".join(f"({k}, {(a + b) / 2}::DOUBLE)" for k, (a, b) in enumerate(zip(P.CORRELOGRAM_BINS, P.CORRELOGRAM_BINS[1:])))}) c(bin, km) USING (bin), (SELECT var_pop(resid) AS v FROM res)
 GROUP BY bin, km HAVING count(*) >= 30""")
def residual_correlogram(spark, sf):
    pts = kriging.correlogram_points(residual_rows(spark, sf))
    return pts.select("bin", "km", r("corr", 6), "n_pairs")


PARAMS = {"c0": 0.6, "length": 50.0, "var": 0.12}


@query("L6 K1 M16")
def kriged_residual_surface(spark, sf):
    """Daily residuals kriged to the distinct 0.5 degree cells of the customer spots."""
    res = residual_rows(spark, sf)
    cells = cell_spots(spark, sf).select(F.floor(F.col("lat") / 0.5).alias("gi"), F.floor(F.col("lon") / 0.5).alias("gj")).distinct()
    days = res.agg(F.array_sort(F.collect_set("date")).alias("ds"))
    tgt = cells.join(F.broadcast(days)).select("gi", "gj", F.explode("ds").alias("date"), ((F.col("gi") + 0.5) * 0.5).alias("lat"), ((F.col("gj") + 0.5) * 0.5).alias("lon"))
    k = kriging.krige(tgt, res, ["gi", "gj"], ["date"], **PARAMS)
    return k.select("gi", "gj", "date", F.round("rk_mean", 6).alias("rk_mean"), F.round("rk_var", 6).alias("rk_var"))


def anomalies(spark, sf):
    res = residual_rows(spark, sf)
    off = kriging.site_offsets(res)
    a = kriging.anomalies(res.drop("resid").join(res.select("site_id", "date", F.col("resid").alias("r0")), ["site_id", "date"]), off, F.col("r0")).drop("r0")
    return a.withColumn("fold", F.pmod("site_id", F.lit(5)).cast("int")).withColumn("scheme", F.lit("site")).withColumn("extra", F.lit(0.04))


@query("L10 K1 L8")
def held_out_kriging(spark, sf):
    k = kriging.krige_held_out(anomalies(spark, sf), ["site_id"], **PARAMS)
    return k.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("rk_mean"), 6).alias("mean"), F.round(F.avg("rk_var"), 6).alias("var"))


@query("L11")
def kriging_variants(spark, sf):
    """Scores by variant and subset: no kriging, raw residuals and anomalies, each without and with a sensor-noise nugget. Raw residuals
    and anomalies have their own correlogram."""
    stations = X.stations(spark, sf).select("site_id", "country")
    a = anomalies(spark, sf)
    raw = a.drop("resid").join(residual_rows(spark, sf).select("site_id", "date", "resid"), ["site_id", "date"])
    truth = written(raw.select("site_id", "date", F.col("resid").alias("y")).join(stations, "site_id"), "variant-truth")
    fitted = {}
    for kind, df in (("raw", raw), ("anomaly", a)):
        cg = kriging.fit_correlogram(df.select("site_id", "date", "lat", "lon", "resid"))
        fitted[kind] = {k: cg[k] for k in ("c0", "length", "var")}
    runs = (("raw", raw, {"A": None, "B": "extra"}), ("anomaly", a, {"C": None, "D": "extra"}))
    kriged = [kriging.krige_held_out(df, ["site_id"], **fitted[kind], variant=True, means=extras)
              .unpivot(["site_id", "date"], list(extras), "variant", "p").select("variant", "site_id", "date", "p") for kind, df, extras in runs]
    none = truth.select(F.lit("stage1").alias("variant"), "site_id", "date", F.lit(0.0).alias("p"))
    both = reduce(DataFrame.unionByName, [none, *kriged]).join(truth, ["site_id", "date"])
    subset = F.explode(F.when(F.col("country") == "GH", F.array(F.lit("all"), F.lit("home"))).otherwise(F.array(F.lit("all"))))
    return both.withColumn("subset", subset).groupBy("variant", "subset").agg(*scores(F.exp("y"), F.exp("p"))).select("variant", "subset", "n", r("r2", 6), r("rmse", 6))


