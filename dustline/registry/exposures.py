"""Region statistics, exposure series, climatologies."""

from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions import scalars as S
from dustline.functions.quantiles import exact_quantiles
from dustline.operators import exposure, spatial
from dustline.registry import feeds as X
from dustline.registry.core import query
from dustline.registry.feeds import r, sr

STATS = X.with_(X.CELLS, X.PRODUCT, X.REGION_STATS)
METRICS = exposure.REGION_METRICS
ADM1 = ", names AS (SELECT r_regionkey AS id, r_name AS name FROM region)"


def stats(spark, sf):
    return exposure.region_stats(X.product(spark, sf))


def regional(spark, sf):
    names = X.table(spark, sf, "region").select(F.col("r_regionkey").cast("int").alias("id"), F.col("r_name").alias("name"))
    return stats(spark, sf).where("level = 'adm1'").join(F.broadcast(names), "id")


@query("E9 E10 E11 T15", STATS + "SELECT date, level, id, " + ", ".join(sr(m, m) for m in METRICS) + " FROM stats")
def region_daily_statistics(spark, sf):
    return stats(spark, sf).select("date", "level", "id", *[r(m) for m in METRICS])


@query("E23 N8 C8", STATS + f"""SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS days, {sr('avg(pop_weighted)','pop_weighted_mean')}, count(*) FILTER (pop_weighted > 35) AS days_gt35,
 {sr('avg(pop_frac_gt15)','mean_pop_frac_gt15')}, {sr('avg(pop_frac_gt35)','mean_pop_frac_gt35')} FROM stats WHERE level = 'adm0' GROUP BY ALL""")
def annual_national_exposure(spark, sf):
    a = exposure.annual_exposure(stats(spark, sf).where("level = 'adm0'"))
    return a.select("year", "days", r("pop_weighted_mean"), "days_gt35", r("mean_pop_frac_gt15"), r("mean_pop_frac_gt35"))


@query("E24 N8", STATS.rstrip() + f""", t AS (SELECT id, CAST(year(date) AS INTEGER) AS year, round(avg(pop_weighted) + {X.NUDGE}, 4) + 0.0 AS pop_weighted_mean
 FROM stats WHERE level = 'adm1' GROUP BY ALL)
SELECT i.id, y.year, pop_weighted_mean FROM (SELECT DISTINCT id FROM t) i CROSS JOIN (SELECT DISTINCT year FROM t) y LEFT JOIN t ON t.id = i.id AND t.year = y.year""")
def region_year_means(spark, sf):
    """The region by year table (one column per year that occurs) given as rows, a year without data as null."""
    wide = exposure.region_years(stats(spark, sf).where("level = 'adm1'"), "pop_weighted", X.NUDGE)
    return wide.unpivot("id", [c for c in wide.columns if c != "id"], "year", "pop_weighted_mean").withColumn("year", F.col("year").cast("int"))


_NORTH = "('AFRICA', 'ASIA')"


@query("E25 F4 F5", STATS.rstrip() + ADM1 + f""", g AS (SELECT date, CASE WHEN name IN {_NORTH} THEN 'North' ELSE 'South & middle belt' END AS grp, sum(pop_weighted * population) / nullif(sum(population), 0) AS pop_weighted
 FROM stats JOIN names USING (id) WHERE level = 'adm1' GROUP BY ALL)
SELECT date, grp, {sr('pop_weighted','pop_weighted')}, {sr('CASE WHEN count(pop_weighted) OVER w >= 10 THEN avg(pop_weighted) OVER w END','mean_30')}
FROM g WINDOW w AS (PARTITION BY grp ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def north_south_gradient(spark, sf):
    g = exposure.north_south(regional(spark, sf), north=("AFRICA", "ASIA"))
    t = exposure.trailing_mean(g, ["grp"], "pop_weighted", 30, 10, "mean_30")
    return t.select("date", "grp", r("pop_weighted"), r("mean_30"))


@query("E26", STATS + f"SELECT id, CAST(year(date) AS INTEGER) AS year, count(pop_weighted) AS n_days, CASE WHEN count(pop_weighted) >= 60 THEN round(avg(CAST(pop_weighted > 35 AS INTEGER)) + {X.NUDGE}, 6) END AS share_gt35 FROM stats WHERE level = 'adm2' GROUP BY ALL")
def regional_exceedance_share(spark, sf):
    e = exposure.exceedance_share(stats(spark, sf).where("level = 'adm2'"))
    return e.select("id", "year", "n_days", F.round(F.col("share_gt35") + X.NUDGE, 6).alias("share_gt35"))


@query("E27", STATS + f"SELECT id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n_days, {sr('avg(pop_weighted)','month_mean')}, {sr('CASE WHEN count(*) >= 10 THEN avg(pop_weighted) END','clim_mean')} FROM stats WHERE level = 'adm2' GROUP BY ALL")
def monthly_climatology(spark, sf):
    m = exposure.month_climatology(stats(spark, sf).where("level = 'adm2'"), ["id"], "pop_weighted")
    return m.select("id", "year", "month", "n_days", r("month_mean"), r("clim_mean"))


PARTIALS = """, dpm AS (SELECT date_trunc('month', date)::DATE AS month, count(DISTINCT date) AS n FROM product GROUP BY 1),
partials AS (SELECT date_trunc('month', date)::DATE AS month, row, col, coalesce(sum(pm25), 0.0) AS s FROM product GROUP BY ALL)"""


@query("B11", X.with_(X.CELLS, X.PRODUCT).rstrip() + PARTIALS + f" SELECT month, row, col, {sr('s / n','mean',6)}, n FROM partials JOIN dpm USING (month)")
def monthly_mean_grid(spark, sf):
    m = exposure.monthly_partials(X.product(spark, sf))
    return m.select("month", "row", "col", r(F.col("s") / F.col("n"), 6, "mean"), "n")


@query("B12", X.with_(X.CELLS, X.PRODUCT).rstrip() + PARTIALS + f", dpy AS (SELECT year(month) AS year, sum(n) AS n FROM dpm GROUP BY 1) SELECT CAST(year AS INTEGER) AS year, row, col, {sr('sum(s) / any_value(n)','mean',6)}, CAST(any_value(n) AS BIGINT) AS n FROM (SELECT year(month) AS year, row, col, s FROM partials) JOIN dpy USING (year) GROUP BY ALL")
def annual_mean_grid(spark, sf):
    a = exposure.annual_from_partials(exposure.monthly_partials(X.product(spark, sf)))
    return a.select("year", "row", "col", r("mean", 6), "n")


@query("E28", X.with_(X.CELLS, X.PRODUCT).rstrip() + PARTIALS + f" SELECT CASE WHEN month(month) IN (12,1,2) THEN 'DJF' WHEN month(month) IN (3,4,5) THEN 'MAM' WHEN month(month) IN (6,7,8) THEN 'JJA' ELSE 'SON' END AS season, row, col, {sr('avg(s / n)','season_mean',6)} FROM partials JOIN dpm USING (month) GROUP BY ALL")
def seasonal_mean_grid(spark, sf):
    m = exposure.monthly_partials(X.product(spark, sf)).withColumn("mean", F.col("s") / F.col("n"))
    return exposure.seasonal_means(m, ["row", "col"]).select("season", "row", "col", r("season_mean", 6))


@query("B7 D7", STATS + f"""SELECT level, id, date, {sr('pop_weighted','pop_weighted')}, {sr('pop_frac_gt35','pop_frac_gt35')}
FROM (SELECT * FROM (SELECT DISTINCT level, id FROM stats WHERE level <> 'adm0'), (SELECT DISTINCT date FROM stats)) LEFT JOIN stats USING (level, id, date)""")
def gap_aware_region_series(spark, sf):
    s = stats(spark, sf)
    ids = s.where("level <> 'adm0'").select("level", "id").distinct()
    out = exposure.spine_join(s, s.select("date"), ids)
    return out.select("level", "id", "date", r("pop_weighted"), r("pop_frac_gt35"))


@query("B7 T15", STATS + f"""SELECT level, id, CAST(count(*) AS BIGINT) AS n_dates, count(pw) AS n_valid, {sr('sum(pw)','pw_sum',2)}, string_agg(coalesce(CAST(CAST(round(pw * 10) AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY date) AS series
FROM (SELECT level, id, date, round(pop_weighted + {X.NUDGE}, 1) AS pw FROM (SELECT * FROM (SELECT DISTINCT level, id FROM stats WHERE level = 'adm1'), (SELECT DISTINCT date FROM stats)) LEFT JOIN stats USING (level, id, date)) GROUP BY ALL""")
def region_series_arrays(spark, sf):
    s = stats(spark, sf).withColumn("pop_weighted", F.col("pop_weighted") + X.NUDGE)
    ids = s.where("level = 'adm1'").select("level", "id").distinct().withColumn("name", F.col("id").cast("string"))
    d = exposure.dense_series(s, s.select("date"), ids, {"pop_weighted": 1})
    v = F.col("pop_weighted")
    text = F.transform(v, lambda x: F.coalesce(F.round(x * 10).cast("long").cast("string"), F.lit("-")))
    return d.select("level", "id", F.size("dates").cast("long").alias("n_dates"),
                    F.size(F.array_compact(v)).cast("long").alias("n_valid"),
                    r(F.aggregate(F.array_compact(v), F.lit(0.0), lambda a, x: a + x), 2, "pw_sum"), F.array_join(text, ",").alias("series"))


@query("F4 N12", STATS + f"""SELECT level, id, date, {sr('CASE WHEN count(pop_weighted) OVER w >= 4 THEN avg(pop_weighted) OVER w END','trend')} FROM (
 SELECT level, id, date, pop_weighted FROM (SELECT * FROM (SELECT DISTINCT level, id FROM stats WHERE level IN ('adm0', 'adm1')), (SELECT DISTINCT date FROM stats)) LEFT JOIN stats USING (level, id, date))
WINDOW w AS (PARTITION BY level, id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def smoothed_region_trend(spark, sf):
    s = stats(spark, sf)
    ids = s.where("level in ('adm0', 'adm1')").select("level", "id").distinct()
    t = exposure.trailing_mean(exposure.spine_join(s, s.select("date"), ids), ["level", "id"], "pop_weighted", 7, 4, "trend")
    return t.select("level", "id", "date", r("trend"))


@query("F5", STATS + f"SELECT date, {sr('CASE WHEN count(*) OVER w >= 3 THEN avg(lower90) OVER w END','lower_7')}, {sr('CASE WHEN count(*) OVER w >= 3 THEN avg(upper90) OVER w END','upper_7')} FROM stats WHERE level = 'adm0' WINDOW w AS (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)")
def national_interval_band(spark, sf):
    s = stats(spark, sf).where("level = 'adm0'")
    s = exposure.trailing_mean(s, ["level"], "lower90", 7, 3, "lower_7")
    s = exposure.trailing_mean(s, ["level"], "upper90", 7, 3, "upper_7")
    return s.select("date", r("lower_7"), r("upper_7"))


@query("F10 N9 N11", STATS.rstrip() + ADM1 + f""", day AS (SELECT max(date) AS d FROM stats WHERE level = 'adm0')
SELECT s.id, name, CAST(rank() OVER (ORDER BY pop_weighted DESC) AS INTEGER) AS rank, {sr('pop_weighted','pop_weighted')}, {sr('lower90','lower90')}, {sr('upper90','upper90')}, {sr('pop_frac_gt35','pop_frac_gt35')}
FROM stats s JOIN names USING (id), day WHERE level = 'adm1' AND date = d""")
def region_table_of_last_day(spark, sf):
    from pyspark.sql import Window as W
    s = regional(spark, sf)
    day = X.product(spark, sf).where("pm25 is not null").agg(F.max("date").alias("d"))
    t = s.join(F.broadcast(day), F.col("date") == F.col("d"))
    rank = F.rank().over(W.partitionBy("date").orderBy(F.col("pop_weighted").desc()))
    return t.select("id", "name", rank.alias("rank"), r("pop_weighted"), r("lower90"), r("upper90"), r("pop_frac_gt35"))


@query("N9 F10", STATS.rstrip() + ADM1 + f""", top AS (SELECT date, arg_max(name, pop_weighted) AS top_region, max(pop_weighted) AS top_value FROM stats JOIN names USING (id) WHERE level = 'adm1' GROUP BY date)
SELECT date, {sr('pop_weighted','pop_weighted')}, {sr('lower90','lower90')}, {sr('upper90','upper90')}, {sr('pop_frac_gt15','pop_frac_gt15')}, {sr('pop_frac_gt35','pop_frac_gt35')}, top_region, {sr('top_value','top_value')}
FROM stats JOIN top USING (date) WHERE level = 'adm0'""")
def daily_headline(spark, sf):
    top = regional(spark, sf).groupBy("date").agg(F.max_by("name", "pop_weighted").alias("top_region"), F.max("pop_weighted").alias("top_value"))
    nat = stats(spark, sf).where("level = 'adm0'")
    return nat.join(top, "date").select("date", r("pop_weighted"), r("lower90"), r("upper90"), r("pop_frac_gt15"), r("pop_frac_gt35"), "top_region", r("top_value"))


@query("E35", STATS + f"SELECT arg_max(date, pop_weighted) FILTER (month(date) IN (12,1,2)) AS dry_day, {sr('max(pop_weighted) FILTER (month(date) IN (12,1,2))','dry_value')}, arg_min(date, pop_weighted) FILTER (month(date) IN (6,7,8,9)) AS wet_day, {sr('min(pop_weighted) FILTER (month(date) IN (6,7,8,9))','wet_value')} FROM stats WHERE level = 'adm0'")
def season_extreme_days(spark, sf):
    n = stats(spark, sf).where("level = 'adm0'")
    dry, wet, v = F.month("date").isin(12, 1, 2), F.month("date").isin(6, 7, 8, 9), F.col("pop_weighted")
    return n.agg(F.max_by("date", F.when(dry, v)).alias("dry_day"), F.max(F.when(dry, v)).alias("dry_value"),
                 F.min_by("date", F.when(wet, v)).alias("wet_day"), F.min(F.when(wet, v)).alias("wet_value")).select(
        "dry_day", r("dry_value"), "wet_day", r("wet_value"))


@query("E36", X.with_(X.CELLS, X.PRODUCT) + "SELECT adm1_id, count(pm25) AS n, " + ", ".join(sr(f"quantile_cont(pm25, {q})", f"p{int(q * 100):02d}") for q in (.02, .05, .95, .98)) + " FROM product WHERE pm25 IS NOT NULL GROUP BY adm1_id")
def regional_value_range(spark, sf):
    p = X.product(spark, sf).where("pm25 is not null")
    q = exact_quantiles(p, ["adm1_id"], F.col("pm25"), {"p02": .02, "p05": .05, "p95": .95, "p98": .98})
    return q.join(p.groupBy("adm1_id").agg(F.count("pm25").alias("n")), "adm1_id").select("adm1_id", "n", *[r(c) for c in ("p02", "p05", "p95", "p98")])


@query("F11", "SELECT CAST(ts AS DATE) AS date, count(DISTINCT user_id) AS n_sites FROM events WHERE date_diff('day', CAST(ts AS DATE), DATE '2024-01-29') BETWEEN 0 AND 3 GROUP BY 1 ORDER BY 2 DESC, 1 DESC LIMIT 1")
def best_reported_day(spark, sf):
    e = X.table(spark, sf, "events").select(F.to_date("ts").alias("date"), F.col("user_id").alias("site_id"))
    return exposure.best_station_day(e, F.lit("2024-01-29").cast("date"))


@query("B4 B5", X.with_(X.CELLS, X.PRODUCT) + f"""SELECT date, brow, bcol, {sr('pm25','pm25')}, CAST(CASE WHEN pm25 IS NULL THEN 65535 ELSE least(greatest(round_even(pm25 * 10 + {X.NUDGE}, 0), 0), 65534) END AS INTEGER) AS packed
FROM (SELECT date, row // 5 AS brow, col // 5 AS bcol, avg(pm25) AS pm25 FROM product, (SELECT max(row) + 1 AS nr FROM cells) WHERE row < (nr // 5) * 5 AND col < 50 GROUP BY ALL)""")
def coarse_block_cube(spark, sf):
    from dustline.sinks.products import cube_value
    p = X.product(spark, sf)
    rows = X.cells(spark, sf).agg(F.max("row") + 1).first()[0]
    c = spatial.coarse_mean(p, "pm25", rows, 50)
    return c.select("date", "brow", "bcol", r("pm25"), cube_value(F.col("pm25") + X.NUDGE / 10).alias("packed"))


@query("E30 N5 E13", X.with_(X.STATIONS, X.SITE_DAYS, "cities AS (SELECT * FROM (VALUES " + ", ".join(f"({k}, {4.9 + 1.25 * (k % 5)}::DOUBLE, {-3.1 + 0.9 * (k // 5)}::DOUBLE)" for k in range(25)) + ") t(city, clat, clon))")
       + f""", m AS (SELECT city, date, avg(d.pm25) AS obs, avg(d.rh / 2) AS ours, count(DISTINCT site_id) AS n_sites FROM cities, stations JOIN site_days d USING (site_id) WHERE {X.hav('clat','clon','lat','lon')} < 15 GROUP BY ALL)
SELECT city, count(*) AS days, {sr('avg(obs)','mean_obs')}, {sr('corr(obs, ours)','r')}, {sr('1 - sum((ours-obs)*(ours-obs)) / (var_pop(obs) * count(*))','r2')}, {sr('sqrt(avg((ours-obs)*(ours-obs)))','rmse')}, {sr('avg(ours-obs)','bias')}, CAST(max(n_sites) AS BIGINT) AS n_sites FROM m GROUP BY city HAVING count(*) >= 30""")
def city_product_comparison(spark, sf):
    from dustline.functions.metrics import scores
    from dustline.operators.neighbours import within_km
    cities = spark.createDataFrame([(k, 4.9 + 1.25 * (k % 5), -3.1 + 0.9 * (k // 5)) for k in range(25)], "city int, ref_lat double, ref_lon double")
    members = within_km(X.stations(spark, sf).select("site_id", "lat", "lon"), cities, P.CITY_RADIUS_KM, strict=True).select("site_id", "city")
    d = X.site_days(spark, sf).join(members, "site_id").groupBy("city", "date").agg(
        F.avg("pm25").alias("obs"), F.avg(F.col("rh") / 2).alias("ours"), F.count_distinct("site_id").alias("n_sites"))
    s = d.groupBy("city").agg(*scores(F.col("obs"), F.col("ours")), F.max("n_sites").alias("n_sites")).where("n >= 30")
    return s.select("city", F.col("n").alias("days"), r("mean_obs"), r("r"), r("r2"), r("rmse"), r("mb", alias="bias"), "n_sites")
