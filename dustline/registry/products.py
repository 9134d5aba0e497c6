"""Packing, station payloads, manifests, asset lists."""

from pyspark.sql import functions as F

from dustline.functions import scalars as S
from dustline.operators import spatial, tables
from dustline.registry import feeds as X
from dustline.registry.core import query
from dustline.registry.feeds import r, sr
from dustline.session import fresh_path
from dustline.sinks import products as K

N = X.NUDGE


def nudged(spark, sf):
    """Product values moved off rounding ties."""
    p = X.product(spark, sf)
    return p.withColumns({c: F.col(c) + N for c in K.PACKED})


NUDGED = f"prod AS (SELECT * REPLACE (pm25 + {N} AS pm25, lower90 + {N} AS lower90, upper90 + {N} AS upper90, stage1 + {N} AS stage1, cams_pm25 + {N} AS cams_pm25) FROM product)"


def short_axis(spark, sf):
    """Product on the sixty-day axis the lattices use: every cell's orders of a day, averaged."""
    o = X.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("cell"), X.order_day().alias("date")).agg(F.avg("o_totalprice").alias("p"))
    return o.select("date", F.floor(F.col("cell") / 50).alias("row"), F.pmod("cell", F.lit(50)).alias("col"),
                    F.when(F.pmod("cell", F.lit(37)) != 0, F.col("p") / 7000.0 + N).alias("pm25"),
                    *[(F.col("p") / k + N).alias(c) for c, k in (("lower90", 9000.0), ("upper90", 4000.0), ("stage1", 7300.0), ("cams_pm25", 8100.0))])


SHORT = f"""prod AS (SELECT date, cell // 50 AS row, cell % 50 AS col, CASE WHEN cell % 37 <> 0 THEN p / 7000.0 + {N} END AS pm25, p / 9000.0 + {N} AS lower90, p / 4000.0 + {N} AS upper90,
  p / 7300.0 + {N} AS stage1, p / 8100.0 + {N} AS cams_pm25 FROM (SELECT o_custkey AS cell, {X.ORDER_DAY} AS date, avg(o_totalprice) AS p FROM orders GROUP BY ALL))"""


@query("B1 T14 I24", X.with_(SHORT) + "SELECT date, row, col, " + ", ".join(f"coalesce(CAST(round_even({c} * 10, 0) AS SMALLINT), CAST(-32768 AS SMALLINT)) AS {c}" for c in K.PACKED) + " FROM prod")
def packed_daily_grid(spark, sf):
    """Packed days written to daily partitions and read back."""
    path = fresh_path(spark, "daily-grid")
    K.write_days(K.pack_day(short_axis(spark, sf)).select("date", "row", "col", *K.PACKED), path)
    return K.read_days(spark, path).select("date", "row", "col", *K.PACKED)


@query("B2 B3 I24", X.with_(X.CELLS, X.PRODUCT, NUDGED) + """, enc AS (SELECT date, cell, row, col, CAST(CASE WHEN pm25 IS NULL THEN 0 ELSE least(greatest(round_even(pm25*10,0),0),65535) END AS INTEGER) AS v,
  CASE WHEN pm25 IS NULL THEN 0 WHEN inside_aoa = 1 THEN 2 ELSE 1 END AS code,
  CAST(CASE WHEN pm25 IS NULL THEN 0 ELSE least(greatest(round_even(lower90/pm25*250,0),0),255) END AS INTEGER) AS lo_ratio,
  CAST(CASE WHEN pm25 IS NULL THEN 0 ELSE least(greatest(round_even(upper90/pm25*40,0),0),255) END AS INTEGER) AS hi_ratio,
  CAST(CASE WHEN pm25 IS NULL THEN 0 ELSE least(greatest(round_even(cams_pm25,0),0),255) END AS INTEGER) AS cams FROM prod)
SELECT date, cell, v >> 8 AS hi, v & 255 AS lo, code, lo_ratio, hi_ratio, cams, CASE WHEN code <> 0 THEN v / 10.0::DOUBLE END AS pm25_d,
 round(CASE WHEN code <> 0 THEN v / 10.0::DOUBLE * lo_ratio / 250 END, 6) AS lower90_d, round(CASE WHEN code <> 0 THEN v / 10.0::DOUBLE * hi_ratio / 40 END, 6) AS upper90_d, CASE WHEN code <> 0 THEN cams END AS cams_d FROM enc""")
def encoded_and_decoded_day(spark, sf):
    d = K.decode_day(K.encode_day(nudged(spark, sf)))
    return d.select("date", "cell", "hi", "lo", "code", "lo_ratio", "hi_ratio", "cams", "pm25_d", F.round("lower90_d", 6).alias("lower90_d"),
                    F.round("upper90_d", 6).alias("upper90_d"), "cams_d")


@query("B10 C10", X.with_(X.CELLS, X.PRODUCT, NUDGED) + """SELECT date, printf('%.3f', 11.2 - (row + 0.5) * 0.01) AS lat, printf('%.3f', -3.3 + (col + 0.5) * 0.01) AS lon,
 round_even(pm25 * 10, 0) / 10 AS pm25, CAST(inside_aoa AS INTEGER) AS inside_aoa FROM prod WHERE pm25 IS NOT NULL""")
def cell_text_rows(spark, sf):
    rows = K.cell_rows(K.decode_day(K.encode_day(nudged(spark, sf))))
    return rows.select("date", "lat", "lon", "pm25", "inside_aoa")


@query("C8 C9 C10", X.with_(X.CELLS, X.PRODUCT) + f"SELECT date, cell, {sr('(upper90 - lower90) / pm25','relative_uncertainty')}, {sr('pm25 - cams_pm25','difference')}, pm25 > 15 AS over_who, pm25 > 35 AS over_national FROM product WHERE pm25 > 0 AND inside_aoa = 1")
def map_layers(spark, sf):
    p = X.product(spark, sf).where("pm25 > 0 and inside_aoa = 1")
    return p.select("date", "cell", r((F.col("upper90") - F.col("lower90")) / F.col("pm25"), alias="relative_uncertainty"),
                    r(F.col("pm25") - F.col("cams_pm25"), alias="difference"), S.exceeds(F.col("pm25"), 15.0).alias("over_who"),
                    S.exceeds(F.col("pm25"), 35.0).alias("over_national"))


@query("B8 D2", X.with_(X.STATIONS, X.SITE_DAYS) + f"""SELECT site_id, count(*) AS n_days, CAST(min(date) AS VARCHAR) AS first_day, string_agg(CAST(CAST(round(pm25 * 10 + {N}) AS BIGINT) AS VARCHAR), ',' ORDER BY date) AS series,
 string_agg(coalesce(CAST(CAST(round(pred * 10 + {N}) AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY date) AS predicted
FROM (SELECT d.site_id, d.date, d.pm25, CASE WHEN d.site_id % 3 <> 0 THEN d.rh / 2 END AS pred FROM site_days d JOIN stations USING (site_id)) GROUP BY site_id""")
def station_series(spark, sf):
    """Per-station series as arrays, sorted by date; a station has one value per calendar day."""
    d = X.site_days(spark, sf)
    oof = d.where(F.pmod("site_id", F.lit(3)) != 0).select("site_id", "date", (F.col("rh") / 2).alias("pred"))
    j = d.join(X.stations(spark, sf).select("site_id"), "site_id").join(oof, ["site_id", "date"], "left")
    g = j.groupBy("site_id").agg(F.array_sort(F.collect_list(F.struct("date", "pm25", "pred"))).alias("s"))
    text = lambda f: F.array_join(F.transform("s", lambda x: F.coalesce(F.round(x[f] * 10 + N).cast("long").cast("string"), F.lit("-"))), ",")
    return g.select("site_id", F.size("s").cast("long").alias("n_days"), F.col("s")[0]["date"].cast("string").alias("first_day"),
                    text("pm25").alias("series"), text("pred").alias("predicted"))


@query("B9 G1", X.with_(X.CELLS, X.PRODUCT, X.REGION_STATS) + f"SELECT CAST(date AS VARCHAR) AS date, level, id, {sr('area_mean','area_mean')}, {sr('pop_weighted','pop_weighted')}, {sr('max','max')} FROM stats")
def region_statistics_file(spark, sf):
    """Sorted CSV of the daily region statistics, written and read back."""
    from dustline.operators.exposure import region_stats
    path = fresh_path(spark, "region-stats")
    s = region_stats(X.product(spark, sf)).select(F.col("date").cast("string").alias("date"), "level", "id", r("area_mean"), r("pop_weighted"), r("max"))
    s.orderBy("date", "level", "id").write.option("header", True).csv(path)
    return spark.read.schema("date string, level string, id int, area_mean double, pop_weighted double, max double").option("header", True).csv(path)


@query("B13 I13", """SELECT o_orderdate::DATE AS day, string_agg(DISTINCT strftime(d, '%Y-%m'), ',' ORDER BY strftime(d, '%Y-%m')) AS months FROM (
 SELECT DISTINCT o_orderdate, unnest(range(o_orderdate::TIMESTAMP - INTERVAL 10 DAY, o_orderdate::TIMESTAMP + INTERVAL 2 DAY, INTERVAL 1 DAY)) AS d FROM orders) GROUP BY 1""")
def touched_months(spark, sf):
    o = X.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return o.select("day", F.array_join(tables.touched_months(F.col("day")), ",").alias("months"))


def assets(spark, sf):
    o = X.table(spark, sf, "orders")
    d = F.to_date("o_orderdate")
    k = F.pmod("o_orderkey", F.lit(6))
    name = (F.when(k == 0, F.concat(F.lit("AQ_1km_daily_"), F.date_format(d, "yyyy-MM"), F.lit(".zip")))
            .when(k == 1, F.concat(F.lit("AQ_1km_monthly_mean_"), F.date_format(d, "yyyy-MM"), F.lit(".tif")))
            .when(k == 2, F.concat(F.lit("AQ_1km_annual_mean_"), F.date_format(d, "yyyy"), F.lit(".tif")))
            .when(k == 3, "AQ_region_daily_statistics.csv").when(k == 4, "AQ_DATA_README.txt").otherwise("notes.bin"))
    return o.select(name.alias("name"), d.alias("date"))


@query("B15 I14", """SELECT kind, period, count(*) AS n, count(DISTINCT date) AS days FROM (SELECT date, CASE k WHEN 0 THEN 'daily_month' WHEN 1 THEN 'monthly_mean' WHEN 2 THEN 'annual_mean' WHEN 3 THEN 'region_stats' ELSE 'readme' END AS kind,
 CASE k WHEN 0 THEN strftime(date, '%Y-%m') WHEN 1 THEN strftime(date, '%Y-%m') WHEN 2 THEN strftime(date, '%Y') WHEN 3 THEN 'daily' ELSE '' END AS period
 FROM (SELECT o_orderkey % 6 AS k, o_orderdate::DATE AS date FROM orders) WHERE k <> 5) GROUP BY ALL""")
def asset_catalogue(spark, sf):
    kind, period = K.classify_asset(F.col("name"), "AQ_1km")
    a = assets(spark, sf).select("date", kind.alias("kind"), period.alias("period")).where("kind <> 'other'")
    return a.groupBy("kind", "period").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("date").alias("days"))


@query("B16 I26 J6", """WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events), t AS (SELECT date, CASE WHEN x < 0 THEN 'forecast' WHEN x = 0 THEN 'nowcast' WHEN x < 7 THEN 'nrt' ELSE 'final' END AS tier FROM (SELECT date, date_diff('day', date, DATE '2024-01-29') AS x FROM d)),
n AS (SELECT CAST(ts AS DATE) AS date, count(DISTINCT user_id) AS n_obs FROM events GROUP BY 1)
SELECT count(*) AS n_dates, max(date) FILTER (tier <> 'forecast') AS latest, string_agg(strftime(date, '%Y-%m-%d') || '=' || tier, ',' ORDER BY date) AS tiers, string_agg(strftime(date, '%Y-%m-%d') || '=' || n_obs, ',' ORDER BY date) AS n_obs FROM t JOIN n USING (date)""")
def product_manifest(spark, sf):
    e = X.table(spark, sf, "events")
    day = e.groupBy(F.to_date("ts").alias("date")).agg(F.count_distinct("user_id").alias("n"))
    t = day.withColumn("tier", S.product_tier(F.col("date"), F.lit("2024-01-29").cast("date")))
    pair = lambda c: F.array_join(F.array_sort(F.collect_list(F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit("="), F.col(c).cast("string")))), ",")
    return t.agg(F.count(F.lit(1)).alias("n_dates"), F.max(F.when(F.col("tier") != "forecast", F.col("date"))).alias("latest"),
                 pair("tier").alias("tiers"), pair("n").alias("n_obs"))


@query("B18", f"""WITH d AS (SELECT user_id % 10 AS code, CAST(ts AS DATE) AS date, avg(value) AS t2m FROM events GROUP BY ALL)
SELECT code, count(*) AS n, string_agg(printf('%.2f', round(t2m + {N}, 2)), ',' ORDER BY date) AS t2m FROM d WHERE date >= (SELECT max(date) FROM d) - 20 GROUP BY code""")
def recent_weather_payload(spark, sf):
    d = X.table(spark, sf, "events").groupBy(F.pmod("user_id", F.lit(10)).alias("code"), F.to_date("ts").alias("date")).agg(F.avg("value").alias("t2m"))
    last = d.agg(F.max("date").alias("_last"))
    recent = d.join(F.broadcast(last), F.col("date") >= F.date_sub("_last", 20))
    g = recent.groupBy("code").agg(F.array_sort(F.collect_list(F.struct("date", "t2m"))).alias("s"))
    return g.select("code", F.size("s").cast("long").alias("n"), F.array_join(F.transform("s", lambda x: F.format_string("%.2f", F.round(x["t2m"] + N, 2))), ",").alias("t2m"))


@query("B19", """SELECT event_id, '{"event_id":' || event_id || ',"value":' || CASE WHEN event_id % 3 = 0 THEN 'null' ELSE CAST(CAST(round(value) AS INTEGER) AS VARCHAR) END || '}' AS body FROM events""")
def json_safe_records(spark, sf):
    e = X.table(spark, sf, "events")
    v = F.when(F.col("event_id") % 6 == 0, F.lit(float("nan"))).when(F.col("event_id") % 3 == 0, F.lit(float("inf"))).otherwise(F.round("value"))
    return e.select("event_id", F.to_json(F.struct("event_id", S.finite(v).cast("int").alias("value")), {"ignoreNullFields": "false"}).alias("body"))


@query("B20 J7", """SELECT 'monitors' AS source, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_day FROM events UNION ALL SELECT 'fires', CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) FROM orders UNION ALL SELECT 'weather', CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) FROM lineitem""")
def source_freshness(spark, sf):
    out = None
    for name, t, c in (("monitors", "events", "ts"), ("fires", "orders", "o_orderdate"), ("weather", "lineitem", "l_shipdate")):
        m = X.table(spark, sf, t).agg(F.max(F.to_date(c)).cast("string").alias("last_day")).select(F.lit(name).alias("source"), "last_day")
        out = m if out is None else out.unionByName(m)
    return out


@query("B6 H3", X.with_(SHORT) + f"""SELECT date, row, col, {sr('v','pm25')} FROM (SELECT date, row, col, pm25 AS v FROM prod WHERE date < DATE '2024-02-10'
 UNION ALL SELECT date, row, col, pm25 * 2 FROM prod WHERE date >= DATE '2024-02-10')""")
def cube_upsert(spark, sf):
    """Recomputed days replace stored ones; the update is applied twice and stays the same."""
    p = short_axis(spark, sf).select("date", "row", "col", "pm25")
    path = fresh_path(spark, "cube")
    K.write_days(p.where("date < '2024-02-20'"), path)
    new = p.where("date >= '2024-02-10'").withColumn("pm25", F.col("pm25") * 2)
    for _ in range(2):
        K.write_days(new, path)
    return K.read_days(spark, path).select("date", "row", "col", r("pm25"))


@query("B14 H4", X.with_(X.CELLS, X.PRODUCT) + f"""SELECT date, cell, {sr('v','pm25')} FROM (SELECT date, cell, pm25 AS v FROM product WHERE day(date) > 10
 UNION ALL SELECT date, cell, pm25 + 100 FROM product p WHERE NOT EXISTS (SELECT 1 FROM product l WHERE l.date = p.date AND day(l.date) > 10))""")
def restored_missing_days(spark, sf):
    p = X.product(spark, sf).select("date", "cell", "pm25")
    local = p.where(F.day("date") > 10)
    out = tables.append_missing(local, p.withColumn("pm25", F.col("pm25") + 100), ["date"])
    return out.select("date", "cell", r("pm25"))
