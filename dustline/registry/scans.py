"""Landed-file scans: documents and files derived from the given tables, parsed back."""

from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions import scalars as S
from dustline.operators import fires, qc, spatial, tables
from dustline.registry import feeds as X
from dustline.registry.core import query
from dustline.registry.feeds import r, sr
from dustline.session import fresh_path
from dustline.sources import gridded, ground, history, vector, weather


def sensor_lines(spark, sf):
    """Sensor lines with offset timestamps and the columns of their folders."""
    e = X.table(spark, sf, "events")
    t = F.col("ts").cast("timestamp")
    kind = F.when(F.col("event_type") == "click", "pm25").when(F.col("event_type") == "view", "relativehumidity").when(F.col("event_type") == "error", "um003").otherwise("temperature")
    loc = F.pmod("user_id", F.lit(5)).cast("string")
    return e.select(loc.alias("location_id"), F.concat(F.lit("s"), F.pmod("user_id", F.lit(3)).cast("string")).alias("sensors_id"), F.lit("here").alias("location"),
                    F.date_format(t + F.expr("interval 1 hour"), "yyyy-MM-dd'T'HH:mm:ss'+01:00'").alias("datetime"), F.lit("5.6").alias("lat"), F.lit("-0.2").alias("lon"),
                    kind.alias("parameter"), F.lit("x").alias("units"), F.round("value", 4).cast("string").alias("value"),
                    loc.alias("locationid"), F.year(t).alias("year"), F.month(t).alias("month"), F.day(t).alias("day"))


ARCHIVE_SQL = """SELECT 'oaq_' || (user_id % 5) AS site_id, 's' || (user_id % 3) AS sensors_id, epoch(date_trunc('second', ts))::BIGINT AS sec, parameter, round(value, 4) AS value
FROM (SELECT *, CASE event_type WHEN 'click' THEN 'pm25' WHEN 'view' THEN 'relativehumidity' WHEN 'error' THEN 'um003' ELSE 'temperature' END AS parameter FROM events)
WHERE parameter <> 'um003' AND CAST(ts AS DATE) >= DATE '2024-01-{day}'"""


@query("A1 I14 I27", ARCHIVE_SQL.format(day="11"))
def sensor_archive_scan(spark, sf):
    """Daily gzip CSV files in partition folders with offset timestamps, one file a folder."""
    base = fresh_path(spark, "archive")
    folders = ["locationid", "year", "month", "day"]
    sensor_lines(spark, sf).repartition(*folders).write.partitionBy(*folders).option("header", True).option("compression", "gzip").csv(base)
    scan = ground.read_archive(spark, base, "2024-01-01").where(F.to_date("time") >= "2024-01-11")
    return scan.select("site_id", "sensors_id", F.col("time").cast("long").alias("sec"), "parameter", F.round("value", 4).alias("value"))


def dated_archive(spark, sf):
    """Month folders with one file a day, named by its date."""
    landed, base = fresh_path(spark, "landing"), fresh_path(spark, "archive")
    folders = ["locationid", "year", "month", "day"]
    sensor_lines(spark, sf).repartition(*folders).write.partitionBy(*folders).option("header", True).option("compression", "gzip").csv(landed)
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(landed).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.globStatus(path(f"{landed}/locationid=*/year=*/month=*/day=*/part-*.csv.gz")):
        parts = dict(x.split("=") for x in status.getPath().getParent().toString().split("/") if "=" in x)
        month = path(f"{base}/locationid={parts['locationid']}/year={parts['year']}/month={int(parts['month']):02d}")
        fs.mkdirs(month)
        fs.rename(status.getPath(), path(month, f"location-{parts['locationid']}-{parts['year']}{int(parts['month']):02d}{int(parts['day']):02d}.csv.gz"))
    return base


@query("A2 A1", ARCHIVE_SQL.format(day="16"))
def archive_from_start_date(spark, sf):
    """Files named by their day; those before the start are left out of the listing."""
    scan = ground.read_archive(spark, dated_archive(spark, sf), "2024-01-16")
    return scan.select("site_id", "sensors_id", F.col("time").cast("long").alias("sec"), "parameter", F.round("value", 4).alias("value"))


@query("A3 J4", """SELECT 'emb_' || lower(city) AS site_id, epoch(hr)::BIGINT AS sec, round(min(v), 4) AS value FROM (SELECT *, CASE user_id % 2 WHEN 0 THEN 'Lome' ELSE 'Accra' END AS city, date_trunc('hour', ts) AS hr, round(value, 4) AS v FROM events)
WHERE event_type <> 'error' AND (CASE WHEN city = 'Lome' THEN event_type <> 'view' ELSE true END) GROUP BY ALL""")
def reference_monitor_scan(spark, sf):
    """Monthly files for one city; for the other also a year-to-date file that replaces them."""
    e = X.table(spark, sf, "events")
    t = F.col("ts").cast("timestamp")
    city = F.when(F.pmod("user_id", F.lit(2)) == 0, "Lome").otherwise("Accra")
    cols = [city.alias("Site"), F.lit("PM2.5").alias("Parameter"), F.year(t).cast("string").alias("Year"), F.month(t).cast("string").alias("Month"), F.day(t).cast("string").alias("Day"),
            F.hour(t).cast("string").alias("Hour"), F.round("value", 4).cast("string").alias("Raw Conc."),
            F.when(F.col("event_type") == "error", "Invalid").otherwise(" Valid ").alias("QC Name")]
    base = fresh_path(spark, "reference")
    lome = e.where((city == "Lome") & (F.col("event_type") != "view"))
    lome.select(*cols).write.option("header", True).csv(f"{base}/Lome_PM2.5_2024_YTD_MTD.csv")
    e.where(city == "Lome").select(*cols).write.option("header", True).csv(f"{base}/Lome_PM2.5_2024_01_MTD.csv")
    e.where(city == "Accra").select(*cols).write.option("header", True).csv(f"{base}/Accra_PM2.5_2024_01_MTD.csv")
    spark_df = ground.read_reference(spark, f"{base}/*_MTD.csv")
    return spark_df.groupBy("site_id", F.col("time").cast("long").alias("sec")).agg(F.round(F.min("value"), 4).alias("value"))


@query("A4 A5 C2 K5 I14 H1", """SELECT 'oaq_' || c_custkey AS site_id, c_custkey AS location_id, 'Unit ' || c_custkey AS name, CASE WHEN country LIKE 'unknown%' AND lat BETWEEN 4.5 AND 11.3 AND lon BETWEEN -3.3 AND 1.3 THEN 'GH' ELSE country END AS country,
 coalesce(provider, 'Unknown') AS network, owner, round(lat, 6) AS lat, round(lon, 6) AS lon, coalesce(provider IN ('AirNow', 'StateAir Accra'), false) AS is_reference
FROM (SELECT *, CASE c_custkey % 5 WHEN 0 THEN 'AirNow' WHEN 1 THEN 'Aurassure' WHEN 2 THEN 'Clarity' WHEN 3 THEN NULL ELSE 'StateAir Accra' END AS provider, CASE c_custkey % 3 WHEN 0 THEN 'NG' WHEN 1 THEN 'unknown-1' ELSE 'CI' END AS country,
  c_mktsegment AS owner, 3.0::DOUBLE + ((c_custkey * 7919) % 1009) / 1009.0::DOUBLE * 12.0::DOUBLE AS lat, -11.0::DOUBLE + ((c_custkey * 104729) % 1013) / 1013.0::DOUBLE * 22.0::DOUBLE AS lon,
  DATE '2022-07-01' + CAST(c_custkey % 100 AS INTEGER) AS last, c_custkey % 60 AS n FROM customer)
WHERE last >= DATE '2022-08-04' AND n >= 20 AND lat BETWEEN 4 AND 13.5 AND lon BETWEEN -9 AND 9 AND NOT (country = 'NG' AND coalesce(provider = 'Aurassure', false))
UNION ALL SELECT * FROM (VALUES ('emb_accra', -1, 'US Embassy Accra (BAM-1020)', 'GH', 'US Embassy (AirNow)', 'US Department of State', 5.580642::DOUBLE, -0.170724::DOUBLE, true), ('emb_abidjan', -1, 'US Embassy Abidjan (BAM-1020)', 'CI', 'US Embassy (AirNow)', 'US Department of State', 5.36::DOUBLE, -4.0083::DOUBLE, true),
 ('emb_lome', -1, 'US Embassy Lome (BAM-1020)', 'TG', 'US Embassy (AirNow)', 'US Department of State', 6.185167::DOUBLE, 1.214166::DOUBLE, true), ('emb_ouagadougou', -1, 'US Embassy Ouagadougou (BAM-1020)', 'BF', 'US Embassy (AirNow)', 'US Department of State', 12.304907::DOUBLE, -1.497184::DOUBLE, true))""")
def station_registry(spark, sf):
    c = X.table(spark, sf, "customer")
    k5, k3 = F.pmod("c_custkey", F.lit(5)), F.pmod("c_custkey", F.lit(3))
    rows = c.select(
        F.col("c_custkey").alias("location_id"), F.concat(F.lit("Unit "), F.col("c_custkey").cast("string"), F.lit("-77")).alias("name_s3"),
        F.when(k5 == 0, "AirNow").when(k5 == 1, "Aurassure").when(k5 == 2, "Clarity").when(k5 == 4, "StateAir Accra").alias("provider"),
        F.col("c_mktsegment").alias("owner"), F.when(k3 == 0, "NG").when(k3 == 1, "unknown-1").otherwise("CI").alias("country"),
        (F.lit(3.0) + X._frac("c_custkey", 7919, 1009) * 12.0).alias("lat"), (F.lit(-11.0) + X._frac("c_custkey", 104729, 1013) * 22.0).alias("lon"),
        F.date_add(F.lit("2022-07-01").cast("date"), F.pmod("c_custkey", F.lit(100)).cast("int")).cast("string").alias("s3_last_day"),
        F.pmod("c_custkey", F.lit(60)).cast("int").alias("s3_n_days"))
    path = fresh_path(spark, "registry")
    rows.write.option("sep", "\t").option("header", True).csv(path)
    st = ground.read_registry(spark, path).unionByName(ground.reference_registry(spark))
    return st.withColumn("lat", F.round("lat", 6)).withColumn("lon", F.round("lon", 6))


def hourly_docs(spark, sf, variables, nodes=8):
    """One document per node and day, hourly arrays, from hourly event means."""
    e = X.table(spark, sf, "events")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    h = e.groupBy(F.pmod("user_id", F.lit(nodes)).alias("k"), hour.alias("h")).agg(F.round(F.avg("value"), 6).alias("v"))
    g = h.groupBy("k", F.to_date("h").alias("d")).agg(F.array_sort(F.collect_list(F.struct("h", "v"))).alias("s"))
    times = F.transform("s", lambda x: F.date_format(x["h"], "yyyy-MM-dd'T'HH:mm"))
    cols = [F.transform("s", fn).alias(name) for name, fn in variables.items()]
    return g.select("k", F.to_json(F.struct(F.struct(times.alias("time"), *cols).alias("hourly"))).alias("body"))


HOURLY_NODE = "h AS (SELECT user_id % 8 AS k, date_trunc('hour', ts) AS h, round(avg(value), 6) AS v FROM events GROUP BY ALL)"


@query("A6 E4 C6 T6 I27", X.with_(HOURLY_NODE) + f"""SELECT printf('%.2f_%.2f', 4.0 + k * 0.8, -3.2::DOUBLE) AS node, CAST(h AS DATE) AS date, {sr('avg(v)','cams_pm25')}, {sr('avg(v * 1.5)','cams_pm10')}, {sr('avg(v / 100)','cams_aod',6)}, {sr('avg(v * 0.2)','cams_dust')},
 {sr('avg(v + 100)','cams_co')}, {sr('avg(v / 3)','cams_no2')}, {sr('max(v)','cams_pm25_max')}, count(v) FILTER (hour(h) % 3 <> 1) AS cams_n FROM (SELECT k, h, CASE WHEN hour(h) % 3 <> 1 THEN v END AS v FROM h) GROUP BY ALL HAVING count(v) FILTER (hour(h) % 3 <> 1) >= 6""")
def composition_node_days(spark, sf):
    present = lambda x, y: F.when(F.hour(x["h"]) % 3 != 1, y)
    docs = hourly_docs(spark, sf, {
        "pm2_5": lambda x: present(x, x["v"]), "pm10": lambda x: present(x, x["v"] * 1.5), "aerosol_optical_depth": lambda x: present(x, x["v"] / 100),
        "dust": lambda x: present(x, x["v"] * 0.2), "carbon_monoxide": lambda x: present(x, x["v"] + 100), "nitrogen_dioxide": lambda x: present(x, x["v"] / 3)})
    docs = docs.withColumn("node", S.node_label(F.lit(4.0) + F.col("k") * 0.8, F.lit(-3.2)))
    d = qc.composition_daily(gridded.hourly_arrays(docs, ["node"], gridded.COMPOSITION_VARS), gridded.COMPOSITION_NAMES, "pm2_5").where("cams_n >= 6")
    return d.select("node", "date", r("cams_pm25"), r("cams_pm10"), r("cams_aod", 6), r("cams_dust"), r("cams_co"), r("cams_no2"), r("cams_pm25_max"), "cams_n")


@query("A8 E5 I6 I8 I10 I27", X.with_(HOURLY_NODE) + f""", d AS (SELECT k, CAST(h AS DATE) AS date, avg(20 + v / 50) AS t2m, max(20 + v / 50) - min(20 + v / 50) AS t2m_range, avg(50 + v / 20) AS rh, avg(15 + v / 60) AS td2m, sum(v / 10) AS precip, avg(v / 3.6) AS ws10,
 avg(-(v / 3.6) * sin(radians(v * 2))) AS u10, avg(-(v / 3.6) * cos(radians(v * 2))) AS v10, avg(1000 + v / 100) / 10.0 AS ps, avg(v * 3) * 24 / 1000.0 AS ssrd, avg(v) AS cloud, avg(v * 9) AS blh FROM h GROUP BY ALL)
SELECT CAST(k AS DOUBLE) AS lat, -2.5::DOUBLE AS lon, date, {sr('t2m','t2m')}, {sr('t2m_range','t2m_range')}, {sr('rh','rh')}, {sr('td2m','td2m')}, {sr('precip','precip')}, {sr('ws10','ws10')}, {sr('u10','u10')}, {sr('v10','v10')}, {sr('ps','ps')}, {sr('ssrd','ssrd')}, {sr('cloud','cloud')}, {sr('blh','blh')},
 {sr('622.0 * (6.112 * exp(17.67 * td2m / (td2m + 243.5))) / (ps * 10 - 0.378 * (6.112 * exp(17.67 * td2m / (td2m + 243.5))))','qv2m')} FROM d""")
def forecast_node_days(spark, sf):
    docs = hourly_docs(spark, sf, {
        "temperature_2m": lambda x: x["v"] / 50 + 20, "relative_humidity_2m": lambda x: x["v"] / 20 + 50, "dew_point_2m": lambda x: x["v"] / 60 + 15,
        "precipitation": lambda x: x["v"] / 10, "wind_speed_10m": lambda x: x["v"], "wind_direction_10m": lambda x: x["v"] * 2, "surface_pressure": lambda x: x["v"] / 100 + 1000,
        "shortwave_radiation": lambda x: x["v"] * 3, "cloud_cover": lambda x: x["v"], "boundary_layer_height": lambda x: x["v"] * 9})
    docs = docs.select(F.col("k").cast("double").alias("lat"), F.lit(-2.5).alias("lon"), "body")
    d = qc.forecast_daily(gridded.forecast_hours(docs))
    return d.select("lat", "lon", "date", *[r(c) for c in ("t2m", "t2m_range", "rh", "td2m", "precip", "ws10", "u10", "v10", "ps", "ssrd", "cloud", "blh", "qv2m")])


@query("A7 I9 I27", X.with_(X.MET) + f"SELECT round(lat, 3) AS lat, round(lon, 3) AS lon, date, CASE WHEN CAST(i + j AS INTEGER) % 5 = 0 THEN NULL ELSE round(t2m + 1.37e-9, 6) END AS T2M FROM met")
def weather_feature_collection(spark, sf):
    m = X.met(spark, sf)
    i, j = F.rint((F.col("lat") - 4.0) / 0.5), F.rint((F.col("lon") + 4.0) / 0.625)
    v = F.when((i + j) % 5 == 0, F.lit(-999.0)).otherwise(F.round(F.col("t2m") + X.NUDGE, 6))
    series = m.groupBy(F.round("lat", 3).alias("lat"), F.round("lon", 3).alias("lon")).agg(F.map_from_entries(F.collect_list(F.struct(F.date_format("date", "yyyyMMdd"), v))).alias("s"))
    feature = F.struct(F.struct(F.array("lon", "lat", F.lit(10.0)).alias("coordinates")).alias("geometry"), F.struct(F.create_map(F.lit("T2M"), "s").alias("parameter")).alias("properties"))
    docs = series.select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("body"))
    return gridded.met_geojson(docs, "T2M")


@query("A9 A11", """SELECT 'S' || s_suppkey AS code, CASE WHEN s_suppkey % 3 = 0 THEN 'Place ' || s_suppkey WHEN s_suppkey % 3 = 1 THEN 'Alt ' || s_suppkey ELSE 'S' || s_suppkey END AS name, CAST(s_nationkey AS DOUBLE) AS lat, s_acctbal AS lon,
 CASE WHEN s_suppkey % 2 = 0 THEN 12.5::DOUBLE END AS elev, s_suppkey % 4 <> 0 AS active FROM supplier WHERE s_suppkey % 10 <> 7""")
def weather_station_list(spark, sf):
    s = X.table(spark, sf, "supplier")
    k, t = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    entry = F.struct(F.concat(F.lit("S"), t).alias("code"), F.when(k % 3 == 1, F.concat(F.lit("Alt "), t)).alias("name"), F.when(k % 4 == 0, False).when(k % 4 == 1, True).alias("active"),
                     F.struct(F.when(k % 3 == 0, F.concat(F.lit("Place "), t)).alias("name"), F.when(k % 10 == 7, "n/a").otherwise(F.col("s_nationkey").cast("string")).alias("latitude"),
                              F.col("s_acctbal").cast("string").alias("longitude"), F.when(k % 2 == 0, "12.5").otherwise("?").alias("elevationmsl")).alias("location"))
    docs = s.select(F.to_json(F.struct(F.array(entry).alias("data"))).alias("body"))
    return weather.stations(docs).select("code", "name", "lat", "lon", "elev", "active")


@query("A11 I27", "SELECT p_brand AS shortcode, p_type AS description, 'u' || p_size AS units, count(*) AS n FROM part WHERE p_partkey % 4 <> 0 GROUP BY ALL")
def weather_variable_dictionary(spark, sf):
    p = X.table(spark, sf, "part")
    v = F.when(F.col("p_partkey") % 4 != 0, F.struct(F.col("p_brand").alias("shortcode"), F.col("p_type").alias("description"), F.concat(F.lit("u"), F.col("p_size").cast("string")).alias("units")))
    docs = p.select(F.to_json(F.struct(F.array(F.struct(v.alias("variable"))).alias("data"))).alias("body"))
    return weather.variables(docs).groupBy("shortcode", "description", "units").agg(F.count(F.lit(1)).alias("n"))


@query("A10 T16 I27", "SELECT 'W' || (user_id % 3) AS code, epoch(date_trunc('second', ts))::BIGINT AS sec, event_type AS variable, CAST(user_id % 4 AS VARCHAR) AS sensor, CASE WHEN event_id % 5 <> 0 THEN round(value, 4) END AS value FROM events")
def weather_measurement_scan(spark, sf):
    e = X.table(spark, sf, "events")
    row = F.array(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), "event_type", F.pmod("user_id", F.lit(4)).cast("string"), F.round("value", 4).cast("string"),
                  F.when(F.col("event_id") % 5 == 0, "3").otherwise("1"))
    day = e.groupBy(F.concat(F.lit("W"), F.pmod("user_id", F.lit(3)).cast("string")).alias("code"), F.date_trunc("hour", "ts").alias("h")).agg(F.collect_list(row).alias("values"))
    cols = F.array(*[F.lit(c) for c in ("time", "variable", "sensor", "value", "quality")])
    docs = day.select("code", F.to_json(F.struct(F.array(F.struct(F.array(F.struct(cols.alias("columns"), "values")).alias("series"))).alias("results"))).alias("body"))
    return weather.measurements(docs).select("code", F.col("time").cast("long").alias("sec"), "variable", "sensor", "value")


@query("A21", "SELECT user_id AS location_id, value, epoch(date_trunc('second', ts))::BIGINT AS sec FROM events")
def latest_readings_scan(spark, sf):
    e = X.table(spark, sf, "events")
    entry = F.struct(F.col("user_id").alias("locationsId"), "value", F.struct(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("utc")).alias("datetime"),
                     F.struct(F.lit(5.5).alias("latitude"), F.lit(-0.2).alias("longitude")).alias("coordinates"))
    docs = e.select(F.to_json(F.struct(F.array(entry).alias("results"))).alias("body"))
    return weather.latest_readings(docs).select("location_id", "value", F.col("time").cast("long").alias("sec"))


ARCH = """arch AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, round(2.0::DOUBLE + ((o_orderkey * 7919) % 10007) / 10007.0::DOUBLE * 15.0::DOUBLE, 5) AS latitude, round(-12.0::DOUBLE + ((o_orderkey * 104729) % 10007) / 10007.0::DOUBLE * 24.0::DOUBLE, 5) AS longitude,
  round(o_totalprice / 10000.0, 2) AS frp, o_orderpriority, o_orderstatus FROM orders)"""


def archive_rows(spark, sf):
    o = X.table(spark, sf, "orders")
    pr = F.col("o_orderpriority")
    return o.select(F.round(F.lit(2.0) + X._frac("o_orderkey", 7919, 10007) * 15.0, 5).alias("latitude"), F.round(F.lit(-12.0) + X._frac("o_orderkey", 104729, 10007) * 24.0, 5).alias("longitude"),
                    F.lit(300.0).alias("bright_ti4"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("acq_date"), F.lit("0130").alias("acq_time"),
                    F.when(pr == "5-LOW", "Low").when(pr == "1-URGENT", "high").otherwise("nominal").alias("confidence"), F.round(F.col("o_totalprice") / 10000.0, 2).alias("frp"),
                    F.when(F.col("o_orderstatus") == "P", 2).otherwise(0).alias("type"))


@query("A12 C2 H2 T8", X.with_(ARCH) + "SELECT DISTINCT date, latitude, longitude, frp FROM arch WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' AND o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' AND latitude BETWEEN 3 AND 15.5 AND longitude BETWEEN -10 AND 10")
def fire_archive_scan(spark, sf):
    base = fresh_path(spark, "fires")
    rows = archive_rows(spark, sf)
    rows.write.option("header", True).csv(f"{base}/part_a.csv")
    rows.where("type = 0").write.option("header", True).csv(f"{base}/part_b.csv")
    return history.read_archive(spark, f"{base}/*.csv", "1996-01-01", "2000-12-31")


def pixel_rows(spark, sf):
    o = X.table(spark, sf, "orders")
    return o.select(F.to_date("o_orderdate").alias("date"), F.round(F.lit(2.0) + X._frac("o_orderkey", 7919, 10007) * 15.0, 5).alias("latitude"),
                    F.round(F.lit(-12.0) + X._frac("o_orderkey", 104729, 10007) * 24.0, 5).alias("longitude"),
                    F.when(F.pmod("o_orderkey", F.lit(13)) == 0, -9999.0).otherwise(F.round(F.col("o_totalprice") / 10000.0, 2)).alias("frp"),
                    (F.pmod("o_orderkey", F.lit(4)) + 6).cast("int").alias("confidence"), F.when(F.pmod("o_orderkey", F.lit(9)) == 0, 2).otherwise(0).alias("pac"),
                    F.concat(F.lit("EDR/2024/01/prod_s"), F.date_format("o_orderdate", "yyyyMMdd"), F.lpad(F.pmod("o_orderkey", F.lit(24)).cast("string"), 2, "0"), F.lit("3015_e1.nc")).alias("key"))


PIX = """pix AS (SELECT CAST(o_orderdate AS DATE) AS date, round(2.0::DOUBLE + ((o_orderkey * 7919) % 10007) / 10007.0::DOUBLE * 15.0::DOUBLE, 5) AS latitude, round(-12.0::DOUBLE + ((o_orderkey * 104729) % 10007) / 10007.0::DOUBLE * 24.0::DOUBLE, 5) AS longitude,
  CASE WHEN o_orderkey % 13 = 0 THEN -9999.0 ELSE round(o_totalprice / 10000.0, 2) END AS frp, o_orderkey % 4 + 6 AS confidence, CASE WHEN o_orderkey % 9 = 0 THEN 2 ELSE 0 END AS pac,
  'prod_s' || strftime(o_orderdate, '%Y%m%d') || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || '3015_e1.nc' AS granule FROM orders)"""


@query("A13 T8", X.with_(PIX) + "SELECT DISTINCT date, latitude, longitude, frp FROM pix WHERE confidence >= 8 AND pac = 0 AND frp > 0 AND frp < 1e5")
def fire_pixel_cleaning(spark, sf):
    return fires.clean_pixels(pixel_rows(spark, sf))


@query("A14 I15", X.with_(PIX) + "SELECT granule, count(*) AS n, round(min(substr(granule, 15, 2)::INTEGER * 60 + 30 + 15 / 60.0::DOUBLE), 6) AS minute FROM pix WHERE latitude BETWEEN 3 AND 15.5 AND longitude BETWEEN -10 AND 10 GROUP BY granule")
def regional_granule_pixels(spark, sf):
    p = fires.regional(pixel_rows(spark, sf))
    return p.groupBy("granule").agg(F.count(F.lit(1)).alias("n"), F.round(F.min(S.minute_of_day(F.col("granule"))), 6).alias("minute"))


@query("A15 H1", X.with_(ARCH, PIX) + """SELECT DISTINCT date, latitude, longitude, frp FROM arch WHERE date BETWEEN DATE '1995-01-01' AND DATE '1998-12-31' AND o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' AND latitude BETWEEN 3 AND 15.5 AND longitude BETWEEN -10 AND 10
UNION ALL SELECT DISTINCT date, latitude, longitude, frp FROM pix WHERE confidence >= 8 AND pac = 0 AND frp > 0 AND frp < 1e5 AND date >= DATE '1999-01-01'""")
def fire_history(spark, sf):
    old = fires.clean_archive(archive_rows(spark, sf), "1995-01-01", "2001-12-31")
    return history.history(old, pixel_rows(spark, sf), "1999-01-01")


@query("A16", "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderdate >= DATE '1998-01-01' GROUP BY o_custkey")
def pruned_column_scan(spark, sf):
    o = X.table(spark, sf, "orders").where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select("o_custkey", "o_totalprice")
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("A18", "SELECT 'C' || c_nationkey AS City, DATE '2024-01-01' + CAST(c_custkey % 90 AS INTEGER) AS date, round(avg(c_acctbal), 4) AS PM25, count(*) AS n FROM customer GROUP BY ALL")
def comparison_product_scan(spark, sf):
    c = X.table(spark, sf, "customer")
    rows = c.select(F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("City"), F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("c_custkey", F.lit(90)).cast("int")).cast("string").alias("Date"), F.col("c_acctbal").alias("PM25"), F.pmod("c_nationkey", F.lit(2)).alias("h"))
    base = fresh_path(spark, "comparison")
    for h in (0, 1):
        rows.where(F.col("h") == h).drop("h").write.option("header", True).csv(f"{base}/PM25_{h}.csv")
    return vector.read_comparison(spark, f"{base}/PM25_*.csv").groupBy("City", "date").agg(F.round(F.avg("PM25"), 4).alias("PM25"), F.count(F.lit(1)).alias("n"))


@query("A19 E8 D5", X.with_(X.CAMS) + f""", f AS (SELECT date FROM cams GROUP BY date HAVING count(*) >= 62) SELECT printf('%.2f_%.2f', lat, lon) AS node, date, {sr('cams_pm25','cams_pm25')} FROM cams SEMI JOIN f USING (date)""")
def complete_node_dates(spark, sf):
    c = X.cams(spark, sf).withColumn("node", S.node_label(F.col("lat"), F.col("lon")))
    twice = c.unionByName(c.where(F.day("date") % 2 == 0))
    return tables.complete_dates(twice, 62).select("node", "date", r("cams_pm25"))


@query("A20 E37", f"SELECT y // 6 AS row, x // 6 AS col, {sr('avg(value)','mean')}, {sr('stddev_pop(value)','sd')}, count(*) AS n FROM (SELECT c_custkey // 50 AS y, c_custkey % 50 AS x, c_acctbal AS value FROM customer) GROUP BY ALL")
def raster_block_statistics(spark, sf):
    c = X.table(spark, sf, "customer")
    p = c.select(F.floor(F.col("c_custkey") / 50).alias("y"), F.pmod("c_custkey", F.lit(50)).alias("x"), F.col("c_acctbal").alias("value"))
    return spatial.block_statistics(p, 6).select("row", "col", r("mean"), r("sd"), "n")


@query("A17 T18 I27", """SELECT CAST(s_suppkey AS BIGINT) AS doc, name, ring, count(*) AS n_edges, round(sum(x1 * y2 - x2 * y1) / 2, 6) + 0.0 AS signed_area FROM (SELECT s_suppkey, 'Area ' || s_suppkey AS name, CAST(ring AS INTEGER) AS ring, x + dx * k AS x1, y + dy * k AS y1, x + ex * k AS x2, y + ey * k AS y2
 FROM (SELECT s_suppkey, s_nationkey * 1.0::DOUBLE AS x, (s_suppkey % 7) * 1.0::DOUBLE AS y FROM supplier), (VALUES (0, 0.5::DOUBLE), (1, 0.2::DOUBLE)) r(ring, k), (VALUES (-1, -1, 1, -1), (1, -1, 1, 1), (1, 1, -1, 1), (-1, 1, -1, -1)) e(dx, dy, ex, ey)
 WHERE NOT (ring = 1 AND s_suppkey % 2 = 0)) GROUP BY ALL""")
def polygon_edge_scan(spark, sf):
    s = X.table(spark, sf, "supplier").select(F.col("s_suppkey").cast("long").alias("doc"), (F.col("s_nationkey") * 1.0).alias("x"), (F.pmod("s_suppkey", F.lit(7)) * 1.0).alias("y"))
    ring = lambda k: F.array(*[F.array(F.col("x") + a * k, F.col("y") + b * k) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))])
    even = F.col("doc") % 2 == 0
    coords = F.when(even, F.to_json(F.array(ring(0.5)))).otherwise(F.to_json(F.array(F.array(ring(0.5)), F.array(ring(0.2)))))
    kind = F.when(even, "Polygon").otherwise("MultiPolygon")
    body = F.concat(F.lit('{"features":[{"properties":{"shapeName":"Area '), F.col("doc").cast("string"), F.lit('"},"geometry":{"type":"'), kind, F.lit('","coordinates":'), coords, F.lit("}}]}"))
    e = vector.polygon_edges(s.select("doc", body.alias("body")), keys=["doc"])
    g = e.groupBy("doc", "name", "ring").agg(F.count(F.lit(1)).alias("n_edges"), (F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("a"))
    return g.select("doc", "name", "ring", "n_edges", (F.round("a", 6) + 0.0).alias("signed_area"))
