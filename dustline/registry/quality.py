"""Sensor quality control, daily means, weather days."""

from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions import scalars as S
from dustline.functions.metrics import circular_mean_deg
from dustline.operators import qc
from dustline.registry import feeds as X
from dustline.registry.core import query
from dustline.registry.feeds import r, sr

BASE = X.with_(X.READINGS, X.HOURLY, X.FLAGGED, X.GOOD_HOURS, X.DAYS)


@query("C1 E1 I13 J3", X.with_(X.READINGS, X.HOURLY) + f"SELECT site_id, CAST(hr AS DATE) AS date, CAST(hour(hr) AS INTEGER) AS hour, {sr('pm25', 'pm25')} FROM hourly")
def hourly_station_means(spark, sf):
    raw = X.readings(spark, sf)
    h = qc.hourly_mean(raw.where((F.col("parameter") == "pm25") & qc.physical_range(F.col("value"))))
    return h.select("site_id", F.to_date("hour").alias("date"), F.hour("hour").alias("hour"), r("pm25"))


@query("F1 F2 F3", X.with_(X.READINGS, X.HOURLY, X.FLAGGED) + f"SELECT site_id, CAST(hr AS DATE) AS date, CAST(hour(hr) AS INTEGER) AS hour, {sr('pm25', 'pm25')}, stuck, spike, NOT (stuck OR spike) AS keep FROM flagged")
def stuck_and_spike_flags(spark, sf):
    raw = X.readings(spark, sf)
    h = qc.hourly_mean(raw.where((F.col("parameter") == "pm25") & qc.physical_range(F.col("value"))))
    f = qc.flag_spike(qc.flag_stuck(h))
    return f.select("site_id", F.to_date("hour").alias("date"), F.hour("hour").alias("hour"), r("pm25"), "stuck", "spike",
                    (~(F.col("stuck") | F.col("spike"))).alias("keep"))


@query("D2 F3 E1", BASE + f"""SELECT site_id, CAST(hr AS DATE) AS date, CAST(hour(hr) AS INTEGER) AS hour, {sr('pm25', 'pm25')}, {sr('sensor_rh', 'sensor_rh')}, {sr('sensor_t', 'sensor_t')}
FROM good LEFT JOIN (SELECT site_id, date_trunc('hour', time) AS hr, avg(value) FILTER (parameter = 'relativehumidity') AS sensor_rh,
  avg(value) FILTER (parameter = 'temperature') AS sensor_t FROM readings WHERE parameter <> 'pm25' GROUP BY ALL) USING (site_id, hr)""")
def quality_controlled_hours(spark, sf):
    h = qc.hourly_qc(X.readings(spark, sf))
    return h.select("site_id", F.to_date("hour").alias("date"), F.hour("hour").alias("hour"), r("pm25"), r("sensor_rh"),
                    r("sensor_t"))


@query("E2 E3 T3", BASE + f"SELECT site_id, date, {sr('pm25', 'pm25')}, n_hours, {sr('pm25_hourly_sd', 'pm25_hourly_sd')}, min_block_hours FROM days")
def complete_station_days(spark, sf):
    h = qc.hourly_qc(X.readings(spark, sf))
    d = qc.daily_mean(h.drop("sensor_rh", "sensor_t"))
    return d.select("site_id", "date", r("pm25"), "n_hours", r("pm25_hourly_sd"), "min_block_hours")


@query("I26 E9 E11 F3 E3", BASE + f""", w AS (SELECT *, 1.0::DOUBLE + CAST(substr(site_id, 5) AS INTEGER) AS pop FROM days)
SELECT date, CASE WHEN date_diff('day', date, DATE '2024-01-29') < 0 THEN 'forecast' WHEN date_diff('day', date, DATE '2024-01-29') = 0 THEN 'nowcast'
  WHEN date_diff('day', date, DATE '2024-01-29') < 7 THEN 'nrt' ELSE 'final' END AS tier,
  count(*) AS n_obs, {sr('avg(pm25)', 'area_mean')}, {sr('sum(pm25 * pop) / sum(pop)', 'pop_weighted')}, {sr('max(pm25)', 'max')} FROM w GROUP BY date""")
def tiered_daily_summary(spark, sf):
    """Readings to quality-controlled days to a weighted daily value with its product tier."""
    d = qc.daily_mean(qc.hourly_qc(X.readings(spark, sf)))
    pop = F.lit(1.0) + F.substring("site_id", 5, 5).cast("int")
    w = d.withColumn("pop", pop)
    g = w.groupBy("date").agg(F.count(F.lit(1)).alias("n_obs"), F.avg("pm25").alias("area_mean"),
                              (F.sum(F.col("pm25") * F.col("pop")) / F.sum("pop")).alias("pop_weighted"), F.max("pm25").alias("max"))
    return g.select("date", S.product_tier(F.col("date"), F.lit("2024-01-29").cast("date")).alias("tier"), "n_obs",
                    r("area_mean"), r("pop_weighted"), r("max"))


def weather_samples(spark, sf):
    e = X.table(spark, sf, "events")
    codes = list(P.WEATHER_VARIABLES)
    var = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.pmod("event_id", F.lit(len(codes))) + 1).cast("int"))
    return e.select(F.concat(F.lit("W"), F.pmod("user_id", F.lit(2)).cast("string")).alias("code"),
                    F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("time"), var.alias("variable"),
                    F.pmod("user_id", F.lit(4)).cast("string").alias("sensor"),
                    (F.col("value") / F.when(var == "rh", 500.0).otherwise(1.0)).alias("value"))


WEATHER = """samples AS (
  SELECT 'W' || (user_id % 2) AS code, date_trunc('hour', ts) AS time, ['te','rh','pr','ws','wd','wg','ap','ra','vp'][CAST(event_id % 9 + 1 AS INTEGER)] AS variable,
    value / CASE WHEN event_id % 9 = 1 THEN 500.0 ELSE 1.0 END AS value FROM events),
per_time AS (SELECT code, CAST(time AS DATE) AS date, time, variable, avg(value) AS v FROM samples GROUP BY ALL),
wdays AS (SELECT code, date,
  CASE WHEN count(v) FILTER (variable = 'te') >= 6 THEN avg(v) FILTER (variable = 'te') END AS t2m,
  CASE WHEN count(v) FILTER (variable = 'te') >= 6 THEN max(v) FILTER (variable = 'te') - min(v) FILTER (variable = 'te') END AS t2m_range,
  CASE WHEN count(v) FILTER (variable = 'rh') >= 6 THEN avg(v) FILTER (variable = 'rh') END AS rh,
  CASE WHEN count(v) FILTER (variable = 'pr') >= 6 THEN sum(v) FILTER (variable = 'pr') * 8 / count(v) FILTER (variable = 'pr') END AS precip,
  CASE WHEN count(v) FILTER (variable = 'ws') >= 6 THEN avg(v) FILTER (variable = 'ws') END AS ws10,
  CASE WHEN count(v) FILTER (variable = 'wd') >= 6 THEN
    ((degrees(atan2(avg(sin(radians(v))) FILTER (variable = 'wd'), avg(cos(radians(v))) FILTER (variable = 'wd'))) % 360) + 360) % 360 END AS wd,
  CASE WHEN count(v) FILTER (variable = 'wg') >= 6 THEN max(v) FILTER (variable = 'wg') END AS wgust,
  CASE WHEN count(v) FILTER (variable = 'ap') >= 6 THEN avg(v) FILTER (variable = 'ap') END AS ps,
  CASE WHEN count(v) FILTER (variable = 'ra') >= 6 THEN avg(v) FILTER (variable = 'ra') * 24 / 1000.0 END AS ssrd,
  CASE WHEN count(v) FILTER (variable = 'vp') >= 6 THEN avg(v) FILTER (variable = 'vp') END AS vp
  FROM per_time GROUP BY ALL)"""


@query("E6 E7 I7 I10 C5", X.with_(WEATHER) + f""", med AS (SELECT code, quantile_cont(rh, 0.5) AS m FROM wdays GROUP BY code)
SELECT code, date, {sr('t2m','t2m')}, {sr('t2m_range','t2m_range')}, {sr('CASE WHEN m <= 1.5 THEN rh * 100.0 ELSE rh END','rh')}, {sr('precip','precip')}, {sr('ws10','ws10')},
 {sr('wd','wd')}, {sr('wgust','wgust')}, {sr('ps','ps')}, {sr('ssrd','ssrd')}, {sr('vp','vp')}, {sr('-ws10 * sin(radians(wd))','u10')}, {sr('-ws10 * cos(radians(wd))','v10')}
FROM wdays JOIN med USING (code)""")
def weather_station_days(spark, sf):
    d = qc.humidity_to_percent(qc.weather_daily(weather_samples(spark, sf), per_day=8))
    cols = ["t2m", "t2m_range", "rh", "precip", "ws10", "wd", "wgust", "ps", "ssrd", "vp", "u10", "v10"]
    return d.select("code", "date", *[r(c) for c in cols])


@query("I7 K4", f"SELECT event_type, {sr('((degrees(atan2(avg(sin(radians(value))), avg(cos(radians(value))))) % 360) + 360) % 360', 'direction')} FROM events GROUP BY event_type")
def circular_mean_direction(spark, sf):
    e = X.table(spark, sf, "events")
    return e.groupBy("event_type").agg(circular_mean_deg(F.col("value")).alias("direction")).select("event_type", r("direction"))
