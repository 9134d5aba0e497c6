"""Scalar expressions over whole tables."""

from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions import geo
from dustline.functions import scalars as S
from dustline.operators import lattice, spatial
from dustline.registry import feeds as X
from dustline.registry.core import query
from dustline.registry.feeds import hav, r, sr

GRID_LAT = "6.0::DOUBLE + (o_orderkey % 1000) * 0.005::DOUBLE"
GRID_LON = "-3.4::DOUBLE + (o_orderkey % 977) * 0.005::DOUBLE"


def spots(spark, sf):
    o = X.table(spark, sf, "orders")
    return o.select("o_orderkey", (F.lit(6.0) + F.pmod("o_orderkey", F.lit(1000)) * 0.005).alias("lat"),
                    (F.lit(-3.4) + F.pmod("o_orderkey", F.lit(977)) * 0.005).alias("lon"), "o_totalprice")


SPOTS = f"spots AS (SELECT o_orderkey, {GRID_LAT} AS lat, {GRID_LON} AS lon, o_totalprice FROM orders)"


@query("I1 I2 I3 I18 I22 L22 C2", X.with_(SPOTS) + f"""SELECT o_orderkey, {sr(hav('lat','lon','5.6037','-0.1870'),'km')},
 {sr('hypot_km','flat_km')}, {sr('6371.0 * sqrt(power(cos(radians(lat))*cos(radians(lon)) - cos(radians(5.6037))*cos(radians(-0.1870)),2) + power(cos(radians(lat))*sin(radians(lon)) - cos(radians(5.6037))*sin(radians(-0.1870)),2) + power(sin(radians(lat)) - sin(radians(5.6037)),2))','chord')},
 CASE WHEN rr >= 0 AND cc >= 0 AND rr < 650 AND cc < 455 THEN CAST(rr * 455 + cc AS BIGINT) ELSE -1 END AS cell,
 {sr('power(0.01*111.32, 2) * cos(radians(lat))','km2',6)}, {sr('(o_totalprice / 1000.0) * power(0.01*111.32, 2) * cos(radians(lat))','population')},
 lat BETWEEN 4.0 AND 13.5 AND lon BETWEEN -9.0 AND 9.0 AS in_region
FROM (SELECT *, floor((11.2 - lat) / 0.01) AS rr, floor((lon - (-3.3)) / 0.01) AS cc,
  sqrt(power((lon + 0.1870) * 111.32 * cos(radians(lat)), 2) + power((lat - 5.6037) * 111.32, 2)) AS hypot_km FROM (SELECT o_orderkey, lat + 0.0013 AS lat, lon + 0.0017 AS lon, o_totalprice FROM spots))""")
def distances_and_cells(spark, sf):
    d = spots(spark, sf).withColumn("lat", F.col("lat") + 0.0013).withColumn("lon", F.col("lon") + 0.0017)
    la, lo, a, o = F.col("lat"), F.col("lon"), F.lit(5.6037), F.lit(-0.1870)
    dx, dy = geo.flat_offsets_km(la, lo, a, o)
    return d.select("o_orderkey", r(geo.haversine_km(la, lo, a, o), alias="km"), r(F.hypot(dx, dy), alias="flat_km"),
                    r(geo.chord_km(la, lo, a, o), alias="chord"), geo.cell_index(la, lo).alias("cell"),
                    r(geo.cell_area_km2(la), 6, "km2"), r(spatial.population(F.col("o_totalprice") / 1000.0, la), alias="population"),
                    geo.in_box(la, lo, P.REGION_BOX).alias("in_region"))


@query("I6 I8 I9 I10 I11", f"""SELECT l_orderkey, l_linenumber, {sr('-(q/3.6) * sin(radians(e))','u')}, {sr('-(q/3.6) * cos(radians(e))','v')},
 {sr('atan2((q/3.6) * sin(radians(e)), (q/3.6) * cos(radians(e)))','from_angle')}, {sr('6.112 * exp(17.67 * td / (td + 243.5))','vapour_hpa')},
 {sr('622.0 * (6.112 * exp(17.67 * td / (td + 243.5))) / (ps * 10 - 0.378 * (6.112 * exp(17.67 * td / (td + 243.5))))','qv')},
 {sr('CASE WHEN 8400.0 * ln(ps * 1000.0 / top) BETWEEN 0 AND 6000 THEN 8400.0 * ln(ps * 1000.0 / top) END','blh')},
 {sr('q * 24 / 1000.0','kwh')}, {sr('q / (e + 1.0)','dust_frac')}
FROM (SELECT *, CASE WHEN t0 < 200 THEN t0 * 1000.0 ELSE t0 END AS top FROM (SELECT l_orderkey, l_linenumber, l_quantity AS q, l_extendedprice / 300.0 AS e, 10.0 + l_quantity / 4.0 AS td, 98.0 + l_tax * 50.0 AS ps,
  CASE WHEN l_linenumber % 2 = 0 THEN 60.0 + l_quantity ELSE (60.0 + l_quantity) * 1000.0 END AS t0 FROM lineitem))""")
def wind_moisture_and_depth(spark, sf):
    li = X.table(spark, sf, "lineitem")
    d = li.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("q"), (F.col("l_extendedprice") / 300.0).alias("e"),
                  (F.lit(10.0) + F.col("l_quantity") / 4.0).alias("td"), (F.lit(98.0) + F.col("l_tax") * 50.0).alias("ps"),
                  F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity") + 60.0).otherwise((F.col("l_quantity") + 60.0) * 1000.0).alias("t0"))
    ws = S.kmh_to_ms(F.col("q"))
    u, v = S.wind_u(ws, F.col("e")), S.wind_v(ws, F.col("e"))
    return d.select("l_orderkey", "l_linenumber", r(u, alias="u"), r(v, alias="v"), r(S.wind_from_angle(u, v), alias="from_angle"),
                    r(S.vapour_pressure_hpa(F.col("td")), alias="vapour_hpa"), r(S.specific_humidity_gkg(F.col("td"), F.col("ps")), alias="qv"),
                    r(S.boundary_layer_height(F.col("ps"), F.col("t0")), alias="blh"), r(S.watts_to_kwh_day(F.col("q")), alias="kwh"),
                    r(S.dust_fraction(F.col("q"), F.col("e")), alias="dust_frac"))


@query("I4 I5 I23 I24", f"""SELECT c_custkey, {sr('ln(greatest(c_acctbal, 0.1))','log_a')}, {sr('ln(1 + greatest(c_acctbal, 0))','log1p_a')},
 {sr('exp(c_acctbal / 1000.0)','exp_a')}, {sr('exp(c_acctbal / 1000.0) - 1','expm1_a')}, {sr('least(greatest(c_acctbal, 10.0), 5000.0)','clipped')},
 {sr('round_even(c_acctbal / 0.5, 0)','half_even')}, {sr('ln(1 + abs(c_acctbal) / 100.0)','dist_log')} FROM customer""")
def logs_clips_and_rounding(spark, sf):
    c, a = X.table(spark, sf, "customer"), F.col("c_acctbal")
    return c.select("c_custkey", r(S.log_floor(a, 0.1), alias="log_a"), r(S.log1p_floor(a), alias="log1p_a"),
                    r(F.exp(a / 1000.0), alias="exp_a"), r(F.expm1(a / 1000.0), alias="expm1_a"),
                    r(S.clip(a, 10.0, 5000.0), alias="clipped"), r(F.rint(a / 0.5), alias="half_even"),
                    r(F.log1p(F.abs(a) / 100.0), alias="dist_log"))


@query("I12 I13 I14 I15", f"""SELECT event_id, CAST(date_trunc('hour', ts) AS DATE) AS date, CAST(hour(ts) AS INTEGER) // 6 AS block, strftime(ts, '%Y-%m') AS month,
 {sr('sin(2*pi()*dayofyear(ts)/365.25)','doy_sin')}, {sr('cos(2*pi()*dayofyear(ts)/365.25)','doy_cos')}, CAST((dayofweek(ts) + 6) % 7 AS INTEGER) AS dow,
 CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_no, {sr('m','minute')},
 (m BETWEEN -120 AND 300 OR m - 1440 BETWEEN -120 AND 300 OR m BETWEEN 600 AND 1020 OR m - 1440 BETWEEN 600 AND 1020) AS in_window,
 regexp_replace('site ' || event_type || '-' || user_id, '-\\d+$', '') AS base_name, CAST(split_part('a_' || user_id, '_', 2) AS BIGINT) AS part
FROM (SELECT *, hour(ts) * 60 + minute(ts) + CAST(second(ts) AS INTEGER) / 60.0::DOUBLE AS m FROM events)""")
def calendar_and_text(spark, sf):
    e = X.table(spark, sf, "events").withColumn("t", F.col("ts").cast("timestamp"))
    phase = S.year_phase(F.col("t"))
    key = F.concat(F.lit("path/prod_s"), F.date_format("t", "yyyyMMddHHmmss"), F.lit("_e.nc"))
    minute = S.minute_of_day(key)
    return e.select(
        "event_id", F.to_date(F.date_trunc("hour", "t")).alias("date"), S.six_hour_block(F.col("t")).alias("block"),
        F.date_format("t", "yyyy-MM").alias("month"), r(F.sin(phase), alias="doy_sin"), r(F.cos(phase), alias="doy_cos"),
        F.weekday("t").alias("dow"), F.datediff("t", F.lit("2024-01-01")).alias("day_no"), r(minute, alias="minute"),
        S.in_overpass_window(minute).alias("in_window"),
        F.regexp_replace(F.concat(F.lit("site "), "event_type", F.lit("-"), F.col("user_id").cast("string")), r"-\d+$", "").alias("base_name"),
        F.split(F.concat(F.lit("a_"), F.col("user_id").cast("string")), "_")[1].cast("long").alias("part"))


_AQI = " ".join(f"WHEN c <= {b} THEN CAST(floor({(ih - il) / (b - a)!r} * (c - {a}) + {il} + 0.5) AS INTEGER)" for a, b, il, ih in P.AQI_BREAKPOINTS)


@query("I16 C8", "SELECT event_id, CASE " + " ".join(f"WHEN v <= {b} THEN '{n}'" for b, n in P.AQI_CLASSES) + f" ELSE 'Hazardous' END AS category, CASE {_AQI} ELSE 500 END AS aqi, v > 15 AS over_who, v > 35 AS over_national FROM (SELECT *, floor(v * 10) / 10 AS c FROM (SELECT event_id, value * 1.5 AS v FROM events))")
def air_quality_index(spark, sf):
    v = F.col("value") * 1.5
    return X.table(spark, sf, "events").select("event_id", S.aqi_category(v).alias("category"), S.aqi_value(v).alias("aqi"),
                                               S.exceeds(v, P.WHO_DAILY).alias("over_who"),
                                               S.exceeds(v, P.NATIONAL_DAILY).alias("over_national"))


@query("I25 I26 J6", """SELECT o_orderkey, CASE WHEN d < 0 THEN 'forecast' WHEN d = 0 THEN 'nowcast' WHEN d < 7 THEN 'nrt' ELSE 'final' END AS tier,
 CASE WHEN d * 12 < 30 THEN 'Operational' WHEN d * 12 < 72 THEN 'Delayed' ELSE 'Stale' END AS status
FROM (SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-07-30') AS d FROM orders)""")
def tier_and_status_labels(spark, sf):
    today = F.lit("2001-07-30").cast("date")
    o = X.table(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate"))
    return o.select("o_orderkey", S.product_tier(F.col("d"), today).alias("tier"),
                    S.run_status(F.datediff(today, F.col("d")) * 12).alias("status"))


@query("C13", """SELECT l, network, country || '|' || network AS net_key, CASE WHEN lower(network) LIKE '%clarity%' THEN 'clarity'
  WHEN lower(network) LIKE '%airgradient%' OR lower(network) LIKE '%iqair%' THEN 'plantower-class' ELSE 'other' END AS family
FROM (SELECT c_custkey AS l, CASE c_custkey % 4 WHEN 0 THEN 'Clarity ' || c_mktsegment WHEN 1 THEN 'AirGradient' WHEN 2 THEN 'IQAir' ELSE c_mktsegment END AS network,
  'N' || c_nationkey AS country FROM customer)""")
def sensor_family_keys(spark, sf):
    c = X.table(spark, sf, "customer")
    k = F.pmod("c_custkey", F.lit(4))
    net = (F.when(k == 0, F.concat(F.lit("Clarity "), "c_mktsegment")).when(k == 1, "AirGradient").when(k == 2, "IQAir")
           .otherwise(F.col("c_mktsegment")))
    d = c.select(F.col("c_custkey").alias("l"), net.alias("network"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"))
    return d.select("l", "network", S.network_key(F.col("country"), F.col("network")).alias("net_key"),
                    S.sensor_family(F.col("network")).alias("family"))


@query("I19 K3 H2", X.with_(X.STATIONS) + """, c AS (SELECT round(floor(lat / 0.8) * 0.8 + dy, 2) + 0.0 AS lat, round(floor(lon / 0.8) * 0.8 + dx, 2) + 0.0 AS lon
  FROM stations, (VALUES (0.0::DOUBLE), (0.8::DOUBLE)) a(dx), (VALUES (0.0::DOUBLE), (0.8::DOUBLE)) b(dy))
SELECT DISTINCT lat, lon, printf('%.2f_%.2f', lat, lon) AS node FROM c""")
def enclosing_nodes(spark, sf):
    return lattice.corner_nodes(X.stations(spark, sf), 0.8)


@query("I19 L1", X.with_(X.STATIONS) + """, b AS (SELECT country, floor(min(lat) / 0.5) AS a0, ceil(max(lat) / 0.5) AS a1, floor(min(lon) / 0.5) AS b0, ceil(max(lon) / 0.5) AS b1 FROM stations GROUP BY country)
SELECT country, CAST(a * 0.5 AS DOUBLE) AS lat, CAST(o * 0.5 AS DOUBLE) AS lon, printf('%.2f_%.2f', CAST(a * 0.5 AS DOUBLE), CAST(o * 0.5 AS DOUBLE)) AS node
FROM b, LATERAL (SELECT unnest(range(CAST(a0 AS BIGINT), CAST(a1 AS BIGINT) + 1)) AS a), LATERAL (SELECT unnest(range(CAST(b0 AS BIGINT), CAST(b1 AS BIGINT) + 1)) AS o)""")
def covering_lattice_nodes(spark, sf):
    box = X.stations(spark, sf).groupBy("country").agg(F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max"),
                                                       F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"))
    n = lattice.box_nodes(box, 0.5)
    return n.select("country", (F.col("lat") + 0.0).alias("lat"), (F.col("lon") + 0.0).alias("lon"), "node")


WIDE = "wide AS (SELECT c_custkey AS site_id, -8.0::DOUBLE + ((c_custkey * 104729) % 1013) / 1013.0::DOUBLE * 14.0::DOUBLE AS lon, 4.0::DOUBLE + ((c_custkey * 7919) % 1009) / 1009.0::DOUBLE * 9.0::DOUBLE AS lat FROM customer)"


def wide_points(spark, sf):
    c = X.table(spark, sf, "customer")
    return c.select(F.col("c_custkey").alias("site_id"), (F.lit(-8.0) + X._frac("c_custkey", 104729, 1013) * 14.0).alias("lon"),
                    (F.lit(4.0) + X._frac("c_custkey", 7919, 1009) * 9.0).alias("lat"))


TILES = """tiles AS (SELECT DISTINCT CAST(floor(lon / 0.5) AS BIGINT) AS tx, CAST(floor(lat / 0.5) AS BIGINT) AS ty FROM wide
  WHERE NOT (lon BETWEEN -3.3 + 0.15 AND 1.25 - 0.15 AND lat BETWEEN 4.7 + 0.15 AND 11.2 - 0.15)),
boxes AS (SELECT 'tile_' || tx || '_' || ty AS name, tx * 0.5 - 0.15::DOUBLE AS lon_min, (tx + 1) * 0.5 + 0.15::DOUBLE AS lon_max,
  ty * 0.5 - 0.15::DOUBLE AS lat_min, (ty + 1) * 0.5 + 0.15::DOUBLE AS lat_max FROM tiles)"""


@query("I20 C3", X.with_(WIDE, TILES) + f"SELECT name, {sr('lon_min','lon_min')}, {sr('lon_max','lon_max')}, {sr('lat_min','lat_min')}, {sr('lat_max','lat_max')} FROM boxes")
def padded_station_tiles(spark, sf):
    t = spatial.station_tiles(wide_points(spark, sf))
    return t.select("name", r("lon_min"), r("lon_max"), r("lat_min"), r("lat_max"))


@query("D20", X.with_(WIDE, TILES) + f"""SELECT site_id, name AS box, {sr('edge','edge')} FROM (
 SELECT site_id, name, edge, row_number() OVER (PARTITION BY site_id ORDER BY edge DESC, name) AS rn FROM (
  SELECT site_id, name, least(lon - lon_min, lon_max - lon, lat - lat_min, lat_max - lat) AS edge FROM wide JOIN boxes
  ON lon BETWEEN lon_min AND lon_max AND lat BETWEEN lat_min AND lat_max)) WHERE rn = 1""")
def deepest_covering_box(spark, sf):
    p = wide_points(spark, sf)
    d = spatial.deepest_box(p, spatial.station_tiles(p), ["site_id"])
    return d.select("site_id", "box", r("edge"))
