"""The given tables seen through the engine's data model, as DataFrames and as SQL.

Each feed has a builder and a text of the same meaning (a list of common table expressions)
for the comparison statements.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


#: Added before rounding on both sides, so means of short decimals do not sit on a rounding tie.
NUDGE = 1.37e-9


def r(col: str | Column, nd: int = 4, alias: str | None = None) -> Column:
    """Rounded output column; adding zero removes minus zero."""
    c = F.col(col) if isinstance(col, str) else col
    return (F.round(c + NUDGE, nd) + F.lit(0.0)).alias(alias or col)


def sr(expr: str, alias: str, nd: int = 4) -> str:
    return f"round({expr} + {NUDGE}, {nd}) + 0.0 AS {alias}"


# ---- sensor readings: events -------------------------------------------------
def readings(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    kind = (F.when(F.col("event_type") == "error", "relativehumidity")
            .when(F.col("event_type") == "signup", "temperature").otherwise("pm25"))
    return e.select(
        F.concat(F.lit("oaq_"), F.pmod("user_id", F.lit(5)).cast("string")).alias("site_id"),
        F.concat(F.lit("s"), F.pmod("user_id", F.lit(3)).cast("string")).alias("sensors_id"),
        F.col("ts").cast("timestamp").alias("time"), kind.alias("parameter"),
        (F.floor(F.col("value") / 20.0) * 50.0 - 20.0 + F.pmod("user_id", F.lit(2)) * 25.0).alias("value"))


READINGS = """readings AS (
  SELECT 'oaq_' || (user_id % 5) AS site_id, 's' || (user_id % 3) AS sensors_id, ts AS time,
         CASE event_type WHEN 'error' THEN 'relativehumidity' WHEN 'signup' THEN 'temperature' ELSE 'pm25' END AS parameter,
         floor(value / 20.0) * 50.0 - 20.0 + (user_id % 2) * 25.0 AS value
  FROM events)"""

HOURLY = """hourly AS (
  SELECT site_id, date_trunc('hour', time) AS hr, avg(value) AS pm25 FROM readings
  WHERE parameter = 'pm25' AND value > 0 AND value <= 1000 GROUP BY ALL)"""

FLAGGED = """chg AS (
  SELECT *, CASE WHEN lag(pm25) OVER w = pm25 THEN 0 ELSE 1 END AS ch FROM hourly WINDOW w AS (PARTITION BY site_id ORDER BY hr)),
isl AS (SELECT *, sum(ch) OVER (PARTITION BY site_id ORDER BY hr) AS island FROM chg),
stk AS (SELECT *, row_number() OVER (PARTITION BY site_id, island ORDER BY hr) > 5 AS stuck FROM isl),
med AS (
  SELECT *, CASE WHEN count(pm25) OVER f >= 6 THEN quantile_cont(pm25, 0.5) OVER f END AS m FROM stk
  WINDOW f AS (PARTITION BY site_id ORDER BY hr RANGE BETWEEN INTERVAL 12 HOURS PRECEDING AND INTERVAL 12 HOURS FOLLOWING)),
dev AS (SELECT *, abs(pm25 - m) AS d FROM med),
mads AS (
  SELECT *, CASE WHEN count(d) OVER f >= 6 THEN quantile_cont(d, 0.5) OVER f END AS mad FROM dev
  WINDOW f AS (PARTITION BY site_id ORDER BY hr RANGE BETWEEN INTERVAL 12 HOURS PRECEDING AND INTERVAL 12 HOURS FOLLOWING)),
flagged AS (SELECT site_id, hr, pm25, stuck, coalesce(mad IS NOT NULL AND d > greatest(6*1.4826*mad, 30), false) AS spike FROM mads)"""

GOOD_HOURS = """good AS (SELECT site_id, hr, pm25 FROM flagged WHERE NOT stuck AND NOT spike)"""

DAYS = """days AS (
  SELECT * FROM (
    SELECT site_id, CAST(hr AS DATE) AS date, avg(pm25) AS pm25, count(*) AS n_hours, stddev_samp(pm25) AS pm25_hourly_sd,
           least(count(*) FILTER (hour(hr) // 6 = 0), count(*) FILTER (hour(hr) // 6 = 1),
                 count(*) FILTER (hour(hr) // 6 = 2), count(*) FILTER (hour(hr) // 6 = 3)) AS min_block_hours
    FROM good GROUP BY ALL)
  WHERE n_hours >= 12 AND min_block_hours >= 2)"""


# ---- stations: supplier ------------------------------------------------------
def _frac(key: str, a: int, m: int) -> Column:
    return F.pmod(F.col(key) * a, F.lit(m)) / float(m)


def stations(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    ref = F.pmod("s_suppkey", F.lit(5)) == 0
    network = (F.when(ref, "AirNow").when(F.pmod("s_suppkey", F.lit(4)) == 0, "Clarity")
               .when(F.pmod("s_suppkey", F.lit(4)) == 1, "AirGradient")
               .when(F.pmod("s_suppkey", F.lit(4)) == 2, "IQAir").otherwise("Custom Net"))
    country = (F.when(F.pmod("s_nationkey", F.lit(3)) == 0, "GH").when(F.pmod("s_nationkey", F.lit(3)) == 1, "CI")
               .otherwise("TG"))
    return s.select(
        F.col("s_suppkey").alias("site_id"), F.col("s_name").alias("name"), country.alias("country"),
        network.alias("network"),
        (F.lit(4.8) + F.pmod("s_nationkey", F.lit(5)) * 1.25 + _frac("s_suppkey", 7919, 1009) * 0.18).alias("lat"),
        (F.lit(-3.2) + F.floor(F.col("s_nationkey") / 5) * 0.9 + _frac("s_suppkey", 104729, 1013) * 0.18).alias("lon"),
        ref.alias("is_reference"))


STATIONS = """stations AS (
  SELECT s_suppkey AS site_id, s_name AS name,
    CASE s_nationkey % 3 WHEN 0 THEN 'GH' WHEN 1 THEN 'CI' ELSE 'TG' END AS country,
    CASE WHEN s_suppkey % 5 = 0 THEN 'AirNow' WHEN s_suppkey % 4 = 0 THEN 'Clarity' WHEN s_suppkey % 4 = 1 THEN 'AirGradient'
         WHEN s_suppkey % 4 = 2 THEN 'IQAir' ELSE 'Custom Net' END AS network,
    4.8::DOUBLE + (s_nationkey % 5) * 1.25::DOUBLE + ((s_suppkey * 7919) % 1009) / 1009.0::DOUBLE * 0.18::DOUBLE AS lat,
    -3.2::DOUBLE + (s_nationkey // 5) * 0.9::DOUBLE + ((s_suppkey * 104729) % 1013) / 1013.0::DOUBLE * 0.18::DOUBLE AS lon,
    s_suppkey % 5 = 0 AS is_reference
  FROM supplier)"""


# ---- site-days: lineitem -----------------------------------------------------
def site_days(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    date = F.date_add(F.lit("2024-01-01").cast("date"),
                      F.pmod(F.datediff(F.col("l_shipdate"), F.lit("1995-01-01")), F.lit(360)))
    return li.groupBy(F.col("l_suppkey").alias("site_id"), date.alias("date")).agg(
        F.avg("l_quantity").alias("pm25"), F.count(F.lit(1)).alias("n_hours"),
        (F.lit(40.0) + F.avg("l_discount") * 500.0).alias("rh"))


SITE_DAYS = """site_days AS (
  SELECT l_suppkey AS site_id, DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 360 AS INTEGER) AS date,
    avg(l_quantity) AS pm25, count(*) AS n_hours, 40.0::DOUBLE + avg(l_discount) * 500.0 AS rh
  FROM lineitem GROUP BY ALL)"""

HAVERSINE = ("12742.0::DOUBLE * asin(sqrt(least(1.0, power(sin(radians({b0} - {a0}) / 2), 2) + cos(radians({a0})) * "
             "cos(radians({b0})) * power(sin(radians({b1} - {a1}) / 2), 2))))")


def hav(a0: str, a1: str, b0: str, b1: str) -> str:
    return HAVERSINE.format(a0=a0, a1=a1, b0=b0, b1=b1)


# ---- lattices: orders --------------------------------------------------------
def order_day() -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"),
                      F.pmod(F.datediff(F.col("o_orderdate"), F.lit("1995-01-01")), F.lit(60)))


ORDER_DAY = "DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 60 AS INTEGER)"

_LATTICE_EXPRS = {  # column: expression over (p = mean price / 1e4, n = rows)
    "cams_pm25": "p", "cams_pm10": "p * 1.6 + n", "cams_aod": "p / 50.0", "cams_dust": "p * 0.4 + n",
    "cams_co": "p * 10.0 + 100.0", "cams_no2": "p / 3.0", "cams_pm25_max": "p * 1.3",
}
_MET_EXPRS = {
    "t2m": "25.0 + p / 10.0", "t2m_range": "8.0 + n / 4.0", "rh": "40.0 + p", "qv2m": "10.0 + p / 9.0",
    "td2m": "18.0 + p / 12.0", "precip": "n * 0.7", "ws10": "1.0 + p / 15.0", "u10": "p / 12.0 - 2.0",
    "v10": "1.5 - p / 20.0", "ps": "100.0 + n / 10.0", "ssrd": "4.0 + p / 20.0", "cloud": "50.0 + p",
    "merra_aod": "p / 60.0", "blh": "300.0 + p * 20.0",
}


def _lattice(spark: SparkSession, sf: str, step: tuple[float, float], size: tuple[int, int], exprs: dict) -> DataFrame:
    o = table(spark, sf, "orders")
    nodes = o.groupBy(F.pmod("o_custkey", F.lit(size[0])).cast("int").alias("i"),
                      F.pmod(F.floor(F.col("o_custkey") / size[0]), F.lit(size[1])).cast("int").alias("j"),
                      order_day().alias("date")).agg((F.avg("o_totalprice") / 10000.0).alias("p"),
                                                     F.count(F.lit(1)).cast("double").alias("n"))
    return nodes.select((F.lit(4.0) + F.col("i") * step[0]).alias("lat"), (F.lit(-4.0) + F.col("j") * step[1]).alias("lon"),
                        "date", *[F.expr(e.replace(".0", ".0D")).alias(c) for c, e in exprs.items()])


def cams(spark: SparkSession, sf: str) -> DataFrame:
    return _lattice(spark, sf, (0.8, 0.8), (9, 7), _LATTICE_EXPRS)


def met(spark: SparkSession, sf: str) -> DataFrame:
    return _lattice(spark, sf, (0.5, 0.625), (14, 8), _MET_EXPRS)


def _lattice_sql(name: str, step, size, exprs) -> str:
    cols = ", ".join(f"{e} AS {c}" for c, e in exprs.items())
    return f"""{name} AS (
  SELECT 4.0::DOUBLE + i * {step[0]}::DOUBLE AS lat, -4.0::DOUBLE + j * {step[1]}::DOUBLE AS lon, i, j, date, {cols}
  FROM (SELECT o_custkey % {size[0]} AS i, (o_custkey // {size[0]}) % {size[1]} AS j, {ORDER_DAY} AS date,
               avg(o_totalprice) / 10000.0 AS p, CAST(count(*) AS DOUBLE) AS n FROM orders GROUP BY ALL))"""


CAMS = _lattice_sql("cams", (0.8, 0.8), (9, 7), _LATTICE_EXPRS)
MET = _lattice_sql("met", (0.5, 0.625), (14, 8), _MET_EXPRS)


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Stations by day over the days the lattices cover."""
    days = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("site_id"),
        F.date_add(F.lit("2024-01-01").cast("date"),
                   F.pmod(F.datediff(F.col("l_shipdate"), F.lit("1995-01-01")), F.lit(60))).alias("date")).distinct()
    return days.join(stations(spark, sf).select("site_id", "lat", "lon"), "site_id")


POINTS = """points AS (
  SELECT site_id, date, lat, lon FROM (
    SELECT DISTINCT l_suppkey AS site_id, DATE '2024-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) % 60 AS INTEGER) AS date
    FROM lineitem) JOIN stations USING (site_id))"""


# ---- fire detections: orders -------------------------------------------------
def fire_rows(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return o.select(
        order_day().alias("date"), (F.lit(3.5) + _frac("o_orderkey", 7919, 10007) * 9.0).alias("latitude"),
        (F.lit(-5.0) + _frac("o_orderkey", 104729, 10007) * 8.0).alias("longitude"),
        (F.col("o_totalprice") / 10000.0).alias("frp"))


FIRES = f"""fires AS (
  SELECT {ORDER_DAY} AS date, 3.5::DOUBLE + ((o_orderkey * 7919) % 10007) / 10007.0::DOUBLE * 9.0::DOUBLE AS latitude,
    -5.0::DOUBLE + ((o_orderkey * 104729) % 10007) / 10007.0::DOUBLE * 8.0::DOUBLE AS longitude, o_totalprice / 10000.0 AS frp
  FROM orders)"""


# ---- daily product: orders on customer cells ----------------------------------
def cells(spark: SparkSession, sf: str) -> DataFrame:
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    return c.join(F.broadcast(n.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")), "c_nationkey").select(
        F.col("c_custkey").alias("cell"), F.floor(F.col("c_custkey") / 50).alias("row"),
        F.pmod("c_custkey", F.lit(50)).alias("col"), F.col("n_regionkey").cast("int").alias("adm1_id"),
        F.col("c_nationkey").cast("int").alias("adm2_id"), F.greatest("c_acctbal", F.lit(0.0)).alias("pop"))


CELLS = """cells AS (
  SELECT c_custkey AS cell, c_custkey // 50 AS row, c_custkey % 50 AS col, CAST(n_regionkey AS INTEGER) AS adm1_id,
    CAST(c_nationkey AS INTEGER) AS adm2_id, greatest(c_acctbal, 0.0) AS pop
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def product(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").groupBy(
        F.col("o_custkey").alias("cell"), F.to_date("o_orderdate").alias("date")).agg(
        (F.avg("o_totalprice") / 7000.0).alias("pm25"), F.avg("o_totalprice").alias("_p"))
    return o.join(cells(spark, sf), "cell").select(
        "date", "cell", "row", "col", "adm1_id", "adm2_id", "pop",
        F.when(F.pmod("cell", F.lit(37)) != 0, F.col("pm25")).alias("pm25"),
        (F.col("pm25") * 0.6).alias("lower90"), (F.col("pm25") * 1.7).alias("upper90"),
        (F.col("pm25") * 0.95).alias("stage1"), (F.col("_p") / 9000.0).alias("cams_pm25"),
        F.when(F.pmod("cell", F.lit(11)) == 0, 0).otherwise(1).alias("inside_aoa"))


PRODUCT = """product AS (
  SELECT date, cell, row, col, adm1_id, adm2_id, pop, CASE WHEN cell % 37 <> 0 THEN v END AS pm25, v * 0.6 AS lower90,
    v * 1.7 AS upper90, v * 0.95 AS stage1, p / 9000.0 AS cams_pm25, CASE WHEN cell % 11 = 0 THEN 0 ELSE 1 END AS inside_aoa
  FROM (SELECT o_custkey AS cell, CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) / 7000.0 AS v, avg(o_totalprice) AS p
        FROM orders GROUP BY ALL) JOIN cells USING (cell))"""

REGION_STATS = """stats AS (
  SELECT date, 'adm0' AS level, 0 AS id, * EXCLUDE (date) FROM (SELECT date, {m} FROM product WHERE pm25 IS NOT NULL GROUP BY date)
  UNION ALL SELECT date, 'adm1', adm1_id, * EXCLUDE (date, adm1_id) FROM (SELECT date, adm1_id, {m} FROM product WHERE pm25 IS NOT NULL GROUP BY date, adm1_id)
  UNION ALL SELECT date, 'adm2', adm2_id, * EXCLUDE (date, adm2_id) FROM (SELECT date, adm2_id, {m} FROM product WHERE pm25 IS NOT NULL GROUP BY date, adm2_id))""".replace(
    "{m}", """avg(pm25) AS area_mean,
      CASE WHEN sum(pop) > 0 THEN sum(pm25 * pop) / sum(pop) ELSE avg(pm25) END AS pop_weighted,
      avg(lower90) AS lower90, avg(upper90) AS upper90, max(pm25) AS max, sum(pop) AS population,
      CASE WHEN sum(pop) > 0 THEN sum(CASE WHEN pm25 > 15 THEN pop ELSE 0 END) / sum(pop) ELSE avg(CAST(pm25 > 15 AS DOUBLE)) END AS pop_frac_gt15,
      CASE WHEN sum(pop) > 0 THEN sum(CASE WHEN pm25 > 35 THEN pop ELSE 0 END) / sum(pop) ELSE avg(CAST(pm25 > 35 AS DOUBLE)) END AS pop_frac_gt35""")


# ---- out-of-fold predictions: lineitem -----------------------------------------
def predictions(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    y = F.ln(F.greatest("l_quantity", F.lit(1.0)))
    base = li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), F.col("l_suppkey").alias("site_id"),
        F.to_date("l_shipdate").alias("date"), F.col("l_quantity").alias("pm25"), y.alias("y"),
        (y * 0.7 + F.col("l_discount") * 12.0).alias("lgbm"), (y * 0.9 + F.col("l_tax") * 5.0).alias("xgb_ratio"),
        (y * 0.5 + F.ln(F.col("l_extendedprice") / 20000.0 + 1.0)).alias("catboost"),
        (F.lit(2.5) + y * 0.1 + F.col("l_discount") * 2.0).alias("extratrees"),
        (F.col("l_extendedprice") / 2500.0 + 1.0).alias("cams_pm25"),
        (F.lit(0.05) + F.col("l_tax")).alias("cal_sigma_log"), F.pmod("l_orderkey", F.lit(5)).cast("int").alias("fold"))
    st = stations(spark, sf).select("site_id", "country", "is_reference", "lat", "lon", "network")
    return base.join(st, "site_id")


PREDICTIONS = """predictions AS (
  SELECT *, ln(greatest(l_quantity, 1.0)) AS y FROM (
    SELECT l_orderkey * 10 + l_linenumber AS row_id, l_suppkey AS site_id, CAST(l_shipdate AS DATE) AS date, l_quantity AS pm25,
      l_quantity, ln(greatest(l_quantity, 1.0)) * 0.7 + l_discount * 12.0 AS lgbm, ln(greatest(l_quantity, 1.0)) * 0.9 + l_tax * 5.0 AS xgb_ratio,
      ln(greatest(l_quantity, 1.0)) * 0.5 + ln(l_extendedprice / 20000.0 + 1.0) AS catboost,
      2.5::DOUBLE + ln(greatest(l_quantity, 1.0)) * 0.1 + l_discount * 2.0 AS extratrees, l_extendedprice / 2500.0 + 1.0 AS cams_pm25,
      0.05::DOUBLE + l_tax AS cal_sigma_log, CAST(l_orderkey % 5 AS INTEGER) AS fold
    FROM lineitem)
  JOIN (SELECT site_id, country, is_reference, lat, lon, network FROM stations) USING (site_id))"""

SCORES_SQL = """count(*) AS n, {k0}corr({p}, {o}){k1} AS r, {k0}1 - sum(({p} - {o}) * ({p} - {o})) / (var_pop({o}) * count(*)){k1} AS r2,
  {k0}sqrt(avg(({p} - {o}) * ({p} - {o}))){k1} AS rmse, {k0}avg(abs({p} - {o})){k1} AS mae, {k0}avg({p} - {o}){k1} AS mb,
  {k0}sum({p} - {o}) / sum({o}){k1} AS nmb, {k0}regr_slope({p}, {o}){k1} AS slope, {k0}avg({o}){k1} AS mean_obs"""


def scores_sql(obs: str, pred: str, nd: int = 4) -> str:
    return SCORES_SQL.format(o=obs, p=pred, k0="round(", k1=f" + {NUDGE}, {nd}) + 0.0")
