"""Set operations, top-k, keep-last, clipping, inventories."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dustline.functions import geo
from dustline.operators import tables
from dustline.registry import feeds as X
from dustline.registry.core import query
from dustline.registry.feeds import r, sr
from dustline.sources import ground


@query("F8 J1 H2", "SELECT user_id, CAST(ts AS DATE) AS date, arg_max(event_id, event_id) AS event_id, round(arg_max(value, event_id), 4) AS value FROM events GROUP BY ALL")
def latest_row_per_key(spark, sf):
    e = X.table(spark, sf, "events").select("user_id", F.to_date("ts").alias("date"), "event_id", "value")
    return tables.keep_last(e, ["user_id", "date"], F.col("event_id")).withColumn("value", F.round("value", 4))


@query("F8 A3", "SELECT user_id, event_type, arg_min(event_id, ts) AS event_id FROM events GROUP BY ALL")
def first_row_per_key(spark, sf):
    e = X.table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    return tables.keep_first(e, ["user_id", "event_type"], F.col("ts")).select("user_id", "event_type", "event_id")


@query("H3 J1", """WITH o AS (SELECT l_suppkey AS site, CAST(l_shipdate AS DATE) AS date, l_quantity AS v FROM lineitem), n AS (SELECT * FROM o WHERE date >= DATE '2001-06-01')
SELECT site, count(*) AS n, round(sum(v), 2) AS total FROM (SELECT * FROM o WHERE date NOT IN (SELECT date FROM n) UNION ALL SELECT site, date, v * 3 FROM n) GROUP BY site""")
def replaced_dates(spark, sf):
    o = X.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("site"), F.to_date("l_shipdate").alias("date"), F.col("l_quantity").alias("v"))
    n = o.where("date >= '2001-06-01'").withColumn("v", F.col("v") * 3)
    return tables.replace_dates(o, n).groupBy("site").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v"), 2).alias("total"))


@query("H4 C4", "SELECT o_custkey, o_orderdate::DATE AS date, count(*) AS n FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL UNION ALL SELECT o_custkey, o_orderdate::DATE, count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders u WHERE u.o_orderpriority = '1-URGENT' AND u.o_custkey = o.o_custkey AND u.o_orderdate::DATE = o.o_orderdate::DATE) GROUP BY ALL")
def appended_missing_keys(spark, sf):
    o = X.table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"), "o_orderpriority")
    count = lambda d: d.groupBy("o_custkey", "date").agg(F.count(F.lit(1)).alias("n"))
    return tables.append_missing(count(o.where("o_orderpriority = '1-URGENT'")), count(o), ["o_custkey", "date"])


@query("H5", "SELECT DISTINCT l_suppkey AS site_id, l_partkey FROM lineitem WHERE l_returnflag = 'A' EXCEPT SELECT l_suppkey, l_partkey FROM lineitem WHERE l_linestatus = 'O'")
def set_difference(spark, sf):
    li = X.table(spark, sf, "lineitem")
    a = li.where("l_returnflag = 'A'").select(F.col("l_suppkey").alias("site_id"), "l_partkey")
    return a.subtract(li.where("l_linestatus = 'O'").select(F.col("l_suppkey").alias("site_id"), "l_partkey"))


@query("H1 H2", "SELECT id, kind, balance, size FROM (SELECT s_suppkey AS id, 'supplier' AS kind, s_acctbal AS balance, NULL::INTEGER AS size FROM supplier UNION ALL SELECT p_partkey, 'part', NULL, p_size FROM part)")
def union_with_missing_columns(spark, sf):
    s = X.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"))
    p = X.table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.lit("part").alias("kind"), F.col("p_size").alias("size"))
    return s.unionByName(p, allowMissingColumns=True)


@query("C4 D5", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AND (c_nationkey, c_mktsegment) NOT IN (SELECT s_nationkey, 'MACHINERY' FROM supplier)")
def membership_filters(spark, sf):
    c = X.table(spark, sf, "customer")
    late = X.table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    ban = X.table(spark, sf, "supplier").select(F.col("s_nationkey").alias("c_nationkey"), F.lit("MACHINERY").alias("c_mktsegment")).distinct()
    return c.join(late, "c_custkey", "left_semi").join(ban, ["c_nationkey", "c_mktsegment"], "left_anti").select("c_custkey", "c_mktsegment")


@query("C12", "SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS date FROM lineitem WHERE l_shipdate::DATE BETWEEN (SELECT min(o_orderdate)::DATE + 200 FROM orders) AND (SELECT max(o_orderdate)::DATE FROM orders)")
def clipped_to_coverage(spark, sf):
    li = X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("date"))
    axis = X.table(spark, sf, "orders").agg(F.date_add(F.min(F.to_date("o_orderdate")), 200).alias("a"), F.max(F.to_date("o_orderdate")).alias("b"))
    span = axis.select(F.explode(F.array("a", "b")).alias("date"))
    return tables.clip_to_axis(li, span)


@query("C1 C2 C5", "SELECT event_id, value FROM (SELECT event_id, value * 4 - 40 AS value, CASE WHEN event_id % 7 <> 0 THEN user_id END AS u FROM events) WHERE value > 0 AND value <= 1000 AND u IS NOT NULL")
def physical_range_rows(spark, sf):
    from dustline.operators.qc import physical_range
    e = X.table(spark, sf, "events").select("event_id", (F.col("value") * 4 - 40).alias("value"), F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("u"))
    return e.where(physical_range(F.col("value"))).dropna(subset=["u"]).select("event_id", "value")


@query("C7 F13 G4 E34", X.with_(X.STATIONS, X.SITE_DAYS) + f"SELECT site_id, name, network, count(*) AS n_days, max(date) AS last_day, {sr('arg_max(pm25, date)','last_value')} FROM stations JOIN site_days USING (site_id) WHERE country = 'GH' AND network <> 'IQAir' AND contains(lower(name), 'supplier#0') GROUP BY ALL")
def station_table(spark, sf):
    st, d = X.stations(spark, sf), X.site_days(spark, sf)
    last = d.groupBy("site_id").agg(F.max("date").alias("last_day"), F.max_by("pm25", "date").alias("last_value"))
    s = ground.with_day_counts(st, d).join(last, "site_id").where((F.col("country") == "GH") & (F.col("network") != "IQAir") & (F.instr(F.lower("name"), "supplier#0") > 0))
    return s.select("site_id", "name", "network", "n_days", "last_day", r("last_value")).orderBy(F.col("n_days").desc_nulls_last())


@query("G2", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def top_values(spark, sf):
    return X.table(spark, sf, "part").select("p_partkey", "p_retailprice").orderBy(F.col("p_retailprice").desc(), "p_partkey").limit(20)


@query("G3", X.with_(X.SITE_DAYS) + f"SELECT site_id, date, {sr('pm25','pm25')} FROM (SELECT *, row_number() OVER (PARTITION BY site_id ORDER BY date DESC) AS rn FROM site_days) WHERE rn <= 60")
def series_tail(spark, sf):
    """Last sixty points of each station; a station has one row per calendar day."""
    w = W.partitionBy("site_id").orderBy(F.col("date").desc())
    return X.site_days(spark, sf).withColumn("_r", F.row_number().over(w)).where("_r <= 60").select("site_id", "date", r("pm25"))


@query("G5", "SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY md5('0:' || l_orderkey || ':' || l_linenumber), l_orderkey, l_linenumber LIMIT 2000")
def deterministic_sample(spark, sf):
    return tables.deterministic_sample(X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 2000)


@query("E31 E8", X.with_(X.STATIONS, X.SITE_DAYS) + f"SELECT country, network, count(DISTINCT site_id) AS sites, count(*) AS days, min(date) AS first_day, max(date) AS last_day, {sr('avg(pm25)','mean')}, CASE WHEN bool_or(is_reference) THEN 'reference' ELSE 'low-cost' END AS grade FROM site_days JOIN stations USING (site_id) GROUP BY ALL")
def network_summary(spark, sf):
    d = X.site_days(spark, sf).join(X.stations(spark, sf), "site_id")
    g = d.groupBy("country", "network").agg(F.count_distinct("site_id").alias("sites"), F.count(F.lit(1)).alias("days"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.avg("pm25").alias("mean"),
                                            F.when(F.bool_or("is_reference"), "reference").otherwise("low-cost").alias("grade"))
    return g.select("country", "network", "sites", "days", "first_day", "last_day", r("mean"), "grade")


@query("E32 G2", X.with_(X.STATIONS, X.SITE_DAYS) + """, g AS (SELECT date_trunc('month', date)::DATE AS month, country || ' · ' || network AS grp, count(*) AS n FROM site_days JOIN stations USING (site_id) GROUP BY ALL),
top AS (SELECT grp FROM g GROUP BY grp ORDER BY sum(n) DESC, grp LIMIT 8)
SELECT month, CASE WHEN grp IN (SELECT grp FROM top) THEN grp ELSE 'Other' END AS grp, CAST(sum(n) AS BIGINT) AS station_days FROM g GROUP BY ALL""")
def network_timeline(spark, sf):
    d = X.site_days(spark, sf).join(X.stations(spark, sf), "site_id")
    g = d.groupBy(F.trunc("date", "month").alias("month"), F.concat_ws(" · ", "country", "network").alias("grp")).agg(F.count(F.lit(1)).alias("n"))
    top = g.groupBy("grp").agg(F.sum("n").alias("t")).orderBy(F.col("t").desc(), "grp").limit(8).select("grp", F.lit(True).alias("top"))
    named = g.join(F.broadcast(top), "grp", "left").withColumn("grp", F.when(F.col("top"), F.col("grp")).otherwise("Other"))
    return named.groupBy("month", "grp").agg(F.sum("n").alias("station_days"))


@query("E33 N1 I1", X.with_(X.STATIONS, X.SITE_DAYS) + f"SELECT site_id, min(date) AS first_day, max(date) AS last_day, count(CASE WHEN n_hours > 1 THEN pm25 END) AS days_pm25, count(rh) AS days_rh, {sr(X.hav('any_value(lat)','any_value(lon)','5.60','-0.19'),'km_from_centre',1)} FROM site_days JOIN stations USING (site_id) GROUP BY site_id")
def station_inventory(spark, sf):
    d = X.site_days(spark, sf).join(X.stations(spark, sf).select("site_id", "lat", "lon"), "site_id")
    g = d.groupBy("site_id", "lat", "lon").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count(F.when(F.col("n_hours") > 1, F.col("pm25"))).alias("days_pm25"), F.count("rh").alias("days_rh"))
    return g.select("site_id", "first_day", "last_day", "days_pm25", "days_rh", r(geo.haversine_km(F.col("lat"), F.col("lon"), F.lit(5.60), F.lit(-0.19)), 1, "km_from_centre"))


@query("F12 J8", "SELECT user_id, max(CAST(ts AS DATE)) AS last_day, max(CAST(ts AS DATE)) > DATE '2024-02-15' - 30 AS active, count(DISTINCT CAST(ts AS DATE)) FILTER (CAST(ts AS DATE) >= DATE '2024-01-30' - 4) AS stale_days FROM events GROUP BY user_id")
def station_activity(spark, sf):
    days = X.table(spark, sf, "events").select("user_id", F.to_date("ts").alias("date")).distinct()
    stale = ground.stale_partitions(days, F.lit("2024-01-30").cast("date")).groupBy("user_id").agg(F.count(F.lit(1)).alias("s"))
    g = days.groupBy("user_id").agg(F.max("date").alias("last_day")).join(stale, "user_id", "left")
    return g.select("user_id", "last_day", (F.col("last_day") > F.date_sub(F.lit("2024-02-15").cast("date"), 30)).alias("active"), F.coalesce("s", F.lit(0)).alias("stale_days"))


@query("J8", """WITH d AS (SELECT DISTINCT CASE user_id % 4 WHEN 0 THEN 'archive' WHEN 1 THEN 'weather_reanalysis' WHEN 2 THEN 'weather_stations' ELSE 'static' END AS source, CAST(ts AS DATE) AS date FROM events)
SELECT source, date FROM d WHERE (source = 'archive' AND date >= DATE '2024-01-25' - 4) OR (source = 'weather_reanalysis' AND date >= DATE '2024-01-25' - 30) OR (source = 'weather_stations' AND date >= DATE '2023-12-01')""")
def refreshed_days(spark, sf):
    """Landed days that a run reads again: four days, thirty days, or this month and the last one, by source."""
    kind = F.element_at(F.array(*map(F.lit, ("archive", "weather_reanalysis", "weather_stations", "static"))), (F.pmod("user_id", F.lit(4)) + 1).cast("int"))
    landed = X.table(spark, sf, "events").select(kind.alias("source"), F.to_date("ts").alias("date")).distinct()
    return ground.refresh_set(landed, F.lit("2024-01-25").cast("date"))


@query("H1 G1", X.with_(X.SITE_DAYS) + f"SELECT date, site_id, {sr('pm25','pm25')} FROM site_days")
def ordered_site_days(spark, sf):
    return X.site_days(spark, sf).select("date", "site_id", r("pm25")).orderBy("date", "site_id")
