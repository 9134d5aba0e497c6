"""Streams, late data, tiers and guarded inputs."""

from pyspark.sql import functions as F

from dustline.functions import scalars as S
from dustline.operators import qc
from dustline.registry import feeds as X
from dustline.registry.core import query
from dustline.registry.feeds import r, sr
from dustline.session import fresh_path
from dustline.streaming import ingest, stateful

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def reading_stream(spark, sf):
    e = ingest.file_stream(spark, f"{sf}/events*.parquet", EVENTS)
    kind = F.when(F.col("event_type") == "error", "relativehumidity").when(F.col("event_type") == "signup", "temperature").otherwise("pm25")
    value = F.floor(F.col("value") / 20.0) * 50.0 - 20.0 + F.pmod("user_id", F.lit(2)) * 25.0
    return e.select(F.concat(F.lit("oaq_"), F.pmod("user_id", F.lit(5)).cast("string")).alias("site_id"), F.concat(F.lit("s"), F.pmod("user_id", F.lit(3)).cast("string")).alias("sensors_id"),
                    F.col("ts").cast("timestamp").alias("time"), kind.alias("parameter"), value.alias("value"))


@query("J3 J1 J2", X.with_(X.READINGS, X.HOURLY) + f"SELECT site_id, epoch(hr)::BIGINT AS sec, {sr('pm25', 'pm25')} FROM hourly")
def streamed_hourly_means(spark, sf):
    good = reading_stream(spark, sf).where((F.col("parameter") == "pm25") & qc.physical_range(F.col("value")))
    return ingest.ingest_hours(spark, good).select("site_id", F.col("hour").cast("long").alias("sec"), r("pm25"))


@query("J4", X.with_(X.READINGS) + "SELECT DISTINCT site_id, sensors_id, epoch(date_trunc('hour', time))::BIGINT AS sec FROM readings")
def streamed_deduplication(spark, sf):
    s = reading_stream(spark, sf).withColumn("time", F.date_trunc("hour", "time"))
    out = fresh_path(spark, "dedup")
    ingest.run_available(ingest.deduplicated(s, ["site_id", "sensors_id", "time"]), out, "append", fresh_path(spark, "dedup-state"))
    return spark.read.schema("site_id string, sensors_id string, time timestamp, parameter string, value double").parquet(out).select("site_id", "sensors_id", F.col("time").cast("long").alias("sec"))


@query("J5 K7", X.with_(X.READINGS, X.HOURLY, X.FLAGGED) + "SELECT site_id, epoch(hr)::BIGINT AS sec, stuck FROM flagged")
def streamed_stuck_flags(spark, sf, parts=4):
    """Site-hours come in ``parts`` deliveries; a third of the hours of each comes with the next one only, and rows are in no order.
    Then two clock rows: the first moves the watermark past all hours, timers run in the batch of the next."""
    raw = X.readings(spark, sf)
    h = qc.hourly_mean(raw.where((F.col("parameter") == "pm25") & qc.physical_range(F.col("value"))))
    h = h.select("site_id", "hour", "pm25", F.col("hour").cast("long").alias("sec"))
    bounds = h.select(F.min("sec").alias("lo"), F.max("sec").alias("hi"))
    step = (F.col("hi") - F.col("lo") + 3600) / parts
    due = F.floor((F.col("sec") - F.col("lo")) / step).cast("int") + (F.pmod(F.xxhash64("site_id", "hour"), F.lit(3)) == 0).cast("int")
    h = h.crossJoin(F.broadcast(bounds)).select("site_id", "hour", "pm25", due.alias("due"), F.ceil(step / 3600).alias("hours")).persist()
    last = h.agg(F.max("hour").alias("last"), F.max("hours").alias("hours")).head()
    src, state = fresh_path(spark, "hours"), fresh_path(spark, "stuck-state")
    log = ingest.UpsertLog(spark, fresh_path(spark, "stuck"), ["site_id", "hour"])
    clock = [spark.range(1).select(F.lit(None).cast("string").alias("site_id"), (F.lit(last["last"]) + F.expr(f"interval {400 + i} days")).cast("timestamp").alias("hour"),
                                   F.lit(None).cast("double").alias("pm25")) for i in range(2)]
    for part in [h.where(F.col("due") == i).drop("due", "hours") for i in range(parts + 1)] + clock:
        part.write.mode("append").parquet(src)
        s = ingest.file_stream(spark, src, "site_id string, hour timestamp, pm25 double")
        ingest.run_available(stateful.stuck_stream(s, f"{2 * last['hours'] + 1} hours"), log.write, "append", state)
    h.unpersist()
    return log.read().select("site_id", F.col("hour").cast("long").alias("sec"), "stuck")


@query("J1 F8", "SELECT user_id, date, round(round(v, 4) + CASE WHEN date >= DATE '2024-01-19' THEN 1000 ELSE 0 END, 4) AS value FROM (SELECT user_id, CAST(ts AS DATE) AS date, arg_max(value, event_id) AS v FROM events GROUP BY ALL)")
def late_batch_upsert(spark, sf):
    """The last days are read again and replace the earlier rows; replaying the batch changes nothing."""
    from dustline.operators.tables import keep_last
    e = X.table(spark, sf, "events").select("user_id", F.to_date("ts").alias("date"), "event_id", "value")
    d = keep_last(e, ["user_id", "date"], F.col("event_id")).select("user_id", "date", F.round("value", 4).alias("value"))
    log = ingest.UpsertLog(spark, fresh_path(spark, "late"), ["user_id", "date"])
    log.write(d, 0)
    again = d.where("date >= '2024-01-19'").withColumn("value", F.col("value") + 1000)
    for _ in range(2):
        log.write(again, 1)
    return log.read().select("user_id", "date", F.round("value", 4).alias("value"))


@query("J2 J6 I26", X.with_(X.SITE_DAYS) + f""", t AS (SELECT DATE '2024-12-20' AS today)
SELECT site_id, date, {sr("pm25 * CASE WHEN date BETWEEN today - 7 AND today + 1 THEN 2 ELSE 1 END",'pm25')}, CASE WHEN date > today THEN 'forecast' WHEN date = today THEN 'nowcast' WHEN today - date < 7 THEN 'nrt' ELSE 'final' END AS tier FROM site_days, t""")
def rerun_of_open_days(spark, sf):
    today = F.lit("2024-12-20").cast("date")
    d = X.site_days(spark, sf).select("site_id", "date", "pm25")
    run = ingest.open_days(d, today).withColumn("pm25", F.col("pm25") * 2)
    m = ingest.merge_run(d, run, today)
    return m.select("site_id", "date", r("pm25"), S.product_tier(F.col("date"), today).alias("tier"))


@query("J7 B20", "SELECT CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_day, count(*) AS n, true AS failed FROM events")
def guarded_input(spark, sf):
    freshness = {}
    df = ingest.guarded("fires", lambda: spark.read.parquet(f"{sf}/no-such-input.parquet"), lambda: X.table(spark, sf, "events"), freshness)
    return df.agg(F.max(F.to_date("ts")).cast("string").alias("last_day"), F.count(F.lit(1)).alias("n")).withColumn("failed", F.lit("fires_error" in freshness))
