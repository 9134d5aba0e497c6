"""Hourly sensor quality control and completeness-checked daily means.

Raw readings are averaged per site and hour first. That aggregation combines on the map
side, so a site holding most of the readings costs one row per hour afterwards, and the
windows below only ever see one row per site and hour of the record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions import scalars as S


def physical_range(value: Column, low: float = P.PM_MIN, high: float = P.PM_MAX) -> Column:
    return (value > low) & (value <= high)


def hourly_mean(readings: DataFrame, out: str = "pm25", keys: tuple[str, ...] = ("site_id",)) -> DataFrame:
    return (readings.groupBy(*keys, F.date_trunc("hour", "time").alias("hour"))
            .agg(F.avg("value").alias(out)))


def flag_stuck(hourly: DataFrame, value: str = "pm25", run: int = P.STUCK_RUN) -> DataFrame:
    """Adds ``stuck``: the value equals the previous row's for at least ``run`` rows in a row."""
    by_site = W.partitionBy("site_id").orderBy("hour")
    changed = F.coalesce(F.col(value) != F.lag(value).over(by_site), F.lit(True)).cast("int")
    island = hourly.withColumn("_island", F.sum(changed).over(by_site))
    in_island = W.partitionBy("site_id", "_island").orderBy("hour")
    return island.withColumn("stuck", F.row_number().over(in_island) > run).drop("_island")


def flag_spike(hourly: DataFrame, value: str = "pm25") -> DataFrame:
    """Adds ``spike``: distance from the centred 25-hour median beyond the scaled MAD."""
    seconds = F.col("hour").cast("timestamp").cast("long")
    frame = W.partitionBy("site_id").orderBy("_sec").rangeBetween(-12 * 3600, 12 * 3600)

    def rolling_median(c: str) -> Column:
        enough = F.count(c).over(frame) >= P.HAMPEL_MIN_COUNT
        return F.when(enough, F.percentile(c, F.lit(0.5)).over(frame))

    centred = hourly.withColumn("_sec", seconds).withColumn("_med", rolling_median(value))
    deviated = centred.withColumn("_dev", F.abs(F.col(value) - F.col("_med")))
    limited = deviated.withColumn("_mad", rolling_median("_dev"))
    limit = F.greatest(F.lit(P.HAMPEL_SCALE) * F.col("_mad"), F.lit(P.HAMPEL_FLOOR))
    spike = F.coalesce(F.when(F.col("_mad").isNotNull(), F.col("_dev") > limit), F.lit(False))
    return limited.withColumn("spike", spike).drop("_sec", "_med", "_dev", "_mad")


def hourly_qc(readings: DataFrame, parameter: str = "pm25") -> DataFrame:
    """Site-hours that pass every rule, with co-reported humidity and temperature when present."""
    kept = readings.where((F.col("parameter") == parameter) & physical_range(F.col("value")))
    flagged = flag_spike(flag_stuck(hourly_mean(kept)))
    good = flagged.where(~(F.col("stuck") | F.col("spike"))).select("site_id", "hour", "pm25")
    side = (readings.where(F.col("parameter").isin("relativehumidity", "temperature"))
            .groupBy("site_id", F.date_trunc("hour", "time").alias("hour"))
            .agg(F.avg(F.when(F.col("parameter") == "relativehumidity", F.col("value"))).alias("sensor_rh"),
                 F.avg(F.when(F.col("parameter") == "temperature", F.col("value"))).alias("sensor_t")))
    return good.join(side, ["site_id", "hour"], "left")


def daily_mean(hourly: DataFrame, min_hours: int = P.DAY_MIN_HOURS, min_block: int = P.DAY_MIN_BLOCK,
               companions: tuple[str, ...] = ("sensor_rh", "sensor_t")) -> DataFrame:
    """Site-days with enough hours overall and in each six-hour block."""
    block = S.six_hour_block(F.col("hour"))
    per_block = [F.count(F.when(block == b, F.lit(1))) for b in range(4)]
    extra = [F.avg(c).alias(c) for c in companions if c in hourly.columns]
    days = hourly.groupBy("site_id", F.to_date("hour").alias("date")).agg(
        F.avg("pm25").alias("pm25"), F.count("pm25").alias("n_hours"),
        F.stddev_samp("pm25").alias("pm25_hourly_sd"), *extra,
        F.least(*per_block).alias("min_block_hours"))
    return days.where((F.col("n_hours") >= min_hours) & (F.col("min_block_hours") >= min_block))


def weather_daily(samples: DataFrame, keys: tuple[str, ...] = ("code",),
                  per_day: int = P.SAMPLES_PER_DAY) -> DataFrame:
    """Five-minute weather samples to days: duplicate sensors are averaged first, then one
    conditional aggregation per day; a day short of samples is NULL for that variable."""
    per_time = (samples.where(F.col("variable").isin(*P.WEATHER_VARIABLES))
                .groupBy(*keys, F.to_date("time").alias("date"), "time", "variable")
                .agg(F.avg("value").alias("value")))
    aggregates = []
    for code, (column, how) in P.WEATHER_VARIABLES.items():
        v = F.when(F.col("variable") == code, F.col("value"))
        n = F.count(v)
        if how == "circmean":
            a = F.radians(v)
            x = F.pmod(F.degrees(F.atan2(F.avg(F.sin(a)), F.avg(F.cos(a)))), F.lit(360.0))
        elif how == "sum":
            x = F.try_divide(F.sum(v) * per_day, n)
        elif how == "max":
            x = F.max(v)
        else:
            x = F.avg(v)
        complete = n >= P.MIN_COMPLETENESS * per_day
        aggregates.append(F.when(complete, x).alias(column))
        if code == "te":
            aggregates.append(F.when(complete, F.max(v) - F.min(v)).alias("t2m_range"))
    days = per_time.groupBy(*keys, "date").agg(*aggregates)
    return (days.withColumn("ssrd", S.watts_to_kwh_day(F.col("ssrd")))
            .withColumn("u10", S.wind_u(F.col("ws10"), F.col("wd")))
            .withColumn("v10", S.wind_v(F.col("ws10"), F.col("wd"))))


def humidity_to_percent(days: DataFrame, keys: tuple[str, ...] = ("code",)) -> DataFrame:
    """Humidity reported as a fraction (station median at most 1.5) becomes percent.

    The median runs over one station's daily values, at most one per calendar day.
    """
    medians = days.groupBy(*keys).agg(F.percentile("rh", F.lit(0.5)).alias("_med"))
    return (days.join(medians, list(keys), "left")
            .withColumn("rh", F.when(F.col("_med") <= 1.5, F.col("rh") * 100.0).otherwise(F.col("rh")))
            .drop("_med"))


def composition_daily(hourly: DataFrame, variables: dict[str, str], peak: str) -> DataFrame:
    """Node-hours to node-days: means, the peak of one variable and its number of hours."""
    return hourly.groupBy("node", F.to_date("time").alias("date")).agg(
        *[F.avg(src).alias(dst) for src, dst in variables.items()],
        F.max(peak).alias("cams_pm25_max"), F.count(peak).alias("cams_n"))


def forecast_daily(hourly: DataFrame, keys: tuple[str, ...] = ("lat", "lon")) -> DataFrame:
    """Hourly forecast to the daily weather schema with its unit changes."""
    ws = S.kmh_to_ms(F.col("wind_speed_10m"))
    days = hourly.groupBy(*keys, F.to_date("time").alias("date")).agg(
        F.avg("temperature_2m").alias("t2m"),
        (F.max("temperature_2m") - F.min("temperature_2m")).alias("t2m_range"),
        F.avg("relative_humidity_2m").alias("rh"), F.avg("dew_point_2m").alias("td2m"),
        F.coalesce(F.sum("precipitation"), F.lit(0.0)).alias("precip"), F.avg(ws).alias("ws10"),
        F.avg(S.wind_u(ws, F.col("wind_direction_10m"))).alias("u10"),
        F.avg(S.wind_v(ws, F.col("wind_direction_10m"))).alias("v10"),
        (F.avg("surface_pressure") / 10.0).alias("ps"),
        S.watts_to_kwh_day(F.avg("shortwave_radiation")).alias("ssrd"),
        F.avg("cloud_cover").alias("cloud"), F.avg("boundary_layer_height").alias("blh"))
    return days.withColumn("qv2m", S.specific_humidity_gkg(F.col("td2m"), F.col("ps")))
