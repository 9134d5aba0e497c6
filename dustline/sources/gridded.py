"""Composition, weather and forecast responses: JSON documents to long rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dustline.functions import scalars as S

COMPOSITION_VARS = ("pm2_5", "pm10", "aerosol_optical_depth", "dust", "carbon_monoxide", "nitrogen_dioxide")
COMPOSITION_NAMES = {"pm2_5": "cams_pm25", "pm10": "cams_pm10", "aerosol_optical_depth": "cams_aod",
                     "dust": "cams_dust", "carbon_monoxide": "cams_co", "nitrogen_dioxide": "cams_no2"}
FORECAST_VARS = ("temperature_2m", "relative_humidity_2m", "dew_point_2m", "precipitation", "wind_speed_10m",
                 "wind_direction_10m", "surface_pressure", "shortwave_radiation", "cloud_cover",
                 "boundary_layer_height")


def _hourly_schema(variables: Sequence[str]) -> str:
    fields = ", ".join(f"{v}: array<double>" for v in variables)
    return f"struct<hourly: struct<time: array<string>, {fields}>>"


def hourly_arrays(docs: DataFrame, keys: Sequence[str], variables: Sequence[str], json: str = "body") -> DataFrame:
    """Parallel hourly arrays of one node per document to one row per hour."""
    parsed = docs.select(*keys, F.from_json(json, _hourly_schema(variables))["hourly"].alias("_h"))
    rows = parsed.select(*keys, F.explode(F.arrays_zip(
        F.col("_h.time").alias("time"), *[F.col(f"_h.{v}").alias(v) for v in variables])).alias("_r"))
    return rows.select(*keys, F.try_to_timestamp("_r.time").alias("time"), *[F.col(f"_r.{v}").alias(v) for v in variables])


def met_geojson(docs: DataFrame, parameter: str, json: str = "body") -> DataFrame:
    """Feature collection with a {yyyymmdd: value} map to (lat, lon, date, parameter); -999 is NULL."""
    schema = ("struct<features: array<struct<geometry: struct<coordinates: array<double>>, "
              "properties: struct<parameter: map<string, map<string, double>>>>>>")
    feats = docs.select(F.explode(F.from_json(json, schema)["features"]).alias("_f"))
    days = feats.select(F.col("_f.geometry.coordinates")[1].alias("lat"), F.col("_f.geometry.coordinates")[0].alias("lon"),
                        F.explode(F.col("_f.properties.parameter")[parameter]).alias("_d", "_v"))
    return days.select("lat", "lon", F.to_date("_d", "yyyyMMdd").alias("date"),
                       S.sentinel_to_null(F.col("_v"), -998.0).alias(parameter))


def forecast_hours(docs: DataFrame, keys: Sequence[str] = ("lat", "lon"), json: str = "body") -> DataFrame:
    """Hourly forecast rows with wind in m/s and its components."""
    rows = hourly_arrays(docs, keys, FORECAST_VARS, json)
    ws = S.kmh_to_ms(F.col("wind_speed_10m"))
    return (rows.withColumn("ws", ws).withColumn("u", S.wind_u(F.col("ws"), F.col("wind_direction_10m")))
            .withColumn("v", S.wind_v(F.col("ws"), F.col("wind_direction_10m"))))
