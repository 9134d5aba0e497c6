"""Automatic weather stations: metadata, variables, nested measurements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATION_SCHEMA = ("struct<data: array<struct<code: string, name: string, active: boolean, installationdate: string, "
                  "location: struct<name: string, latitude: string, longitude: string, elevationmsl: string, "
                  "countrycode: string>>>>")
VARIABLE_SCHEMA = "struct<data: array<struct<variable: struct<shortcode: string, description: string, units: string>>>>"
MEASUREMENT_SCHEMA = "struct<results: array<struct<series: array<struct<columns: array<string>, values: array<array<string>>>>>>>"


def stations(docs: DataFrame, json: str = "body") -> DataFrame:
    rows = docs.select(F.explode(F.from_json(json, STATION_SCHEMA)["data"]).alias("e"))
    number = {n: F.col(f"e.location.{src}").try_cast("double").alias(n)
              for n, src in (("lat", "latitude"), ("lon", "longitude"), ("elev", "elevationmsl"))}
    return (rows.select(F.col("e.code").alias("code"),
                        F.coalesce(F.nullif("e.location.name", F.lit("")), F.nullif("e.name", F.lit("")), "e.code").alias("name"),
                        *number.values(), F.col("e.location.countrycode").alias("country"),
                        F.coalesce("e.active", F.lit(True)).alias("active"),
                        F.col("e.installationdate").alias("installed"))
            .where("lat is not null and lon is not null"))


def variables(docs: DataFrame, json: str = "body") -> DataFrame:
    rows = docs.select(F.explode(F.from_json(json, VARIABLE_SCHEMA)["data"]).alias("e"))
    return rows.where("e.variable is not null").select("e.variable.shortcode", "e.variable.description", "e.variable.units")


def measurements(docs: DataFrame, json: str = "body", keys: tuple[str, ...] = ("code",)) -> DataFrame:
    """Nested result series to long rows; a value whose quality flag is not 1 is NULL."""
    series = (docs.select(*keys, F.explode(F.from_json(json, MEASUREMENT_SCHEMA)["results"]).alias("r"))
              .select(*keys, F.explode("r.series").alias("s")))
    rows = series.select(*keys, F.col("s.columns").alias("_c"), F.explode("s.values").alias("_v"))

    def field(name: str):
        at = F.array_position("_c", name)
        return F.when(at > 0, F.try_element_at("_v", at.cast("int")))

    good = (F.array_position("_c", "quality") == 0) | (field("quality").try_cast("int") == 1)
    return rows.select(*keys, F.try_to_timestamp(field("time")).alias("time"), field("variable").alias("variable"),
                       field("sensor").alias("sensor"),
                       F.when(good, field("value").try_cast("double")).alias("value"))


def latest_readings(docs: DataFrame, json: str = "body") -> DataFrame:
    """Live latest-value response to rows."""
    schema = ("struct<results: array<struct<locationsId: bigint, value: double, datetime: struct<utc: string>, "
              "coordinates: struct<latitude: double, longitude: double>>>>")
    r = docs.select(F.explode(F.from_json(json, schema)["results"]).alias("r"))
    return r.select(F.col("r.locationsId").alias("location_id"), F.col("r.value").alias("value"),
                    F.try_to_timestamp("r.datetime.utc").alias("time"), F.col("r.coordinates.latitude").alias("lat"),
                    F.col("r.coordinates.longitude").alias("lon"))
