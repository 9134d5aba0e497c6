"""Polygons and lines as edge tables; comparison products; raster pixels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE_SCHEMA = ("struct<features: array<struct<properties: struct<shapeName: string>, "
                  "geometry: struct<type: string, coordinates: string>>>>")


def _ring_edges(ring: Column) -> Column:
    """Consecutive vertex pairs of a ring, closing it when its last vertex is not its first."""
    first, last = ring[0], F.element_at(ring, -1)
    closed = F.when((first[0] == last[0]) & (first[1] == last[1]), ring).otherwise(F.concat(ring, F.array(first)))
    return F.zip_with(F.slice(closed, 1, F.size(closed) - 1), F.slice(closed, 2, F.size(closed) - 1),
                      lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")))


def polygon_edges(docs: DataFrame, json: str = "body", keys: Sequence[str] = ()) -> DataFrame:
    """Feature collections of polygons and multipolygons to ``feature_id, name, ring, x1, y1, x2, y2``.

    The feature id is the position in the collection, which also decides overlaps.
    """
    feats = docs.select(*keys, F.posexplode(F.from_json(json, FEATURE_SCHEMA)["features"]).alias("feature_id", "_f"))
    poly = F.from_json(F.col("_f.geometry.coordinates"), "array<array<array<double>>>")
    multi = F.flatten(F.from_json(F.col("_f.geometry.coordinates"), "array<array<array<array<double>>>>"))
    rings = feats.select(*keys, "feature_id", F.col("_f.properties.shapeName").alias("name"),
                         F.posexplode(F.when(F.col("_f.geometry.type") == "Polygon", poly).otherwise(multi))
                         .alias("ring", "_r"))
    return rings.select(*keys, "feature_id", "name", "ring", F.explode(_ring_edges(F.col("_r"))).alias("e")) \
        .select(*keys, "feature_id", "name", "ring", "e.x1", "e.y1", "e.x2", "e.y2")


def line_segments(lines: DataFrame, points: str = "points", keys: Sequence[str] = ()) -> DataFrame:
    """Polylines (arrays of [x, y]) to segments; single points have none."""
    p = F.col(points)
    segments = F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1),
                          lambda a, b: F.struct(a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")))
    return (lines.where(F.size(p) >= 2).select(*keys, F.explode(segments).alias("e"))
            .select(*keys, "e.x1", "e.y1", "e.x2", "e.y2"))


def read_comparison(spark: SparkSession, glob: str) -> DataFrame:
    """City-day comparison product: every CSV matching the glob."""
    return (spark.read.schema("City string, Date string, PM25 double").option("header", True).csv(glob)
            .select("City", F.to_date("Date").alias("date"), "PM25"))
