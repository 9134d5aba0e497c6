"""Multi-source fire history and archive scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline.operators import fires

ARCHIVE_SCHEMA = ("latitude double, longitude double, bright_ti4 double, acq_date string, acq_time string, "
                  "confidence string, frp double, type int")


def read_archive(spark: SparkSession, glob: str, start: str, end: str) -> DataFrame:
    """Yearly archive CSVs; only the columns the rules use are parsed."""
    raw = (spark.read.schema(ARCHIVE_SCHEMA).option("header", True).csv(glob)
           .select("latitude", "longitude", "acq_date", "frp", "confidence", "type"))
    return fires.clean_archive(raw, start, end)


def history(archive: DataFrame, pixels: DataFrame, switch: str) -> DataFrame:
    """Archive before the switch date, cleaned product pixels from it on."""
    at = F.lit(switch).cast("date")
    cols = ["date", "latitude", "longitude", "frp"]
    return (archive.where(F.col("date") < at).select(*cols)
            .unionByName(fires.clean_pixels(pixels).where(F.col("date") >= at).select(*cols)))
