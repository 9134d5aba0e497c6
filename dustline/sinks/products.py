"""Product packing and partitioned writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions import geo

PACKED = ("pm25", "lower90", "upper90", "stage1", "cams_pm25")
FILL = -32768
CUBE_NODATA, CUBE_MAX = 65535, 65534


def pack_short(x: Column) -> Column:
    """Scaled 16-bit integer, tenth of a unit, half to even."""
    return F.coalesce(F.rint(x * 10).cast("int"), F.lit(FILL)).cast("short")


def pack_day(df: DataFrame, columns: Sequence[str] = PACKED) -> DataFrame:
    return df.withColumns({c: pack_short(F.col(c)) for c in columns if c in df.columns})


def _bounded(x: Column, top: int) -> Column:
    return F.least(F.greatest(F.rint(x), F.lit(0.0)), F.lit(float(top))).cast("int")


def encode_day(df: DataFrame) -> DataFrame:
    """Byte channels of a cell: high and low byte, code, two bound ratios, composition."""
    pm, valid = F.col("pm25"), F.col("pm25").isNotNull()
    safe = F.when(pm != 0, pm)
    v = F.when(valid, _bounded(pm * 10, 65535)).otherwise(0)
    code = F.when(~valid, 0).when(F.col("inside_aoa") == 1, 2).otherwise(1)
    ratio = lambda bound, k: F.when(valid, F.coalesce(_bounded(F.col(bound) / safe * k, 255), F.lit(0))).otherwise(0)
    cams = F.when(valid, _bounded(F.coalesce("cams_pm25", F.lit(0.0)), 255)).otherwise(0)
    return df.withColumns({"hi": F.shiftright(v, 8), "lo": v.bitwiseAND(255), "code": code,
                           "lo_ratio": ratio("lower90", 250), "hi_ratio": ratio("upper90", 40), "cams": cams})


def decode_day(df: DataFrame) -> DataFrame:
    """Inverse of the byte encoding; code 0 is NULL."""
    known = F.col("code") != 0
    v = (F.col("hi") * 256 + F.col("lo")) / 10
    return df.withColumns({
        "pm25_d": F.when(known, v), "lower90_d": F.when(known, v * F.col("lo_ratio") / 250),
        "upper90_d": F.when(known, v * F.col("hi_ratio") / 40), "cams_d": F.when(known, F.col("cams"))})


def cube_value(x: Column) -> Column:
    return F.when(x.isNotNull(), _bounded(x * 10, CUBE_MAX)).otherwise(CUBE_NODATA)


def uncube(x: Column) -> Column:
    return F.when(x != CUBE_NODATA, x * 0.1)


def cell_rows(df: DataFrame) -> DataFrame:
    """Valid cells as text-ready rows: coordinates from the index, one decimal."""
    return df.where(F.col("code") != 0).select(
        "date", F.format_string("%.3f", geo.row_lat(F.col("row"))).alias("lat"),
        F.format_string("%.3f", geo.col_lon(F.col("col"))).alias("lon"),
        F.round("pm25_d", 1).alias("pm25"), F.round("lower90_d", 1).alias("lower90"),
        F.round("upper90_d", 1).alias("upper90"), F.col("cams_d").alias("cams_pm25"),
        (F.col("code") == 2).cast("int").alias("inside_aoa"))


def write_days(df: DataFrame, path: str, date: str = "date") -> None:
    """Daily partitions; rewriting a day replaces only that day.

    The rebalance hint gathers a day into few files and splits a day that is too large.
    """
    (df.hint("rebalance", date).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date).parquet(path))


def read_days(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def classify_asset(name: Column, prefix: str) -> tuple[Column, Column]:
    """Kind and period of a published file from its name."""
    kinds = (("daily_month", f"{prefix}_daily_"), ("monthly_mean", f"{prefix}_monthly_mean_"),
             ("annual_mean", f"{prefix}_annual_mean_"))
    kind = period = None
    for label, start in kinds:
        hit = name.startswith(start)
        body = name.substr(F.lit(len(start) + 1), F.length(name) - len(start) - 4)
        kind = F.when(hit, label) if kind is None else kind.when(hit, label)
        period = F.when(hit, body) if period is None else period.when(hit, body)
    stats = name.endswith("statistics.csv")
    kind = kind.when(stats, "region_stats").when(name.endswith("README.txt"), "readme").otherwise("other")
    period = period.when(stats, "daily").otherwise("")
    return kind, period
