"""Sensor archive, reference monitors and the station registry, from landed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions import geo
from dustline.operators import tables

ARCHIVE_SCHEMA = ("location_id string, sensors_id string, location string, datetime string, lat string, lon string, "
                  "parameter string, units string, value string")
REFERENCE_SCHEMA = "Site string, Parameter string, Year string, Month string, Day string, Hour string, " \
                   "`Raw Conc.` string, `QC Name` string"
REGISTRY_SCHEMA = ("location_id bigint, name_s3 string, provider string, owner string, country string, lat double, "
                   "lon double, s3_last_day string, s3_n_days int")


def _later(digits: str) -> list[str]:
    """Glob patterns of the numbers of as many digits that are not below ``digits``."""
    out = [digits]
    for i, d in enumerate(digits):
        if d < "9":
            out.append(f"{digits[:i]}[{int(d) + 1}-9]{'?' * (len(digits) - i - 1)}")
    return out


def dated_names(first: str, end: str = ".csv.gz") -> str:
    """Glob of the file names whose date, ``-YYYYMMDD`` before ``end``, is not before ``first``, and of names without such a date."""
    dated = [f"*-{d}{end}" for d in _later(first)]
    undated = [f"*[^-]{'?' * 8}{end}", *[f"*{'?' * i}[^0-9]{'?' * (7 - i)}{end}" for i in range(8)], *[f"{'?' * n}{end}" for n in range(9)]]
    return "{" + ",".join(dated + undated) + "}"


def archive_folders(spark: SparkSession, base: str, first: str) -> list[str]:
    """Folders that can hold files from ``first`` (YYYYMMDD) on: whole later years, and the later months of the first year.

    Only the names of year and month folders are listed, not what is in them.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def found(pattern: str) -> list[tuple[int, str]]:
        got = [x.getPath().toString() for x in fs.globStatus(path(f"{base}/{pattern}")) or []]
        return [(int(p.rsplit("=", 1)[1]), p) for p in got if p.rsplit("=", 1)[1].isdigit()]

    year, month = int(first[:4]), int(first[4:6])
    later = [p for y, p in found("locationid=*/year=*") if y > year]
    return later + [p for m, p in found(f"locationid=*/year={year}/month=*") if m >= month]


def read_archive(spark: SparkSession, base: str, start: str, parameters: Sequence[str] = P.SENSOR_PARAMETERS) -> DataFrame:
    """Daily gzip CSV files below ``locationid=/year=/month=`` from ``start`` on.

    Folders before the start's month are not listed, and files named with an earlier date are left out
    of the listing, so neither is opened. Malformed lines are dropped and offset timestamps become UTC.
    """
    first = start.replace("-", "")
    folders = archive_folders(spark, base, first)
    reader = spark.read.schema(f"{ARCHIVE_SCHEMA}, locationid string, year int, month int")
    if folders:
        raw = (reader.option("header", True).option("mode", "DROPMALFORMED").option("basePath", base)
               .option("pathGlobFilter", dated_names(first)).csv(folders))
    else:
        raw = spark.createDataFrame([], f"{ARCHIVE_SCHEMA}, locationid string, year int, month int")
    return (raw.where(F.col("parameter").isin(*parameters))
            .select(F.concat(F.lit("oaq_"), "location_id").alias("site_id"), "sensors_id",
                    F.to_timestamp(F.try_to_timestamp("datetime")).alias("time"), "parameter",
                    F.col("value").try_cast("double").alias("value"))
            .where(F.col("time").isNotNull()))


def read_reference(spark: SparkSession, glob: str) -> DataFrame:
    """Reference-monitor CSVs named ``{City}_PM2.5_{year}_{month|YTD}_MTD.csv``.

    A year's YTD file, where there is one, replaces its monthly files. Valid hours only, one
    row per (site, time).
    """
    raw = (spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True)
           .option("ignoreTrailingWhiteSpace", True).schema(REFERENCE_SCHEMA).csv(glob))
    path = F.col("_metadata.file_path")
    label = r"([^/_]+)_PM2\.5_(\d{4})_([^/]*)"
    tagged = raw.select("*", F.lower(F.regexp_extract(path, label, 1)).alias("city"),
                        F.regexp_extract(path, label, 2).alias("file_year"),
                        F.regexp_extract(path, label, 3).contains("YTD").alias("is_ytd"))
    has_ytd = (tagged.where("is_ytd").select("city", "file_year").distinct().withColumn("_y", F.lit(True)))
    used = (tagged.join(has_ytd, ["city", "file_year"], "left")
            .where(F.col("is_ytd") | F.col("_y").isNull()))
    valid = used.where(F.lower(F.trim("QC Name")) == "valid")
    number = [F.col(c).try_cast("int") for c in ("Year", "Month", "Day", "Hour")]
    rows = valid.select(F.concat(F.lit("emb_"), "city").alias("site_id"), F.lit("bam").alias("sensors_id"),
                        F.try_make_timestamp(*number, F.lit(0), F.lit(0)).alias("time"), F.lit("pm25").alias("parameter"),
                        F.col("`Raw Conc.`").try_cast("double").alias("value"))
    return tables.keep_first(rows, ["site_id", "time"], F.coalesce("value", F.lit(1e18)))


def registry(rows: DataFrame, min_days: int = 20, start: str = P.START_DATE) -> DataFrame:
    """Station dimension from the location registry."""
    box = P.REGION_BOX
    legacy = F.col("location_id").isin(*P.LEGACY_LOCATIONS)
    unknown = F.col("country").startswith("unknown")
    home = F.col("lat").between(4.5, 11.3) & F.col("lon").between(-3.3, 1.3)
    kept = rows.where((F.col("s3_last_day").try_cast("date") >= F.lit(start).cast("date"))
                      & (F.col("s3_n_days") >= min_days) & geo.in_box(F.col("lat"), F.col("lon"), box))
    pairs = rows.sparkSession.createDataFrame(list(P.EXCLUDED_PROVIDERS), "country string, provider string")
    kept = tables.anti_pairs(kept, pairs, ["country", "provider"])
    provider = F.when(legacy, P.LEGACY_LABEL).otherwise(F.col("provider"))
    return kept.select(
        F.concat(F.lit("oaq_"), F.col("location_id").cast("string")).alias("site_id"), "location_id",
        F.regexp_replace("name_s3", r"-\d+$", "").alias("name"),
        F.when(unknown & home, "GH").otherwise(F.col("country")).alias("country"),
        F.coalesce(provider, F.lit("Unknown")).alias("network"), "owner", "lat", "lon",
        F.coalesce(provider.isin(*P.REFERENCE_PROVIDERS), F.lit(False)).alias("is_reference"))


def read_registry(spark: SparkSession, path: str, **kwargs) -> DataFrame:
    rows = spark.read.schema(REGISTRY_SCHEMA).option("sep", "\t").option("header", True).csv(path)
    return registry(rows, **kwargs)


def reference_registry(spark: SparkSession) -> DataFrame:
    rows = [(f"emb_{city.lower()}", -1, f"US Embassy {city} (BAM-1020)", country, "US Embassy (AirNow)",
             "US Department of State", lat, lon, True) for city, lat, lon, country in P.REFERENCE_SITES]
    return spark.createDataFrame(rows, "site_id string, location_id bigint, name string, country string, "
                                       "network string, owner string, lat double, lon double, is_reference boolean")


def with_day_counts(stations: DataFrame, days: DataFrame) -> DataFrame:
    """Stations that have data, with their number of days."""
    return stations.join(days.groupBy("site_id").agg(F.count(F.lit(1)).alias("n_days")), "site_id")


#: When landed days of a source may still change: days back from the run, or the month of the run and the one before it.
REFRESH_DAYS = {"archive": 4, "weather_reanalysis": 30}
REFRESH_MONTHS = ("weather_stations",)


def stale_partitions(days: DataFrame, today, keep_days: int = REFRESH_DAYS["archive"]) -> DataFrame:
    """Dates whose landed files may still grow and must be read again."""
    return days.where(F.col("date") >= F.date_sub(today, keep_days))


def refresh_set(landed: DataFrame, today, source: str = "source") -> DataFrame:
    """Landed (source, date) that a run on ``today`` reads again, each source by its rule; a source without a rule is read once."""
    kind, date = F.col(source), F.col("date")
    again = F.lit(False)
    for name, back in REFRESH_DAYS.items():
        again = again | ((kind == name) & (date >= F.date_sub(today, back)))
    return landed.where(again | (kind.isin(*REFRESH_MONTHS) & (date >= F.add_months(F.trunc(today, "month"), -1))))
