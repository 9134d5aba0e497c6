"""Region statistics, exposure summaries and time-series shaping of the daily product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dustline import params as P
from dustline.functions import scalars as S
from dustline.functions.metrics import weighted_mean, weighted_share

REGION_METRICS = ("area_mean", "pop_weighted", "lower90", "upper90", "max", "population", "pop_frac_gt15",
                  "pop_frac_gt35")


def region_stats(cells: DataFrame) -> DataFrame:
    """Daily statistics for the nation, adm1 and adm2 in one pass over the cells.

    Needs date, pm25, lower90, upper90, pop, adm1_id, adm2_id; negative ids are outside.
    """
    valid = cells.where(F.col("pm25").isNotNull())
    p = F.col("pm25")
    base = valid.groupingSets([["date"], ["date", "adm1_id"], ["date", "adm2_id"]], "date", "adm1_id", "adm2_id").agg(
        F.grouping_id().alias("_g"), F.avg(p).alias("area_mean"),
        weighted_mean(p, F.col("pop")).alias("pop_weighted"), F.avg("lower90").alias("lower90"),
        F.avg("upper90").alias("upper90"), F.max(p).alias("max"), F.sum("pop").alias("population"),
        weighted_share(S.exceeds(p, P.WHO_DAILY), F.col("pop")).alias("pop_frac_gt15"),
        weighted_share(S.exceeds(p, P.NATIONAL_DAILY), F.col("pop")).alias("pop_frac_gt35"))
    # grouping_id bits: date, adm1, adm2
    level = F.when(F.col("_g") == 3, "adm0").when(F.col("_g") == 1, "adm1").otherwise("adm2")
    ident = F.when(F.col("_g") == 3, F.lit(0)).when(F.col("_g") == 1, F.col("adm1_id")).otherwise(F.col("adm2_id"))
    return (base.select("date", level.alias("level"), ident.cast("int").alias("id"), *REGION_METRICS)
            .where(F.col("id") >= 0))


def region_years(stats: DataFrame, value: str, nudge: float = 0.0) -> DataFrame:
    """One row per id, one column per calendar year of the data with the mean of ``value`` rounded to four places."""
    mean = F.round(F.avg(value) + nudge, 4) + F.lit(0.0)
    return stats.withColumn("year", F.year("date")).groupBy("id").pivot("year").agg(mean)


def dense_series(stats: DataFrame, dates: DataFrame, ids: DataFrame, values: dict[str, int]) -> DataFrame:
    """One row per (level, id) with values aligned to every date, NULL where absent.

    The spine is regions by calendar days; both are dimensions, not measurements.
    """
    axis = dates.agg(F.array_sort(F.collect_set("date")).alias("dates"))
    packed = stats.groupBy("level", "id").agg(
        F.map_from_entries(F.collect_list(F.struct("date", F.struct(*[
            F.round(S.finite(F.col(v)), nd).alias(v) for v, nd in values.items()])))).alias("_m"))
    aligned = ids.join(F.broadcast(axis)).join(packed, ["level", "id"], "left")

    def along_axis(v: str) -> Column:
        return F.transform("dates", lambda d: F.when(F.col("_m").isNotNull(), F.try_element_at("_m", d)[v])).alias(v)

    return aligned.select("level", "id", "name", "dates", *[along_axis(v) for v in values])


def spine_join(stats: DataFrame, dates: DataFrame, ids: DataFrame) -> DataFrame:
    """Long form of the same alignment: each (level, id) with every date."""
    axis = dates.agg(F.array_sort(F.collect_set("date")).alias("_dates"))
    spine = ids.join(F.broadcast(axis)).select("level", "id", F.explode("_dates").alias("date"))
    return spine.join(stats, ["level", "id", "date"], "left")


def trailing_mean(df: DataFrame, keys: Sequence[str], value: str, rows: int, min_valid: int, out: str) -> DataFrame:
    """Mean of the last ``rows`` rows by date; NULL until ``min_valid`` of them are valid."""
    w = W.partitionBy(*keys).orderBy("date").rowsBetween(-(rows - 1), 0)
    return df.withColumn(out, F.when(F.count(value).over(w) >= min_valid, F.avg(value).over(w)))


def annual_exposure(national: DataFrame) -> DataFrame:
    return national.groupBy(F.year("date").alias("year")).agg(
        F.count(F.lit(1)).alias("days"), F.avg("pop_weighted").alias("pop_weighted_mean"),
        F.count_if(F.col("pop_weighted") > P.NATIONAL_DAILY).alias("days_gt35"),
        F.avg("pop_frac_gt15").alias("mean_pop_frac_gt15"), F.avg("pop_frac_gt35").alias("mean_pop_frac_gt35"))


def exceedance_share(regional: DataFrame, min_days: int = 60) -> DataFrame:
    n = F.count("pop_weighted")
    return regional.groupBy("id", F.year("date").alias("year")).agg(
        n.alias("n_days"),
        F.when(n >= min_days, F.count_if(F.col("pop_weighted") > P.NATIONAL_DAILY) / n).alias("share_gt35"))


def north_south(regional: DataFrame, name: str = "name", north: Sequence[str] = P.NORTH_REGIONS) -> DataFrame:
    group = F.when(F.col(name).isin(*north), "North").otherwise("South & middle belt")
    return regional.groupBy("date", group.alias("grp")).agg(
        F.try_divide(F.sum(F.col("pop_weighted") * F.col("population")), F.sum("population")).alias("pop_weighted"))


def month_climatology(daily: DataFrame, keys: Sequence[str], value: str, min_days: int = 10) -> DataFrame:
    n = F.count(value)
    return daily.groupBy(*keys, F.year("date").alias("year"), F.month("date").alias("month")).agg(
        n.alias("n_days"), F.avg(value).alias("month_mean"), F.when(n >= min_days, F.avg(value)).alias("clim_mean"))


def monthly_partials(cells: DataFrame, value: str = "pm25") -> DataFrame:
    """Per month and cell: sum with missing as zero; ``n`` is the number of product days of the month.

    Annual means are built from these partials, never from means.
    """
    month = S.month_start(F.col("date"))
    days = cells.select(month.alias("month"), "date").distinct().groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    sums = cells.groupBy(month.alias("month"), "row", "col").agg(F.coalesce(F.sum(value), F.lit(0.0)).alias("s"))
    return sums.join(F.broadcast(days), "month")


def annual_from_partials(partials: DataFrame) -> DataFrame:
    year = F.year("month").alias("year")
    days = partials.select(year, "month", "n").distinct().groupBy("year").agg(F.sum("n").alias("n"))
    return (partials.groupBy(year, "row", "col").agg(F.sum("s").alias("s")).join(F.broadcast(days), "year")
            .select("year", "row", "col", (F.col("s") / F.col("n")).alias("mean"), "n"))


def seasonal_means(monthly: DataFrame, keys: Sequence[str], value: str = "mean") -> DataFrame:
    return monthly.groupBy(S.season(F.col("month")).alias("season"), *keys).agg(F.avg(value).alias("season_mean"))


def best_station_day(reports: DataFrame, day: Column, back: int = 3) -> DataFrame:
    """The day among ``day`` and the ``back`` days before with most stations reporting; the latest wins ties."""
    lag = F.datediff(day, F.col("date"))
    counts = (reports.where(lag.between(0, back)).groupBy("date").agg(F.count_distinct("site_id").alias("n_sites")))
    return counts.orderBy(F.col("n_sites").desc(), F.col("date").desc()).limit(1)
