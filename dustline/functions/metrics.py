"""Aggregate bundles: model scores, circular and weighted means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over rows with both values; NULL where either is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def scores(obs: Column, pred: Column, min_rows: int = 3, slope: bool = True) -> list[Column]:
    """Score columns over rows where both values are present; below ``min_rows`` only the count is kept."""
    both = obs.isNotNull() & pred.isNotNull()
    y, p = F.when(both, obs), F.when(both, pred)
    n = F.count(F.when(both, F.lit(1)))
    enough = n >= min_rows

    def keep(c: Column, name: str) -> Column:
        return F.when(enough, c).alias(name)

    err = p - y
    out = [
        n.alias("n"),
        keep(correlation(y, p), "r"),
        keep(1 - F.try_divide(F.sum(err * err), F.var_pop(y) * n), "r2"),
        keep(F.sqrt(F.avg(err * err)), "rmse"),
        keep(F.avg(F.abs(err)), "mae"),
        keep(F.avg(err), "mb"),
        keep(F.try_divide(F.sum(err), F.sum(y)), "nmb"),
        keep(F.avg(y), "mean_obs"),
    ]
    if slope:
        out.insert(7, keep(F.regr_slope(p, y), "slope"))
    return out


SCORE_NAMES = ("r", "r2", "rmse", "mae", "mb", "nmb", "slope", "mean_obs")


def weighted_mean(x: Column, w: Column) -> Column:
    """Mean with weights; plain mean where the weights sum to nothing."""
    total = F.sum(F.when(x.isNotNull(), w))
    return F.when(total > 0, F.sum(x * w) / total).otherwise(F.avg(x))


def weighted_share(flag: Column, w: Column) -> Column:
    total = F.sum(F.when(flag.isNotNull(), w))
    return (F.when(total > 0, F.sum(F.when(flag, w).otherwise(0.0)) / total)
            .otherwise(F.avg(flag.cast("double"))))


def circular_mean_deg(angle_deg: Column) -> Column:
    a = F.radians(angle_deg)
    return F.pmod(F.degrees(F.atan2(F.avg(F.sin(a)), F.avg(F.cos(a)))), F.lit(360.0))
