"""Keyed table maintenance: upserts, replacement by date, keep-last, gap filling, axis clipping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dustline.session import written


def keep_last(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """One row per key, the one with the largest ``order``.

    An aggregate rather than a ranking window: it combines before the shuffle, so a key
    repeated very often costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in df.columns])


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``new`` replaces rows with equal keys; applying the same batch twice changes nothing."""
    both = (old.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)), allowMissingColumns=True))
    return keep_last(both, keys, F.col("_v")).drop("_v")


def replace_dates(old: DataFrame, new: DataFrame, date: str = "date") -> DataFrame:
    """Every date present in ``new`` is taken from it alone."""
    return old.join(new.select(date).distinct(), date, "left_anti").unionByName(new, allowMissingColumns=True)


def append_missing(have: DataFrame, extra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``extra`` whose key is not there yet are added."""
    return have.unionByName(extra.join(have.select(*keys).distinct(), list(keys), "left_anti"), allowMissingColumns=True)


def hand_over(days: DataFrame, primary: str, secondary: str) -> DataFrame:
    """Two feeds of one instrument: secondary days fill the primary's gaps under its name."""
    first = days.where(F.col("site_id") == primary)
    second = days.where(F.col("site_id") == secondary).join(first.select("date"), "date", "left_anti")
    rest = days.where(F.col("site_id") != secondary)
    return rest.unionByName(second.withColumn("site_id", F.lit(primary)).select(*days.columns))


def complete_dates(nodes: DataFrame, expected: int) -> DataFrame:
    """Rows of dates on which every node is present, one row per (node, date)."""
    unique = nodes.dropDuplicates(["node", "date"])
    full = unique.groupBy("date").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= expected)
    return unique.join(full.select("date"), "date", "left_semi")


def anti_pairs(df: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(pairs, list(keys), "left_anti")


def clip_to_axis(df: DataFrame, axis: DataFrame, date: str = "date") -> DataFrame:
    """Rows inside the date range another table covers."""
    span = axis.agg(F.min(date).alias("_from"), F.max(date).alias("_to"))
    return df.join(F.broadcast(span), F.col(date).between(F.col("_from"), F.col("_to"))).drop("_from", "_to")


def touched_months(today: Column, days: int = 10) -> Column:
    """Sorted ``yyyy-MM`` labels of the days from ``today - days`` to tomorrow."""
    span = F.sequence(F.date_sub(today, days), F.date_add(today, 1))
    return F.array_sort(F.array_distinct(F.transform(span, lambda d: F.date_format(d, "yyyy-MM"))))


def deterministic_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 0) -> DataFrame:
    """``n`` rows without replacement, the same ones whatever the partitioning: those with the smallest MD5 of seed and keys."""
    code = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return df.orderBy(code, *keys).limit(n)


#: Shares that the rows of a group are dealt to where a table by group is too large to go with the tasks.
GROUP_SHARES = 16


def with_group_values(df: DataFrame, values: DataFrame, group: str) -> DataFrame:
    """``df`` with the columns of ``values``, a table of one row per group; groups may be few and hold any number of rows.

    The table is stored, so its size is known: a small one goes with the tasks and moves no row. A
    large one meets the rows by group and share, so that no task reads all rows of a group.
    """
    share = F.pmod(F.hash(*df.columns), F.lit(GROUP_SHARES))
    table = written(values.withColumn("_share", F.explode(F.sequence(F.lit(0), F.lit(GROUP_SHARES - 1)))), "group-values")
    return df.withColumn("_share", share).join(table, [group, "_share"]).drop("_share")
