"""Row numbers within groups of any size, without a task that holds a whole group.

A ranking window sends every row of a group to one task. Here the rows are range-partitioned by
group and order, written once, and numbered within each partition; the counts of the partitions
before it, one row per (partition, group), are then added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dustline.session import fresh_path


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], row: str = "row", size: str = "size",
             first: str | None = None) -> DataFrame:
    """``df`` with ``row`` (from 0, by ``order``, nulls first where ascending) and ``size`` (rows of the group); ``first``, if
    named, is a long that is equal within a group and ascends with the groups.

    The sorted rows are written below the shared folder, as partition numbers have to be the same in both uses below.
    Rows that tie in ``order`` are numbered in any order, so name enough columns to make ties equal rows.
    """
    groups = list(groups)
    key = [F.col(g).asc_nulls_first() for g in groups] + [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in order]
    spark = df.sparkSession
    path = fresh_path(spark, "numbered")
    # consecutive ids: the partition in the upper bits, the place in the sorted partition in the lower 33
    df.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("__at", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("__part", F.shiftright("__at", 33))
    bounds = rows.groupBy("__part", *groups).agg(F.min("__at").alias("__start"), F.count(F.lit(1)).alias("__n"))
    # a window over partitions, not rows: at most one row per partition of a group
    group = W.partitionBy(*(groups or [F.lit(1)]))
    bounds = bounds.select("__part", *groups, F.sum("__n").over(group).alias(size), F.min("__start").over(group).alias("__first"), (
        F.coalesce(F.sum("__n").over(group.orderBy("__part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)) - F.col("__start")).alias("__shift"))
    match = F.col("r.__part") == F.col("b.__part")
    for g in groups:
        match &= F.col(f"r.{g}").eqNullSafe(F.col(f"b.{g}"))
    out = [F.col(f"r.{c}") for c in df.columns]
    return rows.alias("r").join(bounds.alias("b"), match).select(
        *out, (F.col("r.__at") + F.col("b.__shift")).alias(row), F.col(f"b.{size}"), *([F.col("b.__first").alias(first)] if first else []))
