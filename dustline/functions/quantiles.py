"""Exact order statistics of groups of any size.

The built-in exact percentile keeps every distinct value of a group in one task. Here a
mergeable sketch first gives, per group, a narrow bracket that is sure to hold the wanted
ranks. While a bracket holds more than BRACKET_ROWS rows, the rows inside it are summarised
again and the bracket shrinks to about a hundredth; then only the values inside the bracket
are ordered, everything below it is a count. So no task orders a whole group.

Where targets are unions of parts (all folds but one, overlapping subsets), ``select_in_unions``
counts every part once in a histogram, adds the histograms, and copies to a target only the rows
of the few bins its ranks fall into.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dustline.session import written

#: Groups up to this many rows need no bracket. Also the accuracy asked of the sketch.
SMALL_GROUP = 1000
_SLACK = 3.0 / SMALL_GROUP
#: Rows of a bracket that one window may order.
BRACKET_ROWS = 200_000
#: Parts into which a round cuts a bracket, and bins of a histogram over all rows.
GRID, BINS = 200, 2048


def select_ranks(df: DataFrame, keys: Sequence[str], value: Column,
                 wanted: dict[str, tuple[float, Callable[[Column], Column]]], stored: bool = True) -> DataFrame:
    """Value at a fractional zero-based rank, linearly interpolated, for each group.

    ``wanted`` maps an output name to (approximate probability, rank as a function of the
    group's count). The rank may differ from ``probability * n`` by at most a few positions.
    ``stored`` false: the rows are worked out again in each of the few passes rather than written, for joins
    that yield far more rows than they read. ``df`` must then give the same rows every time.
    """
    keys = list(keys)
    names = list(wanted)
    group = keys or ["_all"]
    base = df.select(*keys, value.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    if not keys:
        base = base.withColumn("_all", F.lit(1))
    if stored:
        base = written(base, "ranked-values")  # two columns, read in every pass below
    low = [max(0.0, q - _SLACK) for q, _ in wanted.values()]
    high = [min(1.0, q + _SLACK) for q, _ in wanted.values()]
    sketch = base.groupBy(*group).agg(
        F.count("_v").alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
        F.percentile_approx("_v", low + high, SMALL_GROUP).alias("_edge"))
    specs = []
    for k, (name, (_, rank)) in enumerate(wanted.items()):
        whole = F.col("_n") <= SMALL_GROUP
        at_bottom = whole | F.lit(low[k] == 0.0)
        at_top = whole | F.lit(high[k] == 1.0)
        specs.append(F.struct(
            F.lit(k).alias("k"),
            F.when(at_bottom, F.col("_min")).otherwise(F.col("_edge")[k]).alias("lo"),
            F.when(at_top, F.col("_max")).otherwise(F.col("_edge")[len(names) + k]).alias("hi"),
            rank(F.col("_n")).cast("double").alias("rank")))
    brackets = written(sketch.select(*group, "_n", F.array(*specs).alias("_specs")), "brackets")
    most = brackets.agg(F.max(F.when(F.col("_n") > SMALL_GROUP, F.col("_n") * 2 * _SLACK))).first()[0] or 0
    while most > BRACKET_ROWS:
        brackets, most = _narrower(base, brackets, group, bool(keys))
    brackets = brackets.drop("_n")
    if not keys:  # one row
        brackets = F.broadcast(brackets)
    tagged = (base.join(brackets, group)
              .select(*group, "_v", F.explode("_specs").alias("_s"))
              .where(F.col("_v") <= F.col("_s.hi")))
    counted = (tagged
               .select(*group, F.col("_s.k").alias("_k"), F.col("_s.rank").alias("_rank"),
                       F.when(F.col("_v") >= F.col("_s.lo"), F.col("_v")).alias("_v"))
               .groupBy(*group, "_k", "_rank", "_v").agg(F.count(F.lit(1)).alias("_c")))
    order = W.partitionBy(*group, "_k").orderBy(F.col("_v").asc_nulls_first())
    running = counted.withColumn("_upto", F.sum("_c").over(order.rowsBetween(W.unboundedPreceding, 0)))
    first, last = F.floor("_rank"), F.ceil("_rank")

    def holds(rank: Column) -> Column:
        return (F.col("_upto") > rank) & (F.col("_upto") - F.col("_c") <= rank)

    picked = running.groupBy(*group, "_k").agg(
        F.max(F.when(holds(first), F.col("_v"))).alias("_a"),
        F.max(F.when(holds(last), F.col("_v"))).alias("_b"),
        F.first("_rank").alias("_rank"))
    picked = picked.withColumn("_q", F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_rank") - F.floor("_rank")))
    out = picked.groupBy(*group).agg(
        *[F.max(F.when(F.col("_k") == k, F.col("_q"))).alias(name) for k, name in enumerate(names)])
    return out.select(*keys, *names)


def _narrower(base: DataFrame, brackets: DataFrame, group: list[str], keyed: bool) -> tuple[DataFrame, float]:
    """Brackets cut down to three of GRID parts around their ranks, and the most rows any of them can hold."""
    inside = (base.join(brackets if keyed else F.broadcast(brackets), group)
              .select(*group, "_n", "_v", F.explode("_specs").alias("_s")).where(F.col("_v") <= F.col("_s.hi")))
    held = F.when(F.col("_v") >= F.col("_s.lo"), F.col("_v"))
    cut = inside.groupBy(*group, F.col("_s").alias("_s")).agg(
        F.first("_n").alias("_n"), F.count(held).alias("_c"), F.sum((F.col("_v") < F.col("_s.lo")).cast("long")).alias("_below"),
        F.percentile_approx(held, [i / GRID for i in range(GRID + 1)], 10 * GRID).alias("_edge"))
    part = F.floor((F.col("_s.rank") - F.col("_below")) * GRID / F.greatest(F.col("_c") - 1, F.lit(1))).cast("int")
    lo = F.when(part >= 2, F.get("_edge", part - 1)).otherwise(F.col("_s.lo"))
    hi = F.when(part <= GRID - 3, F.get("_edge", part + 2)).otherwise(F.col("_s.hi"))
    cut = cut.select(*group, "_n", (F.col("_c") * 4.0 / GRID).alias("_most"), F.struct(
        F.col("_s.k").alias("k"), lo.alias("lo"), hi.alias("hi"), F.col("_s.rank").alias("rank")).alias("_s"))
    cut = written(cut, "brackets")
    # equal values are one row of a window however many they are
    most = cut.agg(F.max(F.when(F.col("_s.lo") < F.col("_s.hi"), F.col("_most")))).first()[0] or 0
    return cut.groupBy(*group).agg(F.first("_n").alias("_n"), F.array_sort(F.collect_list("_s")).alias("_specs")), most


def select_in_unions(df: DataFrame, part: str, value: Column, members: DataFrame,
                     wanted: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Value at a fractional zero-based rank for each target, a union of parts of ``df``.

    ``members`` (part, target) lists the parts of each target; ``wanted`` maps an output name to the
    rank as a function of the target's count. Rows are read twice and never copied, but for those
    of the bins that hold a rank: about one in BINS.
    """
    names = list(wanted)
    base = written(df.select(F.col(part).alias("part"), value.cast("double").alias("_v")).where(F.col("_v").isNotNull()), "ranked-values")
    edges = base.agg(F.percentile_approx("_v", [i / BINS for i in range(1, BINS)], 10 * BINS)).first()[0] or []
    cuts = [float("-inf"), *sorted({float(e) for e in edges if math.isfinite(e)}), float("inf")]
    if len(cuts) < 3:
        cuts.insert(1, 0.0)
    binned = Bucketizer(splits=cuts, inputCol="_v", outputCol="_bin", handleInvalid="keep").transform(base)
    counts = binned.groupBy("part", "_bin").agg(F.count(F.lit(1)).alias("_c"))
    by_target = counts.join(members, "part").groupBy("target", "_bin").agg(F.sum("_c").alias("_c"))
    running = W.partitionBy("target").orderBy("_bin").rowsBetween(W.unboundedPreceding, 0)  # over bins
    cumulated = by_target.withColumn("_upto", F.sum("_c").over(running)).withColumn("_n", F.sum("_c").over(W.partitionBy("target")))
    ranks = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), wanted[name](F.col("_n")).cast("double").alias("rank")) for k, name in enumerate(names)]))
    cumulated = cumulated.select("target", "_bin", (F.col("_upto") - F.col("_c")).alias("_before"), "_upto", ranks.alias("_s")) \
        .select("target", "_bin", "_before", "_upto", F.col("_s.k").alias("_k"), F.col("_s.rank").alias("_rank"))
    here = lambda rank: (F.col("_before") <= rank) & (rank < F.col("_upto"))
    needed = cumulated.where(here(F.floor("_rank")) | here(F.ceil("_rank"))).drop("_upto").join(members, "target")
    inside = binned.join(written(needed, "needed-bins"), ["part", "_bin"]).groupBy("target", "_k", "_rank", "_bin", "_before", "_v").agg(F.count(F.lit(1)).alias("_c"))
    order = W.partitionBy("target", "_k", "_bin").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    placed = inside.withColumn("_upto", F.col("_before") + F.sum("_c").over(order))
    at = lambda rank: F.max(F.when((F.col("_upto") - F.col("_c") <= rank) & (rank < F.col("_upto")), F.col("_v")))
    picked = placed.groupBy("target", "_k").agg(at(F.floor("_rank")).alias("_a"), at(F.ceil("_rank")).alias("_b"), F.first("_rank").alias("_rank"))
    picked = picked.withColumn("_q", F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_rank") - F.floor("_rank")))
    return picked.groupBy("target").agg(*[F.max(F.when(F.col("_k") == k, F.col("_q"))).alias(name) for k, name in enumerate(names)])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: Column, probs: dict[str, float], stored: bool = True) -> DataFrame:
    """Exact linear-interpolation quantiles per group; ``stored`` as in ``select_ranks``."""
    return select_ranks(df, keys, value,
                        {name: (q, (lambda n, q=q: F.lit(float(q)) * (n - 1))) for name, q in probs.items()}, stored)


def conformal_rank(alpha: float) -> Callable[[Column], Column]:
    """Zero-based position ceil((n + 1)(1 - alpha)), at most n, of the split-conformal order statistic."""
    return lambda n: F.least(F.ceil((n + 1) * F.lit(1 - alpha)), n) - 1


def conformal_quantile(df: DataFrame, keys: Sequence[str], score: Column, alphas: dict[str, float]) -> DataFrame:
    """Split-conformal order statistic: position ceil((n + 1)(1 - alpha)), at most n."""
    wanted = {name: (1 - a, conformal_rank(a)) for name, a in alphas.items()}
    return select_ranks(df, keys, score, wanted)
