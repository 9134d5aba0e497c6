"""Positions of pattern matches as column expressions (JVM side, no Python on the executors)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prefix sums are built in runs of this many entries, so a text with k matches costs about k * RUN steps, not k * k.
RUN = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, even where body names it inside another lambda."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, base: Column) -> Column:
    start = F.struct(base.alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
    step = lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["out"], F.array(s["at"] + x)).alias("out"))
    return F.aggregate(values, start, step, lambda s: s["out"])


def running_sums(values: Column) -> Column:
    """Inclusive prefix sums of an array of integers."""
    def long(v: Column) -> Column:
        runs = F.sequence(F.lit(0), ((F.size(v) - 1) / RUN).cast("int"))
        part = lambda i: F.slice(v, i * RUN + 1, F.lit(RUN))
        totals = F.transform(runs, lambda i: F.aggregate(part(i), F.lit(0), lambda s, x: s + x))
        return let(_running(totals, F.lit(0)), lambda ends: F.flatten(
            F.transform(runs, lambda i: _running(part(i), F.when(i > 0, F.element_at(ends, F.greatest(i, F.lit(1)))).otherwise(F.lit(0))))))

    return let(values, lambda v: F.when(F.size(v) <= RUN, _running(v, F.lit(0))).otherwise(long(v)))


EMPTY = "cast(array() as array<struct<start:int,end:int,match:string>>)"


def located(text: Column, pattern: str, hint: Column | None = None) -> Column:
    """array<struct<start, end, match>> of the leftmost non-overlapping matches, in code points, end exclusive.

    ``hint`` is a cheaper condition without which there is no match.
    """
    def place(matches: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
        ends = running_sums(F.zip_with(matches, gaps, lambda m, g: F.char_length(m) + F.char_length(g)))
        return F.zip_with(matches, ends, lambda m, e: F.struct((e - F.char_length(m)).alias("start"), e.alias("end"), m.alias("match")))

    found = F.regexp_like(text, F.lit(pattern))
    return F.when(found if hint is None else hint & found, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)).otherwise(F.expr(EMPTY))


def labelled(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of each span (structs of start, kind index, end), comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
