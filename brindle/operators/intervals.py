"""Interval joins: points and the intervals that hold them, met in cells of the intervals' own lengths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.operators.asof import known, spread
from brindle.operators.ticks import ticks
from brindle.sources.shared import quoted, written

#: A cell with more points than this is dealt to as many tasks as it holds multiples of it.
HOT = 1_000_000
#: So many hot cells are broadcast at most; more are joined.
MAX_HOT = 100_000


def shifted(c: Column, level: str, levels: Sequence[int]) -> Column:
    """c without its last bits, as many as the column ``level`` says: exact, and rounded down below zero too."""
    out = F.lit(None).cast("long")
    for n in levels:
        out = F.when(F.col(level) == n, F.shiftright(c, n)).otherwise(out)
    return out


def interval_join(points: DataFrame, intervals: DataFrame, by: Sequence[str], at: str, start: str, end: str, *, closed: bool = False, prefix: str = "interval_") -> DataFrame:
    """Each pair of a point and an interval of the same ``by`` with start <= at < end (<= end with ``closed``): the
    point's columns and the interval's (behind ``prefix``). Null keys and bounds, and intervals that hold nothing, match
    nothing; repeated rows match each.

    An interval of up to 2 ** n ticks lies in cells of that width: two at most, of which it fills a quarter or more. A
    point looks into one cell for each length class that occurs (there are 63 at most, a few in practice). So sides of
    any length meet by equal keys; the range is a condition of the same join, and what fails it is never kept. A long
    history of one key is spread over its cells; a cell with more than HOT points is dealt to several tasks, and its
    intervals are sent to each.
    """
    if clash := {c.lower() for c in points.columns} & {(prefix + c).lower() for c in intervals.columns}:
        raise ValueError(f"both sides would have: {', '.join(sorted(clash))}")
    whole = lambda df: F.struct(*(F.col(quoted(c)) for c in df.columns))
    keys = [f"b{i}" for i in range(len(by))]
    own = lambda df: [F.col(quoted(b)).alias(k) for b, k in zip(by, keys, strict=True)]
    i = intervals.filter(known(intervals, [*by, start, end])).select(*own(intervals), ticks(intervals, start).alias("start"), ticks(intervals, end).alias("last"), whole(intervals).alias("i"))
    i = i.withColumn("last", F.col("last") - F.lit(0 if closed else 1)).filter("last >= start")
    # the least n with 2 ** n ticks or more, from the bits of one tick less than the length; 63 where that passes 64 bits
    less = F.try_subtract(F.col("last"), F.col("start"))
    i = i.withColumn("level", F.when(less == 0, 0).otherwise(F.coalesce(F.length(F.bin(less)), F.lit(63))).cast("int"))
    levels = sorted(r.level for r in i.select("level").distinct().collect())
    p = points.filter(known(points, [*by, at])).select(*own(points), ticks(points, at).alias("at"), spread(points).alias("tie"), whole(points).alias("p"))
    p = p.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("cell", shifted(F.col("at"), "level", levels))
    i = i.withColumn("cell", F.explode(F.sequence(shifted(F.col("start"), "level", levels), shifted(F.col("last"), "level", levels))))
    cell = [*keys, "level", "cell"]
    hot = written(p.groupBy(*cell).count().filter(F.col("count") > HOT).withColumn("parts", F.ceil(F.col("count") / HOT).cast("int")).drop("count"), "interval-hot")
    hot = F.broadcast(hot) if hot.count() <= MAX_HOT else hot
    parts = F.coalesce("parts", F.lit(1))
    p = p.join(hot, cell, "left").withColumn("part", F.pmod("tie", parts).cast("int")).drop("parts", "tie")
    i = i.join(hot, cell, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    found = p.join(i, [*cell, "part"]).filter((F.col("at") >= F.col("start")) & (F.col("at") <= F.col("last")))
    return found.select(*(F.col(f"p.{quoted(c)}").alias(c) for c in points.columns), *(F.col(f"i.{quoted(c)}").alias(prefix + c) for c in intervals.columns))
