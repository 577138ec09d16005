"""Sessions by gaps, and sums over a range of time before each row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.operators.asof import known
from brindle.operators.ticks import length, ticks
from brindle.sources.shared import quoted

#: How an aggregate of a session or range comes from those of its parts.
MERGE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def parts(df: DataFrame, by: Sequence[str], time: str, values: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Keys b0.., the time as ticks t, and the values v0.. of the rows with a key and a time."""
    rows = df.filter(known(df, [*by, time]))
    return rows.select(*(F.col(quoted(b)).alias(f"b{i}") for i, b in enumerate(by)), ticks(df, time).alias("t"), F.col(quoted(time)).alias("at"), *(F.expr(x).alias(f"v{i}") for i, (_, x) in enumerate(values.values())))


def cell(wide: int) -> Column:
    """The number of the cell of so many ticks in which t lies; rounded down below zero too."""
    return F.expr(f"(t - pmod(t, {wide}L)) div {wide}L")


def aggregates(values: Mapping[str, tuple[str, str]], merging: bool = False) -> list[Column]:
    """v0.. of a group, from rows or from parts."""
    each = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    if bad := {how for how, _ in values.values()} - set(each):
        raise ValueError(f"not known: {', '.join(sorted(bad))}")
    return [(MERGE if merging else each)[how](f"v{i}").alias(f"v{i}") for i, (how, _) in enumerate(values.values())]


def sessions(df: DataFrame, by: Sequence[str], time: str, gap: timedelta | int, values: Mapping[str, tuple[str, str]]) -> DataFrame:
    """The sessions of each key: ``by``, start and end (the first and last time), and values, each of which is count, sum,
    min or max of an SQL expression: ``{"spent": ("sum", "price * n")}``.

    A session ends before the first row that is more than ``gap`` later than the one before it. Rows with a null key or
    time are in none. All rows of one key within one cell of ``gap`` ticks are in one session, so they are added up
    before anything is shuffled; the gaps are looked for between cells. What one key can hold in a task is the number of
    cells in its whole time, not the number of its rows.
    """
    wide = max(length(df, time, gap), 1)
    keys = [f"b{i}" for i in range(len(by))]
    rows = parts(df, by, time, values)
    # from here on: one row for each key and cell
    cells = rows.groupBy(*keys, cell(wide).alias("cell")).agg(F.min("t").alias("first"), F.max("t").alias("last"), F.min("at").alias("start"), F.max("at").alias("end"), *aggregates(values))
    w = Window.partitionBy(*keys).orderBy("cell")
    new = F.col("first") - F.lag("last").over(w) > F.lit(length(df, time, gap))
    numbered = cells.withColumn("new", F.coalesce(new, F.lit(True)).cast("long")).withColumn("session", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = numbered.groupBy(*keys, "session").agg(F.min("start").alias("start"), F.max("end").alias("end"), *aggregates(values, merging=True))
    return out.select(*(F.col(k).alias(b) for k, b in zip(keys, by, strict=True)), "start", "end", *(F.col(f"v{i}").alias(n) for i, n in enumerate(values)))


def rolling(df: DataFrame, by: Sequence[str], time: str, span: timedelta | int, values: Mapping[str, tuple[str, str]]) -> DataFrame:
    """df with values over the rows of the same key whose time is at most ``span`` before a row's own, itself and rows of
    the same time included; null for rows with a null key or time. Values as for sessions.

    Rows of one key and time share their result, so they are added up first. A key's times are cut into cells as wide as
    the span: a frame ends in its row's cell and begins in that or the one before. So each cell is judged for itself,
    with the sums of the cell before it as context, and a frequent key is spread over its cells. A task holds the
    different times of two cells, however many rows these have.
    """
    if not values:
        return df
    wide = max(length(df, time, span), 1)
    if clash := {c.lower() for c in df.columns} & {n.lower() for n in values}:
        raise ValueError(f"already there: {', '.join(sorted(clash))}")
    keys = [f"b{i}" for i in range(len(by))]
    times = parts(df, by, time, values).groupBy(*keys, "t").agg(*aggregates(values))
    own = cell(wide)
    both = times.withColumn("cell", F.explode(F.array(own, own + 1))).withColumn("context", F.col("cell") > own)
    w = Window.partitionBy(*keys, "cell").orderBy("t").rangeBetween(-length(df, time, span), 0)
    summed = both.select(*keys, "t", "context", *(MERGE[how](f"v{i}").over(w).alias(f"v{i}") for i, (how, _) in enumerate(values.values()))).filter("not context").drop("context")
    summed = summed.toDF(*(f"__{c}" for c in summed.columns))
    on = F.col("__t") == ticks(df, time)
    for k, b in zip(keys, by, strict=True):
        on &= F.col(f"__{k}") == F.col(quoted(b))
    return df.join(summed, on, "left").select(*(F.col(quoted(c)) for c in df.columns), *(F.col(f"__v{i}").alias(n) for i, n in enumerate(values)))
