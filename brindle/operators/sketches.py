"""Stored sketches: distinct counts and quantiles of periods, which merge over any of them without their rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.sources.shared import quoted

#: Distinct counts are exact up to 2 ** LOG_ENTRIES; beyond, their standard error is 2 ** (-LOG_ENTRIES / 2), 1.6 %.
LOG_ENTRIES = 12
#: A quantile's rank is off by more than RANK_ERROR at most once in a hundred; up to QUANTILE_K values, it is exact.
QUANTILE_K, RANK_ERROR = 800, 0.004


def period_sketches(df: DataFrame, time: str, period: str, by: Sequence[str], distinct: Mapping[str, str], quantiles: Mapping[str, str]) -> DataFrame:
    """period_start (of each ``period``: day, week, ...), by, n (rows), and a sketch for each name in distinct (of any
    column) and quantiles (of a column of numbers).

    Nulls are in no sketch but count in n; rows without a time are a period of their own. Sketches are built in each task
    and merged by key, so a frequent key sends one sketch a task.
    """
    at = F.date_trunc(period, F.col(quoted(time)).cast("timestamp")).cast("timestamp_ntz").alias("period_start")
    counts = [F.theta_sketch_agg(quoted(c), LOG_ENTRIES).alias(name) for name, c in distinct.items()]
    ranks = [F.kll_sketch_agg_double(F.col(quoted(c)).cast("double"), F.lit(QUANTILE_K)).alias(name) for name, c in quantiles.items()]
    return df.groupBy(at, *(F.col(quoted(b)) for b in by)).agg(F.count(F.lit(1)).alias("n"), *counts, *ranks)


def period_values(df: DataFrame, time: str, period: str, by: Sequence[str], column: str) -> DataFrame:
    """period_start, by, and each value that ``column`` has there, once: what exact counts over any periods need, however
    many values there are. Nulls are left out.
    """
    at = F.date_trunc(period, F.col(quoted(time)).cast("timestamp")).cast("timestamp_ntz").alias("period_start")
    return df.filter(F.col(quoted(column)).isNotNull()).select(at, *(F.col(quoted(b)) for b in by), F.col(quoted(column))).distinct()


def merged_sketches(stored: DataFrame, by: Sequence[str], distinct: Sequence[str], quantiles: Sequence[str]) -> DataFrame:
    """The sketches of all stored rows that have the same ``by``: what the rows themselves together would have given, but
    for the errors stated above. Merging again, in any order, is allowed.
    """
    counts = [F.theta_union_agg(quoted(c), LOG_ENTRIES).alias(c) for c in distinct]
    ranks = [F.kll_merge_agg_double(quoted(c)).alias(c) for c in quantiles]
    return stored.groupBy(*(F.col(quoted(b)) for b in by)).agg(F.sum("n").alias("n"), *counts, *ranks)


def estimates(sketches: DataFrame, distinct: Sequence[str], quantiles: Mapping[str, Sequence[float]]) -> DataFrame:
    """The sketches' columns as numbers: a count for each of distinct (0 if all is null), and for each of quantiles an
    array of the values at its ranks (null if all is null).
    """
    out = []
    for f in sketches.schema.fields:
        c = F.col(quoted(f.name))
        if f.name in distinct:
            c = F.coalesce(F.theta_sketch_estimate(c), F.lit(0).cast("long"))
        elif f.name in quantiles:
            ranks = F.array(*(F.lit(float(r)) for r in quantiles[f.name]))
            c = F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, ranks))
        elif isinstance(f.dataType, T.BinaryType):
            continue
        out.append(c.alias(f.name))
    return sketches.select(*out)
