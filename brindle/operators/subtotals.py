"""Subtotals over several sets of columns at once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.operators.sessions import MERGE, aggregates
from brindle.sources.shared import quoted


def cube_sets(by: Sequence[str]) -> list[list[str]]:
    return [list(c) for n in range(len(by), -1, -1) for c in combinations(by, n)]


def rollup_sets(by: Sequence[str]) -> list[list[str]]:
    return [list(by[:n]) for n in range(len(by), -1, -1)]


def subtotals(df: DataFrame, by: Sequence[str], sets: Sequence[Sequence[str]], values: Mapping[str, tuple[str, str]]) -> DataFrame:
    """by, grouping_id and values (as for sessions) of each group of each of the sets of columns of ``by``.

    grouping_id has a bit for each of ``by``, the first one the highest: 1 where a row is a total over that column. So a
    group of nulls (0) is told from a total (1), though both show null. Rows are first added up by all columns, and only
    these groups are multiplied by the sets: a set more costs no scan and no row more in the large shuffle. Over a table
    without rows, the empty set gives one row (counts are 0), as SQL does; the others none.
    """
    keys = [f"b{i}" for i in range(len(by))]
    number = dict(zip(by, keys, strict=True))
    if unknown := {c for s in sets for c in s} - set(by):
        raise ValueError(f"not among the columns: {', '.join(sorted(unknown))}")
    parts = [F.expr(x).alias(f"v{i}") for i, (_, x) in enumerate(values.values())]
    groups = df.select(*(F.col(quoted(b)).alias(k) for b, k in number.items()), *parts).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *aggregates(values))
    merged = [F.coalesce(MERGE[how](f"v{i}"), F.lit(0)).alias(f"v{i}") if how == "count" else MERGE[how](f"v{i}").alias(f"v{i}") for i, (how, _) in enumerate(values.values())]
    out = groups.groupingSets([[F.col(number[c]) for c in s] for s in sets], *map(F.col, keys)).agg(F.grouping_id().alias("grouping_id"), *merged)
    return out.select(*(F.col(k).alias(b) for b, k in number.items()), F.col("grouping_id").cast("long").alias("grouping_id"), *(F.col(f"v{i}").alias(n) for i, n in enumerate(values)))
