"""Bounded reads and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

READ_ROWS = 50
PREVIEW_ROWS = 20


def bounded(df: DataFrame, n: int = READ_ROWS, order_by: Sequence[str] | None = None) -> DataFrame:
    """At most n rows: the first by ``order_by``, or any n rows without it.

    Ordered, Spark keeps n rows per partition and merges them; nothing is sorted whole.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def preview(df: DataFrame, n: int = PREVIEW_ROWS, order_by: Sequence[str] | None = None) -> DataFrame:
    """The rows a console preview shows."""
    return bounded(df, n, order_by)
