"""In-place column transforms."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.operators.report import missing_columns_message

log = logging.getLogger(__name__)


def lower_columns(df: DataFrame, columns: Sequence[str], match: str = "exact", on_missing: str = "warn") -> DataFrame:
    """Lower-case columns where they stand; all others, and the column order, stay.

    ``match``: "exact" finds a column by its exact spelling, "insensitive" by any case, keeping its name.
    A column that isn't there is passed over with a warning, or raises KeyError with on_missing="error".
    Scalars become their lower-cased text, nulls stay null. Arrays, maps and structs raise TypeError;
    column names that differ by case alone raise ValueError, as Spark couldn't tell them apart.
    """
    if match not in ("exact", "insensitive") or on_missing not in ("warn", "error"):
        raise ValueError(f"match={match!r}, on_missing={on_missing!r}")
    folded = Counter(c.lower() for c in df.columns)
    found, missing = [], []
    for want in columns:
        hits = [c for c in df.columns if c == want or match == "insensitive" and c.lower() == want.lower()]
        if hits and folded[want.lower()] > 1:
            raise ValueError(f"several columns are spelled like {want!r}: {', '.join(df.columns)}")
        found += hits
        missing += [want] * (not hits)
    if missing:
        if on_missing == "error":
            raise KeyError(missing_columns_message(df, missing))
        log.warning(missing_columns_message(df, missing))
    for c in found:
        if isinstance(df.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType)):
            raise TypeError(f"column {c} is {df.schema[c].dataType.simpleString()}, which has no lower case")
    quoted = {c: F.col(f"`{c.replace('`', '``')}`") for c in found}
    return df.withColumns({c: F.lower(x) for c, x in quoted.items()}) if found else df
