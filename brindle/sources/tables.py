"""Named sources that load as one DataFrame."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

WAREHOUSE_FORMAT = "net.snowflake.spark.snowflake"
_PART = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*")


@dataclass(frozen=True)
class TableSpec:
    """A source: a reader format, its options and, where it has one, a path."""

    format: str
    options: dict[str, str] = field(default_factory=dict)
    path: str | None = None


def qualified_name(*parts: str) -> str:
    """``database.schema.table`` from parts that are plain identifiers; anything else is refused."""
    bad = [p for p in parts if not _PART.fullmatch(p or "")]
    if bad:
        raise ValueError(f"not a plain identifier: {', '.join(map(repr, bad))}")
    return ".".join(parts)


def warehouse_spec(options: dict[str, str], database: str, schema: str, table: str, limit: int | None = None) -> TableSpec:
    """A warehouse table read through its Spark connector; the limit runs in the warehouse."""
    query = f"SELECT * FROM {qualified_name(database, schema, table)}"
    if limit is not None:
        query += f" LIMIT {int(limit)}"
    return TableSpec(WAREHOUSE_FORMAT, {**options, "query": query})


def read_table(spark: SparkSession, spec: TableSpec) -> DataFrame:
    reader = spark.read.format(spec.format).options(**spec.options)
    return reader.load(spec.path) if spec.path else reader.load()
