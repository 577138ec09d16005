"""Row count, schema and column list, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, Spark's short type name, and how many rows and nulls it has; all columns are
    counted in one scan.
    """
    counts = df.toDF(*(f"c{i}" for i in range(len(df.columns))))  # names may repeat
    counts = counts.agg(F.count(F.lit(1)).alias("row_count"), *(F.count(c).alias(c.replace("c", "n")) for c in counts.columns))
    each = [F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), "row_count", (F.col("row_count") - F.col(f"n{i}")).alias("null_count")) for i, f in enumerate(df.schema.fields)]
    kind = "array<struct<position:int,name:string,type:string,row_count:bigint,null_count:bigint>>"
    return counts.select(F.inline(F.array(*each).cast(kind)))


def column_list(df: DataFrame) -> DataFrame:
    """The names in one row, with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(", ".join(df.columns)).alias("columns"), "row_count")


def missing_columns_message(df: DataFrame, missing: list[str]) -> str:
    return f"column {', '.join(missing)} not found; available columns: {', '.join(df.columns)}"
