"""Partitioned tables that can be written again: what a write holds replaces its partitions, and nothing else."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.sources.shared import quoted, written


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Puts the rows of df into the Parquet table at ``path``, in place of all its rows in the same partitions.

    The rows are first written whole to the shared folder. So a task that fails while they are made leaves the table as
    it was, they are made once however often the last step is tried again, and df may come from the table itself. Then
    the partitions that occur are replaced. The same write run again leaves the same table; a run that broke off between
    partitions is mended by the next. Partitions that df has no row of stay. A partition with many rows is written by
    several tasks, small ones share one.

    Null is a partition of its own. The empty string would be read back as null, so it is refused, as are columns that
    aren't plain values.
    """
    for b in by:
        if isinstance(df.schema[b].dataType, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType, T.FractionalType)):
            raise TypeError(f"partition column {b} is {df.schema[b].dataType.simpleString()}")
    if not by or len(by) >= len(df.columns):
        raise ValueError("a partition column is needed, and a column beside them")
    staged = written(df, "staged")
    empty = [F.col(quoted(b)) == "" for b in by if isinstance(df.schema[b].dataType, T.StringType)]
    for e in empty:
        if not staged.filter(e).isEmpty():
            raise ValueError(f"an empty string in a partition column of {', '.join(by)}")
    dealt = staged.hint("rebalance", *by)  # large partitions are split, small ones put together, by their measured size
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def read_partitions(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str]) -> DataFrame:
    """The table with the columns and types of ``schema``, in its order; partition columns aren't guessed from names."""
    kinds = T.StructType([f for f in schema.fields if f.name not in by] + [schema[b] for b in by])
    return spark.read.schema(kinds).parquet(path).select(*(F.col(quoted(f.name)) for f in schema.fields))
