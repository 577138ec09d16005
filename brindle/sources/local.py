"""Small tables to and from the driver as Arrow and pandas."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

MAX_BYTES = 256 << 20


def arrow_bytes(df: DataFrame) -> int:
    """How many bytes the rows take as Arrow, counted where they are; nothing but the sum comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"n": pa.array([sum(b.nbytes for b in batches)], pa.int64())})

    numbered = df.toDF(*(f"c{i}" for i in range(len(df.columns))))  # any names
    return numbered.mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def to_pandas(df: DataFrame, most: int = MAX_BYTES) -> pd.DataFrame:
    """The rows as pandas with Arrow types, so that nulls, whole numbers, decimals, times and nested values stay what they
    are. A table of more than ``most`` bytes raises before any of it is sent.
    """
    if (size := arrow_bytes(df)) > most:
        raise ValueError(f"{size} bytes, more than the {most} that may come to the driver")
    return df.toArrow().to_pandas(types_mapper=pd.ArrowDtype)


def from_pandas(spark: SparkSession, rows: pd.DataFrame) -> DataFrame:
    """A DataFrame of pandas rows, by way of Arrow; types come from the columns, indexes are left."""
    table = pa.Table.from_pandas(rows, preserve_index=False)
    return spark.createDataFrame(table, from_arrow_schema(table.schema, prefer_timestamp_ntz=True))  # times without a zone stay so
