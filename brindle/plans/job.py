"""The bounded-read job: one snapshot, its report, and the normalised column."""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from brindle.functions import lower_columns
from brindle.operators.bounded import READ_ROWS, bounded, preview
from brindle.operators.report import schema_report
from brindle.plans.config import load_settings
from brindle.plans.credentials import key_options
from brindle.sources import TableSpec, read_table, warehouse_spec

log = logging.getLogger(__name__)


@contextmanager
def session(name: str = "brindle") -> Iterator[SparkSession]:
    """The active session, or one of our own that is stopped at the end."""
    if active := SparkSession.getActiveSession():
        yield active
        return
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        yield spark
    finally:
        spark.stop()


def run(df: DataFrame, column: str = "SRC", order_by: Sequence[str] | None = None) -> DataFrame:
    """Report at most READ_ROWS rows of df and return them with the column in lower case.

    The bounded rows are cached, so that the count and the previews tell of the same rows and scan once.
    """
    snapshot = bounded(df, READ_ROWS, order_by).cache()
    try:
        print(f"== as read ==\nrows: {snapshot.count()}")
        snapshot.printSchema()
        schema_report(snapshot).select("name", "null_count").show(len(snapshot.columns), truncate=False)
        preview(snapshot).show(truncate=False)
        out = lower_columns(snapshot, [column])
        found = column in out.columns
        print(f"== with {column} in lower case ==" if found else f"== without a column {column}: unchanged ==")
        preview(out).show(truncate=False)
        if found:
            print(f"== {column} alone ==")
            preview(out.select(f"`{column}`")).show(truncate=False)
        # what is returned keeps the same rows once the cache is gone
        return df.sparkSession.createDataFrame(out.collect(), out.schema)
    finally:
        snapshot.unpersist()


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--parquet", help="read this Parquet table instead of the configured warehouse table")
    p.add_argument("--column", default="SRC")
    p.add_argument("--order-by", nargs="*")
    p.add_argument("--env-file")
    a = p.parse_args(argv)
    with session() as spark:
        if a.parquet:
            spec, target = TableSpec("parquet", path=a.parquet), a.parquet
        else:
            s = load_settings(os.environ, a.env_file)
            options = s.reader_options(key_options(s.get("KEY_PATH"), s.get("KEY_PASSPHRASE")))
            spec = warehouse_spec(options, s.get("DATABASE"), s.get("SCHEMA"), s.get("TABLE"), READ_ROWS)
            target = f"{s.get('DATABASE')}.{s.get('SCHEMA')}.{s.get('TABLE')} at {s.url}"
        print(f"reading {target}")
        run(read_table(spark, spec), a.column, a.order_by)


if __name__ == "__main__":
    main()
