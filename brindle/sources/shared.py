"""Tables of one run, written to the folder that all executors reach."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. In local mode a temporary one where none is set; on a cluster, whose machines
    share no such folder, that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise RuntimeError("spark.checkpoint.dir isn't set: operators write tables that all executors must reach")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run has."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: what is read from it stays the same whatever executors are lost."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"
