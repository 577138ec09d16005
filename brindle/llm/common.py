"""What the operators share: written tables in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. In local mode one of our own, where none is set; on a
    cluster, whose machines don't share such a folder, that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.conf.get("spark.master", "")):
            raise RuntimeError("spark.checkpoint.dir isn't set: operators write tables that all executors must reach")
        found = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """name, or with so many underscores after it that df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def joined(docs: DataFrame, found: DataFrame, how: str, more: dict[str, str] | None = None) -> DataFrame:
    """docs joined to an operator's result by document (doc_id and text_hash), null ids too, with the result's columns
    in more under the names given there, which docs doesn't have.
    """
    of, text_hash = unused(docs, "of"), unused(docs, "hash_of")
    found = found.select(F.col("doc_id").alias(of), F.col("text_hash").alias(text_hash), *(F.col(k).alias(v) for k, v in (more or {}).items())).dropDuplicates([of, text_hash])
    return docs.join(found, docs["doc_id"].eqNullSafe(F.col(of)) & (F.xxhash64(docs["text"]) == F.col(text_hash)), how).drop(of, text_hash)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
