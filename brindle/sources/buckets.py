"""Two tables stored by the hash of their keys, so that any number of joins on these goes without a shuffle."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.sources.shared import quoted, shared_path, written

#: About so many rows of the larger table in a bucket; a key of more rows is dealt to several buckets.
BUCKET_ROWS = 4_000_000


class BucketedPair(NamedTuple):
    """Names of the two stored tables, their keys, and the column that tells the shares of a frequent key apart."""

    left: str
    right: str
    keys: tuple[str, ...]
    share: str


def store_bucketed(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: int = BUCKET_ROWS) -> BucketedPair:
    """Stores both tables in the same number of buckets by the columns ``keys``, which both have, each bucket sorted.

    ``right`` is the table that may have frequent keys. One with over ``rows`` rows there is dealt to shares of about
    so many, which are stored as keys of their own, and the rows of ``left`` with that key are repeated for each share. So no
    bucket holds more of one key than about ``rows`` rows, as without a shuffle at the join nothing could split it later.
    Shares go by the hash of a row's columns (maps aside), so rows of ``right`` that are equal in all stay together.

    Rows of ``left`` with a null key are stored once, and those of ``right`` with one are dealt to all buckets: neither
    meets anything in a join. Each bucket is one file, as rows are shuffled by the buckets' own hash before the write.
    """
    if not keys:
        raise ValueError("a key is needed")
    for k in keys:
        kind = left.schema[k].dataType
        if kind != right.schema[k].dataType:
            raise TypeError(f"{k} is {kind.simpleString()} and {right.schema[k].dataType.simpleString()}: equal values would lie in different buckets")
        if isinstance(kind, (T.FractionalType, T.ArrayType, T.MapType, T.StructType, T.VariantType)) and not isinstance(kind, T.DecimalType):
            raise TypeError(f"key {k} is {kind.simpleString()}, whose equal values may have different hashes")
    columns = [quoted(k) for k in keys]
    taken, share = {c.lower() for c in (*left.columns, *right.columns)}, "share"
    while taken & {share, share + "_key", share + "_n"}:
        share += "_"
    null = reduce(or_, (F.col(c).isNull() for c in columns))
    key = F.xxhash64(*columns).alias(share + "_key")

    # rows are counted before the shuffle, so that a frequent key costs one row a task
    counts = written(right.filter(~null).groupBy(key).agg(F.count(F.lit(1)).alias(share + "_n")), "bucket-counts")
    buckets = 1 << max(right.count() // rows, 1).bit_length()
    # fewer keys than buckets have more rows than this, at two numbers each, which bounds what is broadcast
    frequent = F.broadcast(counts.withColumn(share + "_n", F.ceil(F.col(share + "_n") / rows).cast("int")).filter(F.col(share + "_n") > 1))
    shares = F.coalesce(share + "_n", F.lit(1))
    comparable = [F.col(quoted(f.name)) for f in right.schema.fields if not re.search(r"\b(map<|variant)", f.dataType.simpleString())]
    dealt = F.pmod(F.xxhash64(*comparable), F.when(null, F.lit(buckets)).otherwise(shares)).cast("int").alias(share)
    each = F.explode(F.sequence(F.lit(0), F.when(null, F.lit(1)).otherwise(shares) - 1)).alias(share)
    left, right = (df.withColumn(share + "_key", key).join(frequent, share + "_key", "left").select(*(F.col(quoted(c)) for c in df.columns), of) for df, of in ((left, each), (right, dealt)))

    names = []
    for df in (left, right):
        name = f"bucketed_{uuid.uuid4().hex}"
        by = [*keys, share]
        placed = df.repartition(buckets, *map(quoted, by))
        placed.write.format("parquet").bucketBy(buckets, by[0], *by[1:]).sortBy(by[0], *by[1:]).option("path", shared_path(df.sparkSession, name)).saveAsTable(name)
        names.append(name)
    return BucketedPair(*names, tuple(keys), share)


def joined_buckets(left: DataFrame, right: DataFrame, pair: BucketedPair) -> DataFrame:
    """The inner join of the two tables, read by ``pair``'s names and perhaps filtered, bucket with bucket. An outer join
    isn't given: a row of the left table may stand in several buckets.
    """
    return left.join(right.hint("merge"), [*pair.keys, pair.share]).drop(pair.share)
