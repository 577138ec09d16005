"""Tables stored in buckets: their join needs no shuffle, and a frequent key fills no bucket."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from brindle.sources import joined_buckets, store_bucketed
from brindle.plans.queries import bucketed_lines


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def stored(spark, left, right, keys, **more):
    pair = store_bucketed(left, right, keys, **more)
    return pair, spark.table(pair.left), spark.table(pair.right)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_exchange_and_the_same_rows(spark):
    found = bucketed_lines(spark, "/root/testdata/sf0.001")
    assert "Exchange" not in plan(found) and "SortMergeJoin" in plan(found)
    assert found.count() > 0 and "Exchange" not in plan(found)


def test_a_frequent_key_is_dealt_to_several_buckets(spark):
    """A third of the rows have one key, another third null."""
    right = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id")).alias("k"), F.col("id").alias("share"))
    left = spark.range(0, 40_000, 1, 3).select(F.when(F.col("id") != 5, F.col("id")).alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    pair, a, b = stored(spark, left, right, ["k"], rows=1_000)
    assert pair.share not in (*left.columns, *right.columns)
    assert b.count() == 30_000 and a.count() == 40_000 + 10  # key 7 has 10,001 rows, so eleven shares
    buckets = Counter(r.f for r in b.select(F.input_file_name().alias("f")).collect())
    assert len(buckets) == 32 and max(buckets.values()) < 4_000
    both = joined_buckets(a, b, pair)
    assert "Exchange" not in plan(both) and both.columns == ["k", "v", "share"]
    assert rows(both) == rows(left.join(right, "k"))
    # filters and choices of columns between keep the buckets
    some = joined_buckets(a.filter("v <> 'v7'").select("k", pair.share), b, pair)
    assert "Exchange" not in plan(some) and some.count() == 9_999


def test_odd_rows(spark):
    left = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (None, "a", 2), (2, None, 3), (2, "", 4), (3, "é", 5)], "k int, s string, x int")
    right = spark.createDataFrame([(1, "a", {"m": 1}), (1, "a", {"m": 1}), (None, "a", None), (2, "", None), (3, "é", {}), (4, "z", None)], "k int, s string, m map<string,int>")
    for rows_, a, b in ((1, left, right), (100, left, right), (1, left, right.limit(0)), (1, left.limit(0), right)):
        pair, stored_a, stored_b = stored(spark, a, b, ["k", "s"], rows=rows_)
        assert rows(joined_buckets(stored_a, stored_b, pair)) == rows(a.join(b, ["k", "s"]))
    with pytest.raises(TypeError, match="different buckets"):
        store_bucketed(left, right.withColumn("k", F.col("k").cast("long")), ["k"])
    with pytest.raises(TypeError, match="different hashes"):
        store_bucketed(left.withColumn("k", F.col("k").cast("double")), right.withColumn("k", F.col("k").cast("double")), ["k"])
    with pytest.raises(ValueError, match="key"):
        store_bucketed(left, right, [])
