"""Stored sketches against exact values, and partitioned writes that fail or are run again."""

from datetime import datetime

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from brindle.operators import estimates, merged_sketches, period_sketches
from brindle.operators.sketches import LOG_ENTRIES, QUANTILE_K, RANK_ERROR
from brindle.plans.queries import sketched_weeks
from brindle.sources import read_partitions, replace_partitions


def test_sketches_merge_within_their_errors(spark):
    """A million rows over ten days; merged in one step or in two, against exact counts and ranks."""
    n = 1_000_000
    rows = spark.range(0, n, 1, 8).selectExpr("timestamp_seconds(id % 10 * 86400) as t", "if(id % 3 = 0, 'hot', 'k') as k", "pmod(xxhash64(id), 200000) as u", "cast(pmod(xxhash64(id, 7), 1000003) as double) as v")
    days = period_sketches(rows, "t", "day", ["k"], {"users": "u"}, {"v": "v"})
    assert days.count() == 20
    once = merged_sketches(days, [], ["users"], ["v"])
    twice = merged_sketches(merged_sketches(days, ["k"], ["users"], ["v"]), [], ["users"], ["v"])
    true = rows.select("u").distinct().count()
    ranks = [0.01, 0.25, 0.5, 0.99]
    for got in (once, twice):
        r = estimates(got, ["users"], {"v": ranks}).first()
        assert r.n == n and abs(r.users / true - 1) < 4 * 2 ** (-LOG_ENTRIES / 2)
        exact = rows.select(*(F.avg((F.col("v") <= v).cast("int")) for v in r.v)).first()
        assert all(abs(a - b) < 3 * RANK_ERROR for a, b in zip(exact, ranks, strict=True))


def test_small_sketches_are_exact(spark):
    kind = "t timestamp, k string, u string, v int"
    rows = [(datetime(2024, 1, 1, h % 24), None if h % 7 == 0 else "a", f"u{h % 5}" if h % 3 else None, h) for h in range(100)] + [(None, "a", "u9", None), (None, "b", None, None)]
    df = spark.createDataFrame(rows, kind).repartition(3)
    assert QUANTILE_K > 100
    got = {(r.period_start and r.period_start.day, r.k): (r.n, r.u, r.v) for r in estimates(period_sketches(df, "t", "day", ["k"], {"u": "u"}, {"v": "v"}), ["u"], {"v": [0.0, 1.0]}).collect()}
    for k in (None, "a"):
        mine = [r for r in rows[:100] if r[1] == k]
        assert got[1, k] == (len(mine), len({r[2] for r in mine} - {None}), [min(r[3] for r in mine), max(r[3] for r in mine)])
    assert got[None, "a"] == (1, 1, None) and got[None, "b"] == (1, 0, None)
    assert merged_sketches(period_sketches(df.limit(0), "t", "day", ["k"], {"u": "u"}, {"v": "v"}), ["k"], ["u"], ["v"]).count() == 0


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_writes_replace_their_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", 7, "x y/z"), (2, "a", 7, None), (3, None, 8, "x y/z"), (4, "b", None, "01")], "id int, v string, n int, p string")
    read = lambda: read_partitions(spark, path, first.schema, ["p"])
    replace_partitions(first, path, ["p"])
    assert read().columns == first.columns and read().schema["p"].dataType.simpleString() == "string"
    assert rows(read()) == rows(first)
    for _ in range(2):  # the same write again, from the table itself
        replace_partitions(read().filter("p = 'x y/z'").withColumn("v", F.lit("new")), path, ["p"])
        assert rows(read()) == rows(first.withColumn("v", F.when(F.col("p") == "x y/z", "new").otherwise(F.col("v"))))
    replace_partitions(first.limit(0), path, ["p"])
    assert read().count() == 4
    replace_partitions(first.filter("p is null").withColumn("id", F.lit(9)), path, ["p"])
    assert [r.id for r in read().filter("p is null").collect()] == [9]


def test_a_failed_task_leaves_the_table(spark, tmp_path):
    """Written, then with a task that fails after others have ended, then again: read back equal each time."""
    path = str(tmp_path / "t")
    df = spark.range(0, 1000, 1, 8).selectExpr("id", "id % 3 as p")
    replace_partitions(df, path, ["p"])

    def failing(batches):
        for b in batches:
            if 990 in b.column(0).to_pylist():
                raise ValueError("lost")
            yield b

    other = df.withColumn("id", F.col("id") * 1)
    with pytest.raises(PythonException):
        replace_partitions(other.mapInArrow(failing, other.schema), path, ["p"])
    assert rows(read_partitions(spark, path, df.schema, ["p"])) == rows(df)
    replace_partitions(other, path, ["p"])
    assert rows(read_partitions(spark, path, df.schema, ["p"])) == rows(df)


def test_what_cannot_be_a_partition_is_refused(spark, tmp_path):
    df = spark.createDataFrame([(1, "", 1.5)], "id int, p string, x double")
    for by, error in ((["p"], ValueError), (["x"], TypeError), ([], ValueError), (["id", "p"], ValueError)):
        with pytest.raises(error):
            replace_partitions(df, str(tmp_path / "t"), by)
    assert not (tmp_path / "t").exists()


def test_a_large_partition_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(0, 400_000, 1, 4).selectExpr("id", "xxhash64(id) as v", "if(id < 10, 'few', 'hot') as p")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        replace_partitions(df, str(tmp_path / "t"), ["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "p=hot").glob("*.parquet"))) > 2


def test_weeks_count_many_users_exactly(spark, tmp_path):
    """More users than a sketch holds, and null weeks, kinds, users and values."""
    rows = spark.range(0, 40_000, 1, 4).selectExpr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 14 as int)) as ts", "id % 15000 as user_id", "'a' as event_type", "cast(id as double) as value")
    odd = spark.createDataFrame([(None, 1, "a", 1.0), (None, None, None, None), (None, 2, None, None)], "ts timestamp_ntz, user_id long, event_type string, value double")
    rows.unionByName(odd).write.parquet(str(tmp_path / "events.parquet"))
    got = {(r.week and r.week.day, r.event_type): (r.n, r.users, r.median_holds) for r in sketched_weeks(spark, str(tmp_path)).collect()}
    week = lambda k: len({i % 15_000 for i in range(40_000) if i % 14 // 7 == k})
    assert week(0) > 2**LOG_ENTRIES
    assert got == {(1, "a"): (20_001, week(0), True), (8, "a"): (19_999, week(1), True), (None, "a"): (1, 1, True), (None, None): (2, 1, True)}
