"""As-of and interval joins against brute force."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import asof, intervals
from brindle.operators.asof import asof_join
from brindle.operators.intervals import interval_join


def matches(lefts, rights, strict, differ, tolerance):
    """For rows (key, time, kind, id): the latest row of right, of one time that with the largest id."""
    out = []
    for k, t, x, i in lefts:
        fits = [r for r in rights if None not in (k, t, r[0], r[1]) and r[0] == k and (r[1] < t or not strict and r[1] == t) and (not differ or None not in (x, r[2]) and r[2] != x)]
        best = max(fits, key=lambda r: (r[1], r[3]), default=None)
        out.append((i, best[3] if best and (tolerance is None or t - best[1] <= tolerance) else None))
    return sorted(out)


def sides(seed, n, hot):
    rng = np.random.default_rng(seed)
    key = lambda: None if rng.random() < 0.03 else "hot" if rng.random() < hot else f"k{rng.integers(0, 6)}"
    row = lambda i: (key(), None if rng.random() < 0.03 else int(rng.integers(0, 60)), None if rng.random() < 0.05 else f"x{rng.integers(0, 3)}" if rng.random() < 0.4 else "x9", i)
    return [row(i) for i in range(n)], [row(1000 + i) for i in range(n)]


@pytest.mark.parametrize("seed,hot,batch", [(1, 0.3, 10_000), (2, 0.98, 10_000), (3, 0.5, 7), (4, 0.0, 1)])
@pytest.mark.parametrize("strict,differ,tolerance", [(True, None, None), (False, None, 5), (True, "x", None), (False, "x", 9)])
def test_asof_equals_brute_force(spark, seed, hot, batch, strict, differ, tolerance):
    """Frequent keys over many partitions, ties, nulls, rows with nothing before them, and batches of any size."""
    lefts, rights = sides(seed, 120, hot)
    kind = "k string, t int, x string, id int, other map<string,int>"
    left, right = (spark.createDataFrame([(*r, {"a": r[3]}) for r in rows], kind).repartition(3) for rows in (lefts, rights))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = asof_join(left, right, ["k"], "t", strict=strict, differ=differ, tolerance=tolerance, order=["id"], partitions=9)
        assert got.columns == ["k", "t", "x", "id", "other", "right_k", "right_t", "right_x", "right_id", "right_other"]
        rows = got.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted((r.id, r.right_id) for r in rows) == matches(lefts, rights, strict, differ, tolerance)
    assert all(r.other == {"a": r.id} and (r.right_id is None) == (r.right_k is None) == (r.right_other is None) for r in rows)


def test_asof_of_empty_sides_and_all_kinds_of_time(spark):
    one = spark.createDataFrame([(1, datetime(2024, 3, 31, 1, 30), date(2024, 1, 5))], "k int, t timestamp, d date").withColumn("n", F.col("t").cast("timestamp_ntz"))
    for at, gap, near in (("t", timedelta(hours=1), timedelta(hours=2)), ("n", timedelta(hours=1), timedelta(hours=2)), ("d", timedelta(days=1), timedelta(days=2))):
        early = one.withColumn(at, F.col(at) - (F.expr("interval 2 hours") if at != "d" else F.lit(2)))
        assert [asof_join(one, early, ["k"], at, tolerance=x).first()[f"right_{at}"] is not None for x in (gap, near, None)] == [False, True, True]
    assert asof_join(one.limit(0), one, ["k"], "t").count() == 0
    assert [r.right_k for r in asof_join(one, one.limit(0), ["k"], "t").collect()] == [None]
    assert [r.right_k for r in asof_join(one, one, [], "t", strict=False).collect()] == [1]
    with pytest.raises(TypeError):
        asof_join(one.withColumn("k", F.lit(1.5)), one.withColumn("k", F.lit(1.5)), ["k"], "t")
    with pytest.raises(TypeError):
        asof_join(one.withColumn("t", F.lit("x")), one, ["k"], "t")
    with pytest.raises(ValueError):
        asof_join(one.withColumn("right_k", F.lit(1)), one, ["k"], "t")


def test_asof_deals_out_one_key_and_forms_no_pairs(spark):
    """All rows have one key and half of them one time: no partition gets many, and each row is written once."""
    rows = spark.range(20_000).selectExpr("'hot' as k", "if(id % 2 = 0, 7, id) as t", "id")
    got = asof_join(rows, rows, ["k"], "t", order=["id"], partitions=16)
    assert got.count() == 20_000
    sizes = []
    kept = asof.written

    def seen(df, name):
        out = kept(df, name)
        sizes.extend(r["count"] for r in out.filter("kind != 2").groupBy("slice").count().collect())
        return out

    asof.written = seen
    try:
        want = {r.id: r.right_id for r in asof_join(rows, rows, ["k"], "t", order=["id"], partitions=16).collect()}
    finally:
        asof.written = kept
    assert sum(sizes) == 20_000 and len(sizes) >= 12 and max(sizes) < 6_000
    assert want[19_999] == 19_997 and want[9] == 19_998 and want[5] == 3 and want[8] == 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("seed,hot", [(1, 10**9), (2, 3), (3, 1)])
@pytest.mark.parametrize("closed", [False, True])
def test_intervals_equal_brute_force(spark, monkeypatch, seed, hot, closed):
    """Lengths from none to very long, bounds below zero, nulls, repeated rows, and hot cells."""
    monkeypatch.setattr(intervals, "HOT", hot)
    rng = np.random.default_rng(seed)
    key = lambda: None if rng.random() < 0.05 else "hot" if rng.random() < 0.5 else "k"
    points = [(key(), None if rng.random() < 0.05 else int(rng.integers(-300, 300)), i) for i in range(150)] + [("hot", 5, 150)] * 3 + [("k", -(2**62), 151)]
    spans = [(key(), s := int(rng.integers(-320, 300)), s + int(rng.choice([-3, 0, 1, 2, 3, 8, 9, 100, 700])), i) for i in range(60)] + [("k", None, 3, 60), ("k", 3, None, 61), ("k", -(2**62), 2**62, 62), ("hot", 5, 6, 63), ("hot", 5, 6, 63)]
    p = spark.createDataFrame(points, "k string, at long, id int").repartition(3)
    i = spark.createDataFrame(spans, "k string, start long, end long, id int").repartition(2)
    got = interval_join(p, i, ["k"], "at", "start", "end", closed=closed)
    want = sorted((a[2], b[3]) for a in points for b in spans if None not in (*a[:2], *b[:3]) and a[0] == b[0] and (b[1] <= a[1] < b[2] or closed and b[1] <= a[1] == b[2]))
    assert sorted((r.id, r.interval_id) for r in got.collect()) == want
    assert interval_join(p.limit(0), i, ["k"], "at", "start", "end").count() == interval_join(p, i.limit(0), ["k"], "at", "start", "end").count() == 0


def test_intervals_of_one_class_send_each_point_once(spark):
    """With lengths of one class the points aren't multiplied, and no pair outside the interval is kept."""
    p = spark.range(1000).selectExpr("1 as k", "id as at")
    i = spark.range(10).selectExpr("1 as k", "id * 100 as start", "id * 100 + 9 as end")
    got = interval_join(p, i, ["k"], "at", "start", "end")
    assert got.count() == 90
    with pytest.raises(ValueError):
        interval_join(p.withColumn("interval_k", F.lit(1)), i, ["k"], "at", "start", "end")
