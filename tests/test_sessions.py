"""Sessions and rolling sums against brute force."""

from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import rolling, sessions

VALUES = {"n": ("count", "1"), "total": ("sum", "v"), "least": ("min", "v"), "most": ("max", "v")}


def drawn(seed, n=400):
    rng = np.random.default_rng(seed)
    return [(None if rng.random() < 0.03 else int(rng.random() < 0.4) or int(rng.integers(2, 6)), None if rng.random() < 0.03 else int(rng.integers(-200, 200)), None if rng.random() < 0.1 else int(rng.integers(0, 9)), i) for i in range(n)]


def summed(vs):
    known = [v for v in vs if v is not None]
    return (len(vs), sum(known) if known else None, min(known, default=None), max(known, default=None))


@pytest.mark.parametrize("seed,gap", [(1, 5), (2, 1), (3, 0), (4, 1000)])
def test_sessions_equal_brute_force(spark, seed, gap):
    """Nulls, equal times, times below zero, a frequent key, a gap that is just met or just passed."""
    rows = drawn(seed) + [(9, 0, 1, 900), (9, gap, 2, 901), (9, 2 * gap + 1, 3, 902)]
    want = []
    for k in {r[0] for r in rows} - {None}:
        mine, held = sorted((t, v) for a, t, v, _ in [(a, t, -1 if v is None else v, i) for a, t, v, i in rows] if a == k and t is not None), []
        for t, v in [*mine, (10**9, 0)]:
            if held and t - held[-1][0] > gap:
                want.append((k, held[0][0], held[-1][0], *summed([None if x == -1 else x for _, x in held])))
                held = []
            held.append((t, v))
    got = sessions(spark.createDataFrame(rows, "k int, t int, v int, start int").repartition(3), ["k"], "t", gap, VALUES)
    assert got.columns == ["k", "start", "end", "n", "total", "least", "most"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_sessions_of_times(spark):
    rows = [("a", datetime(2024, 3, 31, 0, 59)), ("a", datetime(2024, 3, 31, 1, 29)), ("a", datetime(2024, 3, 31, 2, 0)), ("b", datetime(1960, 1, 1))]
    df = spark.createDataFrame(rows, "k string, t timestamp")
    for kind in ("timestamp", "timestamp_ntz"):
        got = sessions(df.withColumn("t", F.col("t").cast(kind)), ["k"], "t", timedelta(minutes=30), {"n": ("count", "1")})
        assert sorted((r.k, r.start, r.end, r.n) for r in got.collect()) == [("a", rows[0][1], rows[1][1], 2), ("a", rows[2][1], rows[2][1], 1), ("b", rows[3][1], rows[3][1], 1)]
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 3),)], "t date")
    assert sessions(days, [], "t", timedelta(days=2), {}).count() == 1 and sessions(days, [], "t", timedelta(days=1), {}).count() == 2
    assert sessions(days.limit(0), [], "t", 1, {}).count() == 0
    with pytest.raises(ValueError):
        sessions(days, [], "t", 1, {"x": ("median", "t")})


def test_a_frequent_key_is_added_up_before_the_shuffle(spark):
    """A key with all rows sends one row for each cell and task, not its rows."""
    rows = spark.range(0, 50_000, 1, 4).selectExpr("'hot' as k", "id % 100 as t", "id as v")
    got = sessions(rows, ["k"], "t", 10, VALUES)
    assert [tuple(r) for r in got.collect()] == [("hot", 0, 99, 50_000, 50_000 * 49_999 // 2, 0, 49_999)]
    plan = got._jdf.queryExecution().executedPlan().toString().partition("Initial Plan")[0]
    assert plan.rindex("partial_count") > plan.rindex("Exchange")  # the deepest step below the shuffles


@pytest.mark.parametrize("seed,span", [(1, 5), (2, 1), (3, 0), (4, 1000)])
def test_rolling_equals_brute_force(spark, seed, span):
    rows = drawn(seed)
    got = rolling(spark.createDataFrame(rows, "k int, t int, v int, id int").repartition(3), ["k"], "t", span, VALUES)
    assert got.columns == ["k", "t", "v", "id", *VALUES]
    want = [(*r, *(summed([v for k, t, v, _ in rows if k == r[0] and t is not None and r[1] - span <= t <= r[1]]) if None not in r[:2] else (None,) * 4)) for r in rows]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[3]) == want


def test_rolling_of_times_and_no_rows(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1, h)) for h in (0, 5, 6, 11)], "k int, t timestamp")
    for kind in ("timestamp", "timestamp_ntz"):
        got = rolling(df.withColumn("t", F.col("t").cast(kind)), ["k"], "t", timedelta(hours=6), {"n": ("count", "1")})
        assert sorted((r.t.hour, r.n) for r in got.collect()) == [(0, 1), (5, 2), (6, 3), (11, 3)]
    assert rolling(df.limit(0), ["k"], "t", timedelta(hours=1), {}).count() == 0
    with pytest.raises(ValueError):
        rolling(df, ["k"], "t", 1, {"K": ("count", "1")})
