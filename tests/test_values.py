"""Subtotals, JSON and the exchange with pandas."""

from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.functions import extract
from brindle.operators import cube_sets, rollup_sets, subtotals
from brindle.sources import from_pandas, to_pandas

VALUES = {"n": ("count", "1"), "known": ("count", "v"), "total": ("sum", "v"), "least": ("min", "v")}


@pytest.mark.parametrize("sets", [cube_sets(["a", "b c"]), rollup_sets(["a", "b c"]), [["b c"], []], [["a"]]])
def test_subtotals_equal_brute_force(spark, sets):
    """Groups of nulls beside totals, and values that are all null."""
    rows = [(a, b, v) for i, (a, b) in enumerate([("x", 1), ("x", None), (None, 1), (None, None), ("y", 2)] * 3) for v in (i, None)] + [("z", 9, None)]
    want = []
    for s in sets:
        groups = {}
        for a, b, v in rows:
            groups.setdefault((a if "a" in s else None, b if "b c" in s else None), []).append(v)
        bits = 2 * ("a" not in s) + ("b c" not in s)
        want += [(*k, bits, len(vs), len(known := [v for v in vs if v is not None]), sum(known) if known else None, min(known, default=None)) for k, vs in groups.items()]
    df = spark.createDataFrame(rows, "a string, `b c` int, v int").repartition(3)
    got = subtotals(df, ["a", "b c"], sets, VALUES)
    assert got.columns == ["a", "b c", "grouping_id", *VALUES]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_subtotals_of_no_rows(spark):
    df = spark.createDataFrame([], "a string, v int")
    assert [tuple(r) for r in subtotals(df, ["a"], [["a"], []], VALUES).collect()] in ([], [(None, 1, 0, 0, None, None)])
    with pytest.raises(ValueError):
        subtotals(df, ["a"], [["v"]], VALUES)


def test_subtotals_multiply_groups_not_rows(spark):
    df = spark.range(0, 10_000, 1, 4).selectExpr("cast(id % 3 as string) as a", "id % 2 as b", "id as v")
    plan = subtotals(df, ["a", "b"], cube_sets(["a", "b"]), VALUES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate") and plan.count("Range (") == 1


def test_json_of_all_forms(spark):
    texts = ['{"k": 1, "s": "a", "l": [1, 2], "more": {}}', '{"s": null}', "{}", "", "{", "[1]", '"x"', "3", "null", None, '{"k": "no", "s": "b"}', '{"k": 1.5}', '{"k": 1} x', '{"k": 99999999999, "s": "c"}', '{"l": 3, "k": 4}']
    fields = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", T.StringType()), T.StructField("l", T.ArrayType(T.IntegerType()))])
    df = spark.createDataFrame(list(enumerate(texts)), "id int, `my text` string")
    got = {r.id: (r.p_k, r.p_s, r.p_l, r.why) for r in extract(df, "my text", fields, "p_", "why").collect()}
    bad, other, typed = "malformed", "not an object", "wrong type"
    assert [got[i] for i in range(len(texts))] == [
        (1, "a", [1, 2], None), (None, None, None, None), (None, None, None, None), (None, None, None, bad), (None, None, None, bad), (None, None, None, other), (None, None, None, other), (None, None, None, other), (None, None, None, other),
        (None, None, None, None), (None, "b", None, typed), (None, None, None, typed), (1, None, None, None), (None, "c", None, typed), (4, None, None, typed),
    ]
    assert extract(df.limit(0), "my text", fields).count() == 0
    with pytest.raises(ValueError):
        extract(df, "my text", T.StructType([T.StructField("ID", T.IntegerType())]))


def test_pandas_and_back(spark):
    """Nulls, decimals, times with and without zone, nested and binary values come back equal; too much raises."""
    kind = "i long, d decimal(20,4), t timestamp, n timestamp_ntz, a date, s string, x double, b binary, l array<int>, m struct<p:int,q:array<string>>, `e.f` boolean, y map<string,int>"
    at = datetime(2024, 3, 31, 1, 30)
    rows = [(2**62 + 1, Decimal("1.2500"), at, at, date(1970, 1, 1), "é", float("nan"), b"\x00", [1, None], (None, ["x"]), True, {"k": None}), (None,) * 12]
    df = spark.createDataFrame(rows, kind)
    local = to_pandas(df)
    assert local["i"].tolist()[0] == 2**62 + 1 and local["t"][0].astimezone(timezone.utc).hour == 1
    back = from_pandas(spark, local)
    assert [f.dataType for f in back.schema.fields] == [f.dataType for f in df.schema.fields] and back.columns == df.columns
    plain = lambda x: sorted((repr(tuple(r)) for r in x.collect()))
    assert plain(back) == plain(df)
    empty = from_pandas(spark, to_pandas(df.limit(0)))
    assert empty.count() == 0 and empty.dtypes == df.dtypes
    with pytest.raises(ValueError, match="more than"):
        to_pandas(spark.range(10_000).withColumn("x", F.lit("y" * 100)), most=100_000)
