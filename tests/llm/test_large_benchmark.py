"""Decontamination where the benchmark's shingles outgrow a broadcast."""

import re

import pytest

from pyspark.sql import functions as F

from brindle.llm import decontaminate
from brindle.llm.common import table

SF = "/root/testdata/sf0.01"


def rows(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.spans) for r in df.collect()), key=repr)


@pytest.fixture
def forced(monkeypatch):
    """No broadcast of shingles or windows, and tokens of a few places count as frequent."""
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", 1)
    monkeypatch.setattr(decontaminate, "HOT", 3)


def test_the_same_rows_either_way(spark, monkeypatch, forced):
    args = table(spark, SF, "documents").repartition(6), table(spark, SF, "benchmark")
    found = rows(decontaminate.decontaminate(*args))
    monkeypatch.undo()
    assert found == rows(decontaminate.decontaminate(*args)) and any(r[2] for r in found)


@pytest.mark.parametrize("window", [1, 4])
def test_odd_rows_either_way(spark, monkeypatch, forced, window):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (4, "b a " * 3_000), (5, "a b c d"), (5, "a b c d"), (None, "c d e f g"), (6, "x " + "q w e r t y " * 50)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a"), (2, "a b"), (3, "b c d e"), (None, "q w e r t y q"), (4, None), (5, ""), (2, "c d e f")], "item_id long, text string")
    found = rows(decontaminate.decontaminate(docs, bench, window))
    empty = rows(decontaminate.decontaminate(docs, bench.limit(0), window)), rows(decontaminate.decontaminate(docs.limit(0), bench, window))
    monkeypatch.undo()
    assert found == rows(decontaminate.decontaminate(docs, bench, window))
    assert {r[2] for r in empty[0]} == {0} and empty[1] == []


def test_a_sieve_keeps_its_tokens_and_few_others(spark):
    tokens = spark.range(200_000).select(F.xxhash64("id").alias("token"))
    each = spark.range(400_000).select("id", F.xxhash64("id").alias("token"))
    kept = decontaminate.possible(each, tokens).agg(F.count_if(F.col("id") < 200_000).alias("own"), F.count_if(F.col("id") >= 200_000).alias("others")).first()
    assert kept.own == 200_000 and kept.others < 200
    # as many rows for a benchmark of any size: of ten million tokens each still has 27 bits
    sieve = decontaminate.sieve(tokens)
    assert sieve.count() <= decontaminate.SIEVE_ROWS and sieve.filter("size(bits) <> 64").isEmpty()


def test_only_rows_past_the_sieve_are_shuffled_and_nothing_leaves_the_jvm(spark, monkeypatch, forced):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    base = docs.select(F.monotonically_increasing_id().alias("uid"), decontaminate.words("text").alias("words")).withColumn("n_words", F.size("words"))
    items = decontaminate.windows_of(bench, 10).select("w", "len").distinct()
    tokens = items.select("w", "len", F.inline(decontaminate.shingles(F.split("w", " "), F.col("len"))))
    prefix = tokens.groupBy("w", "len").agg(F.min_by(F.struct("token", "at"), "token").alias("p")).select("w", "len", "p.token", F.col("p.at").alias("offset"), F.lit(9).cast("long").alias("n"))
    every = decontaminate.shingled(base, False)
    known, passed = tokens.select("token").distinct(), decontaminate.possible(every, tokens.select("token").distinct())
    assert passed.join(known, "token", "left_anti").count() <= every.count() / 1_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = decontaminate.occurrences(base, prefix, False, 10)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    # the first exchange by token and share is the documents'; the sieve stands below it
    dealt = re.search(r"hashpartitioning\(token#\d+L, share#\d+", plan)
    assert dealt and re.search(r"\b(bit_get|getbit)\(", plan[dealt.end() :]) and "posexplode" in plan[dealt.end() :]
