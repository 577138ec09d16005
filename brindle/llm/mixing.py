"""Mixing sources to target weights, by hash thresholds that are found in histograms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import written

#: Buckets of one histogram; each further round splits the boundary bucket into as many.
BITS = 12
ROUNDS = 5


def ranked(sources: DataFrame, name: str) -> DataFrame:
    """sources with sid, its place in the order of name by code point, null last, counted in two steps: within the
    parts of a range partitioning, and of the parts before.
    """
    key = [F.col(name).isNull(), F.col(name)]
    # the upper bits tell the part, the lower 33 the place in it
    parts = written(sources.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    parts = parts.withColumn("part", F.shiftright("at", 33))
    sizes = sorted(tuple(r) for r in parts.groupBy("part").count().collect())  # one for each part
    before = [(p, n) for (p, _), n in zip(sizes, accumulate((n for _, n in sizes), initial=0), strict=False)]
    offset = F.broadcast(sources.sparkSession.createDataFrame(before, "part long, before long"))
    return parts.join(offset, "part").withColumn("sid", F.col("at").bitwiseAND((1 << 33) - 1) + F.col("before")).drop("part", "at", "before")


def targeted(sources: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """sources (sid, source_size) with target: in proportion to the weights, together share of all sizes, none above
    cap times its size.

    Those that would go above their cap stop there, and the rest share what is left, until none is above: rounds of
    one aggregate each over the sources. A source that stopped stays so, as what is left for a weight only grows.
    """
    turn = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod("sid", F.lit(len(weights))) + 1).cast("int"))
    sources = sources.withColumn("weight", turn)
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    rate = lambda: F.col("weight") * F.lit(left) / F.lit(weight)
    left, weight, above = share * total, float(sources.agg(F.sum("weight")).first()[0] or 0), -1
    if not total:
        return sources.withColumn("target", F.lit(0.0)).drop("weight")
    while weight:
        over = rate() > cap * F.col("source_size")
        capped, n, rest = sources.agg(F.sum(F.when(over, F.col("source_size"))), F.count(F.when(over, 1)), F.sum(F.when(~over, F.col("weight")))).first()
        if n == above:
            break
        above, left, weight = n, share * total - cap * float(capped or 0), float(rest or 0)
    aim = F.when(over, cap * F.col("source_size")).otherwise(rate()) if weight else cap * F.col("source_size")
    return sources.withColumn("target", aim).drop("weight")


def bucket(k: int) -> Column:
    """The k-th BITS of the hash, the highest first."""
    return F.shiftrightunsigned("hash", 64 - BITS * (k + 1)).bitwiseAND((1 << BITS) - 1)


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target and taken, a row for each document.

    Sources in order of code points, null last, get the weights by turns. Each document is taken whole as often
    as target / source_size allows for all; the rest of the budget goes to the documents with the smallest hashes
    of their id and text. Rounds of histograms, tokens by source and bucket of the hash, find the threshold: each
    looks only into the bucket where the round before ran out of budget. What is left at the last boundary (one
    document, or equal rows) is shared in proportion to size, so that the target is met but for rounding down.
    Null texts have size 0; sources without words get target 0; no rows give none. Further columns are passed over.
    """
    base = written(
        docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"), F.xxhash64("doc_id", "text").alias("hash")),
        "mix-sizes",
    )
    by_source = ranked(base.groupBy("source").agg(F.sum("size").alias("source_size")), "source")
    plan = targeted(by_source, weights, share, cap)
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = written(plan.withColumn("times", times.cast("int")).withColumn("budget", (F.col("target") - F.col("times") * F.col("source_size")).cast("long")), "mix-targets")

    known = base.join(plan.select(F.col("source").alias("s"), "sid"), base.source.eqNullSafe(F.col("s"))).drop("s")
    open_docs, ends = known, plan.select("sid", "budget")
    path = Window.partitionBy("sid").orderBy("bucket")
    rounds = 0
    for k in range(ROUNDS):
        rounds += 1
        # at most 2 ** BITS rows a source, whatever the number of documents; no further round splits single ones
        sums = open_docs.groupBy("sid", bucket(k).alias("bucket")).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("docs")).join(ends, "sid")
        sums = sums.withColumn("before", F.sum("n").over(path) - F.col("n")).filter("before <= budget and before + n > budget")
        edge = written(sums.select("sid", F.col("bucket").alias(f"edge{k}"), (F.col("budget") - F.col("before")).alias("budget"), F.col("n").alias("cell"), "docs"), "mix-edge")
        ends = edge.select("sid", "budget")
        plan = plan.join(edge.select("sid", f"edge{k}", F.col("budget").alias(f"rest{k}"), F.col("cell").alias(f"cell{k}")), "sid", "left")
        open_docs = open_docs.join(edge.select("sid", f"edge{k}"), "sid").filter(bucket(k) == F.col(f"edge{k}")).drop(f"edge{k}")
        if (edge.agg(F.max("docs")).first()[0] or 0) <= 1:
            break

    # below a round's edge: taken; above: not; on it: the next round says. A source without an edge is taken whole
    last = rounds - 1
    share_of = F.floor(F.col("size") * F.col(f"rest{last}").cast("decimal(38,0)") / F.col(f"cell{last}")).cast("long")
    extra = reduce(lambda inner, k: F.when(F.col(f"edge{k}").isNull() | (bucket(k) < F.col(f"edge{k}")), F.col("size")).when(bucket(k) > F.col(f"edge{k}"), F.lit(0)).otherwise(inner), reversed(range(rounds)), share_of)
    p = written(plan, "mix-plan").withColumnRenamed("source", "s")
    extra = F.when(F.col("budget") <= 0, F.lit(0)).otherwise(extra)
    return base.join(p, base.source.eqNullSafe(p.s)).select("doc_id", "text_hash", "source", "size", "source_size", "target", (F.col("size") * F.col("times") + extra).cast("long").alias("taken"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("source", "text_hash")
