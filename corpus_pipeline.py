"""The corpus pipeline: each stage works on all that the one before has kept."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.llm import decontaminate, mixing, neardup, pii, quality
from brindle.llm.common import joined, table, unused, written


def quoted(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def orderable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    return not isinstance(kind, T.StructType) or all(orderable(f.dataType) for f in kind.fields)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from the labels of these, doesn't reject: those that are likelier
    good than not, so that clean documents on which it is unsure stay.
    """
    found = quality.classify(docs, table(spark, sf_dir, "labels"), threshold=0.5)
    return joined(docs, found.filter("predicted = 1"), "left_semi")


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id. Repeated rows share their id, so that
    all of them are kept by it: of these the one stays whose other columns come first in order (maps aside).
    """
    copies, rest = unused(docs, "copies"), [c for c in docs.columns if c not in ("doc_id", "text")]
    found = neardup.groups(docs).filter("kept").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("copies"))
    kept = joined(docs, written(found, "near-kept"), "inner", {"copies": copies})
    several = kept.filter(F.col(copies) > 1).drop(copies)  # the same exchange as below; only these rows go on to another
    row, order = F.struct(*map(quoted, rest)), F.struct(*(quoted(c) for c in rest if orderable(docs.schema[c].dataType)))
    one = several.groupBy("doc_id", "text").agg(F.min_by(row, order).alias(copies)) if rest else several.distinct()
    one = one.select(*(F.col(f"{quoted(copies)}.{quoted(c)}").alias(c) if c in rest else F.col(quoted(c)) for c in docs.columns))
    return kept.filter(F.col(copies) == 1).drop(copies).unionByName(one)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return joined(docs, found.filter("n_hit = 0"), "left_semi")


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts masked."""
    return pii.masked(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the words of each that it takes, repeats counted. Columns of these names
    that the documents have themselves are renamed, with underscores behind.
    """
    own = {k: k for k in ("size", "source_size", "target", "taken")}
    for c in docs.columns:
        if c.lower() in own:
            docs = docs.withColumnRenamed(c, unused(docs, c + "_"))
    return joined(docs, mixing.mix(docs).filter("taken > 0"), "inner", own)


STAGES = [("quality", good), ("near_dedup", distinct), ("decontaminate", clean), ("pii", private), ("mixing", mixed)]

#: Classifiers and components are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each but the last written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    return reduce(lambda df, stage: written(stage[1](spark, df, sf_dir), f"pipeline-{stage[0]}"), STAGES[:-1], docs).transform(lambda df: STAGES[-1][1](spark, df, sf_dir))
