"""Windowed counts of a stream, kept up to date in a table that a restarted query carries on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from brindle.sources.shared import quoted

#: How the values of a window are named beside its start and end, and the batch that wrote a row.
BATCH = "batch_id"


def windowed_counts(stream: DataFrame, time: str, width: str, keys: Sequence[str] = (), values: Mapping[str, tuple[str, str]] | None = None, *, slide: str | None = None, late: str = "1 hour", once_by: Sequence[str] = ()) -> DataFrame:
    """window_start, window_end, the keys, n (rows) and values (as for sessions) of each window of ``width``, one each
    ``slide`` where that is given.

    Rows may come up to ``late`` behind the latest time seen so far; later ones are dropped once their window is past
    that, which also bounds what the state holds. With ``once_by`` (an id and such), rows that repeat these columns within
    that time count once. Rows without a time are in no window; null keys are a group. Works the same on a batch table,
    where nothing is late. Aggregates are partial in each task before they are dealt out by window and key, so that one
    frequent key sends a row a task.
    """
    rows = stream.filter(F.col(quoted(time)).isNotNull())
    at = F.col(quoted(time)).cast("timestamp")
    own = dict(stream.dtypes)[time]
    rows = rows.select(at.alias("__at"), *(F.col(quoted(c)) for c in stream.columns)).withWatermark("__at", late)
    if once_by:
        rows = rows.dropDuplicatesWithinWatermark(list(once_by)) if stream.isStreaming else rows.dropDuplicates(list(once_by))
    known = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    aggregates = [F.count(F.lit(1)).alias("n"), *(known[how](F.expr(x)).alias(name) for name, (how, x) in (values or {}).items())]
    grouped = rows.groupBy(F.window("__at", width, *([slide] if slide else [])).alias("__window"), *(F.col(quoted(k)) for k in keys)).agg(*aggregates)
    edge = lambda c: F.col(f"__window.{c}").cast(own).alias(f"window_{c}")
    return grouped.select(edge("start"), edge("end"), *(F.col(quoted(k)) for k in keys), "n", *(values or {}))


def write_updates(counts: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Starts the query: each batch writes the windows that it changed under ``path``, in a folder of its own.

    A batch that is run again after a failure or restart writes its folder anew, and Spark gives it the same rows of the
    source and the same state by the checkpoint: what :func:`current` reads has each input row once. Without a trigger all
    that is there is read, then the query ends.
    """

    spark = counts.sparkSession
    spark.createDataFrame([], counts.schema).write.mode("overwrite").parquet(f"{path}/{BATCH}=-1")  # a source without files runs no batch

    def put(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")

    return counts.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def current(spark: SparkSession, path: str, like: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The windows as the last batch that changed each left them; ``like`` has the columns (no rows are read from it)."""
    by = ["window_start", "window_end", *keys]
    rest = [c for c in like.columns if c not in by]
    kind = T.StructType([*like.schema.fields, T.StructField(BATCH, T.LongType())])  # add() would change like's own
    rows = spark.read.schema(kind).option("basePath", path).parquet(path)
    last = rows.groupBy(*map(quoted, by)).agg(F.max_by(F.struct(*map(quoted, rest)), BATCH).alias("__last"))
    return last.select(*(F.col(f"__last.{quoted(c)}").alias(c) if c in rest else F.col(quoted(c)) for c in like.columns))


def late_rows(query: StreamingQuery) -> int:
    """How many rows the query's last batches have dropped as too late."""
    return sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
