"""Windowed counts of a stream: restarts, late rows, repeated rows, and equality with the batch."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from brindle.streaming import current, late_rows, windowed_counts, write_updates
from brindle.streaming import windows

SF = "/root/testdata/sf0.01"
VALUES = {"cents": ("sum", "cast(round(value * 100) as bigint)"), "most": ("max", "value")}


def drop(df, folder, name):
    """One file of df, put into the folder whole."""
    df.coalesce(1).write.parquet(f"{folder}-{name}")
    folder.mkdir(exist_ok=True)
    for f in folder.parent.glob(f"{folder.name}-{name}/part-*"):
        f.rename(folder / f"{name}.parquet")


def opened(spark, folder, schema, **options):
    return spark.readStream.schema(schema).options(**options).parquet(str(folder))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("slide,kind", [(None, "timestamp_ntz"), ("2 hours", "timestamp")])
def test_a_restart_in_the_middle_equals_the_batch(spark, tmp_path, slide, kind):
    """Half of the files, a new query with the same checkpoint, the other half; a file a batch."""
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast(kind))
    count = lambda df: windowed_counts(df, "ts", "6 hours", ["event_type"], VALUES, slide=slide, late="1 hour")
    folder, out = tmp_path / "in", str(tmp_path / "out")
    seen = 0
    for half in (range(3), range(3, 6)):
        for i in half:
            drop(events.filter(F.col("event_id").between(i * 1700, i * 1700 + 1699)), folder, f"f{i}")
        counts = count(opened(spark, folder, events.schema, maxFilesPerTrigger=1))
        query = write_updates(counts, out, f"{out}-checkpoint")
        query.awaitTermination()
        got = [p.numInputRows for p in query.recentProgress if p.numInputRows]
        assert len(got) == 3 and late_rows(query) == 0
        seen += sum(got)
        assert rows(current(spark, out, counts, ["event_type"])) == rows(count(events.filter(F.col("event_id") < (half[-1] + 1) * 1700)))
    assert seen == events.count()


def test_a_batch_that_fails_after_writing_is_written_anew(spark, tmp_path, monkeypatch):
    events = spark.read.parquet(f"{SF}/events.parquet").limit(900)
    folder, out = tmp_path / "in", str(tmp_path / "out")
    for i in range(3):
        drop(events.filter(f"event_id % 3 = {i}"), folder, f"f{i}")
    counts = windowed_counts(opened(spark, folder, events.schema, maxFilesPerTrigger=1), "ts", "1 hour", late="30 days")
    kind, broken = type(spark.range(1)), [True]
    real = kind.writeStream.fget(counts).foreachBatch.__func__

    def breaking(self, f):
        def put(df, batch):
            f(df, batch)
            if batch == 1 and broken:
                broken.clear()
                raise RuntimeError("lost before the batch was committed")

        return real(self, put)

    monkeypatch.setattr(type(kind.writeStream.fget(counts)), "foreachBatch", breaking)
    with pytest.raises(StreamingQueryException):
        write_updates(counts, out, f"{out}-checkpoint").awaitTermination()
    write_updates(counts, out, f"{out}-checkpoint").awaitTermination()
    assert rows(current(spark, out, counts)) == rows(windowed_counts(events, "ts", "1 hour"))


def test_late_and_repeated_rows(spark, tmp_path):
    """What comes within the bound counts, later rows don't and are told; ids count once; nulls have their place."""
    at = datetime(2024, 5, 1, 12)
    kind = "id long, ts timestamp, k string"
    folder, out = tmp_path / "in", str(tmp_path / "out")
    batches = [
        [(1, at, "a"), (1, at, "a"), (2, at + timedelta(minutes=59), "a"), (3, None, "a"), (4, at, None)],
        [(1, at, "a"), (5, at + timedelta(hours=3), "a")],
        [(6, at + timedelta(hours=2, minutes=10), "a"), (7, at - timedelta(hours=5), "late"), (8, at, "late")],
        [],
    ]
    for i, b in enumerate(batches):
        drop(spark.createDataFrame(b, kind), folder, f"f{i}")
        counts = windowed_counts(opened(spark, folder, spark.createDataFrame([], kind).schema), "ts", "1 hour", ["k"], late="1 hour", once_by=["id"])
        query = write_updates(counts, out, f"{out}-checkpoint")
        query.awaitTermination()
        if i == 2:
            assert late_rows(query) == 2
    got = [(r.window_start.hour, r.k, r.n) for r in current(spark, out, counts, ["k"]).collect()]
    assert sorted(got, key=repr) == [(12, "a", 2), (12, None, 1), (14, "a", 1), (15, "a", 1)]


def test_batch_counts(spark):
    kind = "id long, ts timestamp, k string"
    assert windowed_counts(spark.createDataFrame([], kind), "ts", "1 hour").count() == 0
    one = spark.createDataFrame([(1, datetime(1969, 12, 31, 23, 59), "x"), (1, datetime(1969, 12, 31, 23, 59), "x")], kind)
    assert [(r.window_end, r.n) for r in windowed_counts(one, "ts", "1 hour", once_by=["id"]).collect()] == [(datetime(1970, 1, 1), 1)]
    assert windows.BATCH not in windowed_counts(one, "ts", "1 hour").columns
