"""As-of joins: sides merged in order within range partitions, with what is open at their borders carried over."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brindle.operators.ticks import length, ticks
from brindle.sources.shared import quoted, written

#: What a row of the merged table is.
CLOSED, OPEN, BORDER = 0, 1, 2


def asof_join(
    left: DataFrame, right: DataFrame, by: Sequence[str], time: str, right_time: str | None = None, *, strict: bool = True, differ: str | None = None,
    tolerance: timedelta | int | None = None, order: Sequence[str] = (), prefix: str = "right_", partitions: int | None = None,
) -> DataFrame:
    """Each row of left once, with the columns of the latest row of right (behind ``prefix``) that has the same ``by``
    and an earlier time, or with ``strict=False`` no later one; nulls where there is none.

    ``order`` names columns of right that tell which of its rows of one time is the latest. With ``differ``, a column of
    both sides, the latest row in which it has another value is taken; null differs from nothing. A row farther back
    than ``tolerance`` (of the time's own unit if whole) doesn't count. Rows with a null time or key match nothing.
    Keys are atomic and not floating.

    Both sides are dealt out once, by ranges of key and time, so that a frequent key or instant is spread over as many
    partitions as it fills; no pairs are formed. Within a partition one pass keeps the last row of right (with
    ``differ``, and the last one with another value before it). What the first key of a partition needs from those
    before it comes from their last keys' rows, two a partition, in one small pass. Only the rows that are still open
    are joined with these.
    """
    right_time = right_time or time
    if clash := {c.lower() for c in left.columns} & {(prefix + c).lower() for c in right.columns}:
        raise ValueError(f"both sides would have: {', '.join(sorted(clash))}")
    for side in (left, right):
        for b in by:
            kind = side.schema[b].dataType
            if isinstance(kind, (T.FractionalType, T.ArrayType, T.MapType, T.StructType, T.VariantType)) and not isinstance(kind, T.DecimalType):
                raise TypeError(f"key {b} is {kind.simpleString()}")
    l_kind, r_kind = left.schema.simpleString(), right.schema.simpleString()
    keys = [f"b{i}" for i in range(len(by))]
    whole = lambda df: F.struct(*(F.col(quoted(c)) for c in df.columns))
    x = lambda df: (F.col(quoted(differ)) if differ else F.lit(0)).alias("x")
    ties = [f"o{i}" for i in range(len(order))]

    def side(df: DataFrame, at: str, number: int, own: str) -> DataFrame:
        rows = df.filter(known(df, [*by, at]))
        if own == "r" and differ:
            rows = rows.filter(F.col(quoted(differ)).isNotNull())
        out = [F.col(quoted(b)).alias(k) for b, k in zip(by, keys, strict=True)]
        ordering = [(F.col(quoted(o)) if own == "r" else F.lit(None).cast(right.schema[o].dataType)).alias(k) for o, k in zip(order, ties, strict=True)]
        return rows.select(*out, ticks(df, at).alias("t"), F.lit(number).alias("side"), *ordering, spread(df).alias("tie"), x(df), *(whole(df) if own == c else F.lit(None).cast(k) for c, k in (("l", l_kind), ("r", r_kind))))

    # at one time, left goes first where only an earlier row of right counts
    l, r = (0, 1) if strict else (1, 0)
    both = side(left, time, l, "l").union(side(right, right_time, r, "r")).toDF(*keys, "t", "side", *ties, "tie", "x", "l", "r")
    sort = [*keys, "t", "side", *(F.col(o).asc_nulls_first() for o in ties), "tie"]
    ranged = both.repartitionByRange(*([partitions] if partitions else []), *sort).sortWithinPartitions(*sort)
    ranged = ranged.select(F.spark_partition_id().alias("slice"), *keys, "side", "x", "l", "r")
    kind = T.StructType([T.StructField("kind", T.ByteType()), T.StructField("slice", T.IntegerType()), *(T.StructField(f"{p}{i}", ranged.schema[k].dataType) for p in ("first", "last") for i, k in enumerate(keys)), *(T.StructField(n, ranged.schema[k].dataType) for n, k in (("x", "x"), ("l", "l"), ("r", "r"), ("r_other", "r"), ("x_r", "x"), ("x_other", "x")))])
    found = written(ranged.mapInArrow(lambda batches: merged(batches, keys, r, bool(differ)), kind), "asof")
    carried = found.filter(F.col("kind") == BORDER).repartition(1).sortWithinPartitions("slice").mapInArrow(lambda batches: carries(batches, len(keys)), carry_kind(kind))
    # an open row: what is carried, unless its value differs from that alone in what stands before it
    open_ = found.filter(F.col("kind") == OPEN).drop("r", "r_other", "x_r", "x_other").join(carried, "slice", "left")
    taken = F.when(F.col("x") != F.col("x_r"), F.col("r")).otherwise(F.col("r_other")) if differ else F.col("r")
    none = left.filter(~known(left, [*by, time])).select(whole(left).alias("l"), F.lit(None).cast(r_kind).alias("r"))
    out = found.filter(F.col("kind") == CLOSED).select("l", "r").union(open_.select("l", taken)).union(none)
    if tolerance is not None:
        out = out.withColumns({"a": F.col(f"l.{quoted(time)}"), "b": F.col(f"r.{quoted(right_time)}")})
        out = out.withColumn("r", F.when(ticks(out, "a") - ticks(out, "b") <= length(left, time, tolerance), F.col("r")))
    return out.select(*(F.col(f"l.{quoted(c)}").alias(c) for c in left.columns), *(F.col(f"r.{quoted(c)}").alias(prefix + c) for c in right.columns))


def known(df: DataFrame, columns: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out &= F.col(quoted(c)).isNotNull()
    return out


def spread(df: DataFrame) -> Column:
    """A hash of a row, by which rows of one key and time are told apart when they are dealt out."""
    plain = [F.col(quoted(f.name)) for f in df.schema.fields if not has_map(f.dataType)]
    return F.xxhash64(*plain) if plain else F.lit(0).cast("long")


def has_map(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return True
    if isinstance(kind, T.ArrayType):
        return has_map(kind.elementType)
    return isinstance(kind, T.StructType) and any(has_map(f.dataType) for f in kind.fields)


def changes(columns: list[pa.Array]) -> np.ndarray:
    """Where a row's values aren't those of the row before; the first row is a change."""
    n = len(columns[0])
    out = np.zeros(n, bool)
    out[:1] = True
    for c in columns:
        out[1:] |= ~np.asarray(pc.equal(c.slice(1), c.slice(0, n - 1)).to_numpy(zero_copy_only=False), bool)
    return out


def latest(start: np.ndarray, right: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row, the place of the last row of right up to it under its key, and of the last one before that with
    another x; -1 where there is none. ``start`` is the place at which each row's key begins.
    """
    n = len(start)
    last = np.maximum.accumulate(np.where(right, np.arange(n), -1)) if n else np.zeros(0, int)
    last = np.where(last >= start, last, -1)
    at = np.flatnonzero(right)
    new = np.ones(len(at), bool)
    new[1:] = (x[at[1:]] != x[at[:-1]]) | (start[at[1:]] != start[at[:-1]])
    before = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0)) - 1 if len(at) else np.zeros(0, int)
    other = np.full(n + 1, -1)  # the last place stands for none
    if len(at):
        found = np.where(before >= 0, at[before], -1)
        other[at] = np.where((found >= 0) & (start[found] == start[at]), found, -1)
    return last, other[last]


def column(b: pa.RecordBatch, name: str) -> pa.Array:
    return b.column(b.schema.get_field_index(name))


def picked(values: pa.Array, at: np.ndarray) -> pa.Array:
    return values.take(pa.array(at, pa.int64(), mask=at < 0))


def merged(batches: Iterator[pa.RecordBatch], keys: list[str], r_side: int, differ: bool) -> Iterator[pa.RecordBatch]:
    """The rows of left, each with what the rows before it in this partition give, and a row that tells the partition's
    first and last key and the last rows of right under the latter.
    """
    names = ["kind", "slice", *(f"{p}{i}" for p in ("first", "last") for i in range(len(keys))), "x", "l", "r", "r_other", "x_r", "x_other"]
    held, first, in_first = None, None, True

    def sent(kind: int, b: pa.RecordBatch, at: np.ndarray, left: np.ndarray, r: np.ndarray, other: np.ndarray, firsts: list[pa.Scalar]) -> pa.RecordBatch:
        n, at = len(at), pa.array(at)
        many = lambda s: pa.array([s.as_py()] * n, s.type)
        x = column(b, "x")
        cols = [pa.array(np.full(n, kind, np.int8)), column(b, "slice").take(at), *map(many, firsts), *(column(b, k).take(at) for k in keys), x.take(at), picked(column(b, "l"), left), picked(column(b, "r"), r), picked(column(b, "r"), other), picked(x, r), picked(x, other)]
        return pa.RecordBatch.from_arrays(cols, names=names)

    for new in batches:
        if not new.num_rows:
            continue
        old = held.num_rows if held is not None else 0
        b = pa.concat_batches([held, new]) if old else new
        if first is None:
            first = [column(b, k)[0] for k in keys]
        n = b.num_rows
        change = changes([column(b, k) for k in keys] or [pa.array(np.zeros(n, np.int8))])
        start = np.maximum.accumulate(np.where(change, np.arange(n), 0))
        right = np.asarray(column(b, "side")) == r_side
        coded = column(b, "x").dictionary_encode().indices
        x = np.asarray(coded.fill_null(-1))
        r, other = latest(start, right, x)
        # with a value of its own (not null) a row takes the last row with another one
        take = np.where((r >= 0) & (x == x[r]), other, r) if differ else r
        take = np.where(x < 0, -1, take)
        lefts = np.flatnonzero(~right)
        lefts = lefts[lefts >= old]
        is_open = (take[lefts] < 0) & (start[lefts] == 0) & in_first & (x[lefts] >= 0)
        for kind, at in ((CLOSED, lefts[~is_open]), (OPEN, lefts[is_open])):
            if len(at):
                yield sent(kind, b, at, at, take[at], np.full(len(at), -1), first)
        in_first &= not start[-1] > 0
        # of the last key, what later rows may need, or one row that tells the key
        keep = [i for i in (other[-1], r[-1]) if i >= 0]
        held = b.take(pa.array(keep or [n - 1]))
    if held is not None:
        end, right = held.num_rows - 1, np.asarray(column(held, "side")) == r_side
        r = end if right[end] else -1
        yield sent(BORDER, held, np.array([end]), np.array([-1]), np.array([r]), np.array([end - 1 if r > 0 else -1]), first)


def carry_kind(kind: T.StructType) -> T.StructType:
    return T.StructType([f for f in kind.fields if f.name in ("slice", "r", "r_other", "x_r", "x_other")])


def carries(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    """For each partition whose first key was the last one before it, the last rows of right under that key."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    b = pa.concat_batches(tables)
    n = b.num_rows
    rows = pa.concat_arrays([column(b, "r"), column(b, "r_other")])
    xs = pa.concat_arrays([column(b, "x_r"), column(b, "x_other")])
    key = lambda p, i: tuple(column(b, f"{p}{k}")[i].as_py() for k in range(n_keys))
    x, there = xs.to_pylist(), np.asarray(rows.is_valid())
    of, pair, out = None, (-1, -1), []
    for i in range(n):
        if of is not None and of == key("first", i):
            out.append((i, *pair))
        last = key("last", i)
        if last != of or key("first", i) != last:
            of, pair = last, (-1, -1)
        for new in (n + i, i):  # the other row comes first
            if there[new]:
                pair = (new, pair[1]) if pair[0] >= 0 and x[new] == x[pair[0]] else (new, pair[0])
    if out:
        at, r, other = (np.array(c) for c in zip(*out, strict=True))
        yield pa.RecordBatch.from_arrays([column(b, "slice").take(pa.array(at)), picked(rows, r), picked(rows, other), picked(xs, r), picked(xs, other)], names=["slice", "r", "r_other", "x_r", "x_other"])
