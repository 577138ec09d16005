"""Nearest neighbours by a block matrix join: int8 tiles with error bounds, exact scores of what survives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import column, written

#: Vectors of a block of candidates and of queries.
ROWS, QUERIES = 4096, 1024
#: Blocks of queries and of candidates that meet under one key, of which there are as many as that leaves.
Q_BLOCKS, C_BLOCKS = 4, 16
#: Surviving pairs that a task holds before it leaves out those that others have overtaken, and sends the rest.
HEAPS = 1_000_000


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, the vector as it is and as doubles (v), and a hash of it, of rows that can take part."""
    v = vectors.select("vec_id", "embedding", F.col("embedding").cast("array<double>").alias("v"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    v = v.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine) & F.exists("v", lambda x: x != 0))
    return v.withColumn("h", F.xxhash64("v"))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as int8 steps, the step of each, and a bound on each one's error in length."""
    step = np.abs(x).max(1) / 127
    q = np.rint(x / step[:, None]).astype(np.int8)
    # the true error, and room for the rounding of the sums below
    return q, step, np.linalg.norm(x - q * step[:, None], axis=1) + 1e-6


def blocks(vectors: DataFrame, rows: int, name: str, copies: int | None = None) -> DataFrame:
    """Blocks of at most so many vectors of one width, each made int8 once: ids, hashes, steps and errors beside them.
    Of equal vectors in a block, only those with the ``copies`` smallest ids are kept: all score alike, so the others
    come behind them for any query.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            for i, v, h in zip(column(b, "vec_id").to_pylist(), column(b, "v"), column(b, "h").to_pylist(), strict=True):
                x = np.asarray(v.values)
                mine = held.setdefault(len(x), [])
                mine.append((i, h, x))
                if len(mine) == rows:
                    yield packed(held.pop(len(x)))
                elif len(held) > 64:  # many widths: none is kept waiting
                    yield from map(packed, held.values())
                    held = {}
        yield from map(packed, held.values())

    def packed(mine: list) -> pa.RecordBatch:
        if copies:
            same: dict[bytes, dict] = {}
            for row in mine:
                same.setdefault(row[2].tobytes(), {})[row[0]] = row
            mine = [row for some in same.values() for _, row in sorted(some.items())[:copies]]
        ids, hashes, x = zip(*mine, strict=True)
        x = np.stack(x)
        unit = x / np.abs(x).max(1)[:, None]
        q, step, error = quantised(unit / np.linalg.norm(unit, axis=1)[:, None])
        who, bounds = np.array([ids, hashes], np.int64), np.array([step, error])
        return pa.RecordBatch.from_pydict({name: [q.tobytes()], f"{name}_who": [who.tobytes()], f"{name}_bounds": [bounds.tobytes()], "width": pa.array([x.shape[1]], pa.int32())})

    return vectors.mapInArrow(run, f"{name} binary, {name}_who binary, {name}_bounds binary, width int")


def best_lows(query: np.ndarray, ids: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The queries, ascending, and of each the k-th largest lower bound over different ids; -inf where there are fewer."""
    order = np.lexsort((-low, ids, query))
    query, ids, low = query[order], ids[order], low[order]
    first = np.ones(len(query), bool)  # the best of each id
    first[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
    query, low = query[first], low[first]
    order = np.lexsort((-low, query))
    query, low = query[order], low[order]
    start = np.flatnonzero(np.diff(query, prepend=query[:1] - 1)) if len(query) else np.zeros(0, int)
    size = np.diff(np.append(start, len(query)))
    return query[start], np.where(size >= k, low[np.minimum(start + k - 1, len(low) - 1)], -np.inf)


def tile(q: np.ndarray, qi: np.ndarray, qb: np.ndarray, c: np.ndarray, ci: np.ndarray, cb: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns of the pairs that may be among a query's k nearest, their bounds, and each query's new floor.

    |u.v - u'.v'| <= |u - u'| + |v - v'| * |u'| for unit u, v and their int8 forms u', v': a pair whose product
    plus that bound is below the k-th largest product minus its bound, of as many different ids, can't be among the
    nearest; nor can one below such a floor from other blocks. Ties stay, as the smaller id goes first.
    """
    # whole numbers below 2 ** 24 while the width is below 1040: float32 sums them exactly; wider ones in double
    kind = np.float32 if q.shape[1] < 1040 else np.float64
    near = (q.astype(kind) @ c.astype(kind).T) * (qb[0][:, None] * cb[0][None, :])
    bound = qb[1][:, None] + cb[1][None, :] * (1 + qb[1][:, None]) + 1e-6
    own = qi[:, None] == ci[None, :]
    low, high = np.where(own, -np.inf, near - bound), np.where(own, -np.inf, near + bound)
    order = np.argsort(ci, kind="stable")
    first = np.flatnonzero(np.diff(ci[order], prepend=ci[order[:1]] - 1))
    best = np.maximum.reduceat(low[:, order], first, axis=1) if len(first) < len(ci) else low  # of each id
    if best.shape[1] >= k:
        floor = np.maximum(floor, np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k])
    r, j = np.nonzero((high >= floor[:, None]) & ~own)
    return r, j, low[r, j], high[r, j], floor


def survivors(pairs: DataFrame, k: int) -> DataFrame:
    """query_id, query_h, vec_id, vec_h and bounds low and high of the cosine of the pairs that no task rules out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floors: dict[bytes, np.ndarray] = {}
        held: list[np.ndarray] = []  # rows of query, its hash, id, its hash; low and high as the bits of doubles
        size = 0
        load = lambda x, kind, n: np.frombuffer(x.as_py(), kind).reshape(n, -1)
        for b in batches:
            for q, qw, qb, c, cw, cb in zip(*(column(b, x) for x in ("q", "q_who", "q_bounds", "c", "c_who", "c_bounds")), strict=True):
                key, qw, cw = qw.as_py(), load(qw, np.int64, 2), load(cw, np.int64, 2)
                n, m = qw.shape[1], cw.shape[1]
                r, j, low, high, floors[key] = tile(load(q, np.int8, n), qw[0], load(qb, np.float64, 2), load(c, np.int8, m), cw[0], load(cb, np.float64, 2), floors.get(key, np.full(n, -np.inf)), k)
                held.append(np.stack([qw[0][r], qw[1][r], cw[0][j], cw[1][j], low.view(np.int64), high.view(np.int64)]))
                size += len(r)
                if size > HEAPS:
                    yield sent(held)
                    held, size, floors = [], 0, {}
        if size:
            yield sent(held)

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(held, axis=1)
        low, high = (np.ascontiguousarray(rows[i]).view(np.float64) for i in (4, 5))
        _, query = np.unique(rows[:2], axis=1, return_inverse=True)
        query = query.ravel()
        _, floor = best_lows(query, rows[2], low, k)
        order = np.lexsort((rows[2], rows[3], query))  # of equal vectors, the k smallest ids for each query
        new = np.ones(len(order), bool)
        new[1:] = (query[order][1:] != query[order][:-1]) | (rows[3][order][1:] != rows[3][order][:-1])
        start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        stay = np.empty(len(order), bool)
        stay[order] = np.arange(len(order)) - start < k
        stay &= high >= floor[query]
        return pa.RecordBatch.from_arrays([*(pa.array(x[stay]) for x in rows[:4]), pa.array(low[stay]), pa.array(high[stay])], names=["query_id", "query_h", "vec_id", "vec_h", "low", "high"])

    return pairs.mapInArrow(run, "query_id long, query_h long, vec_id long, vec_h long, low double, high double")


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, from the vectors as they are; components are summed one after another."""
    a, b = (x / np.abs(x).max(1)[:, None] for x in (a, b))
    total = lambda x: np.cumsum(x, axis=1)[:, -1]
    return total(a * b) / np.sqrt(total(a * a) * total(b * b))


def exact(pairs: DataFrame) -> DataFrame:
    """query_id, vec_id and score of pairs with both vectors (u and v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, v = column(b, "u"), column(b, "v")
            size, score = np.diff(np.asarray(u.offsets)), np.zeros(b.num_rows)
            for w in np.unique(size).tolist():
                at = pa.array(np.flatnonzero(size == w))
                score[np.asarray(at)] = cosine(*(np.asarray(x.take(at).flatten()).reshape(-1, w) for x in (u, v)))
            yield pa.RecordBatch.from_arrays([column(b, "query_id"), column(b, "vec_id"), pa.array(score)], names=["query_id", "vec_id", "score"])

    return pairs.select("query_id", "vec_id", "u", "v").mapInArrow(run, "query_id long, vec_id long, score double")


def fetched(pairs: DataFrame, vectors: DataFrame, who: str, h: str, name: str) -> DataFrame:
    """pairs with the vectors that they name, equal rows once; only those are looked for among all."""
    wanted = written(pairs.select(who, h).distinct(), "nearest-wanted")
    own = usable(vectors).select(F.col("vec_id").alias(who), F.col("h").alias(h), F.col("embedding").alias(name))
    own = written(own.join(wanted, [who, h], "left_semi").dropDuplicates([who, h]), "nearest-fetched")
    return pairs.join(own.withColumn(name, F.col(name).cast("array<double>")), [who, h])


def grid(queries: int, vectors: int) -> tuple[int, int]:
    """Into how many groups the blocks of queries and of candidates are dealt: one key for each two of them."""
    return max(1, -(-queries // (QUERIES * Q_BLOCKS))), max(1, -(-vectors // (ROWS * C_BLOCKS)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k nearest vectors by cosine, other than its own id.

    Blocks of int8 vectors are made once; each block of queries meets each block of candidates in a tile, under a key of
    their two groups. Groups grow with the blocks, so the keys do too, whatever the size. A task keeps the pairs that its
    tiles' bounds don't rule out. Over all tasks the k-th largest lower bound of a query rules out most of the others;
    the vectors of what is left are fetched, their scores are taken anew in double precision, and ranked. All pairs are
    judged: recall is 1. Vectors that are null, empty, zero or hold null or non-finite components, and those with a null
    id, take no part; vectors of another width don't meet. A query with fewer candidates gets all. Rows of one id count
    once, with the best score. Further columns are passed over.
    """
    c, q = usable(vectors), usable(queries)
    n_q, n_c = grid(queries.count(), vectors.count())
    deal = lambda df, name, n: df.withColumn(f"{name}_group", F.pmod(F.xxhash64(f"{name}_who"), F.lit(n)))
    every = lambda name, n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)
    # one copy more, as a query's own row doesn't count
    c = deal(blocks(c, ROWS, "c", k + 1), "c", n_c).select("*", every("q_group", n_q))
    # queries may be few in each of many partitions, and would make a block in each
    q = q.repartition(max(1, n_q * Q_BLOCKS // 4), "vec_id", "h")
    q = deal(blocks(q, QUERIES, "q"), "q", n_q).select("*", every("c_group", n_c))
    found = written(survivors(c.join(q, ["q_group", "c_group", "width"]), k), "nearest-pairs")
    lows = found.groupBy("query_id", "vec_id").agg(F.max("low").alias("low"))
    lows = lows.withColumn("place", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("low")))).filter(F.col("place") <= k)
    floor = lows.groupBy("query_id").agg(F.when(F.count("low") == k, F.min("low")).alias("floor"))
    left = found.join(floor, "query_id").filter(F.col("floor").isNull() | (F.col("high") >= F.col("floor"))).select("query_id", "query_h", "vec_id", "vec_h").distinct()
    left = written(left, "nearest-left")  # a written table tells its size: where few vectors are wanted, none is shuffled
    left = fetched(fetched(left, queries, "query_id", "query_h", "u"), vectors, "vec_id", "vec_h", "v")
    best = exact(left).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_nearest(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
