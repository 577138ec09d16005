"""Quality scores: random Fourier features of document statistics, ridge by normal equations, isotonic calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import column, written

FEATURES = 256
RIDGE = 1e-3
SEED = 7
#: At most about so many labelled rows train; chosen by a hash of their id.
MAX_TRAIN = 200_000
#: Partitions of the training rows, each of which sends one matrix of FEATURES by FEATURES to the driver.
TRAIN_PARTS = 8
#: One training row in so many calibrates instead of fitting.
CALIBRATE = 4
BINS = 200
SYMBOLS = b"#%&$*!|<>{}[]=_~^\\/"


def statistics(text: str | None) -> np.ndarray:
    """Sizes, shares of kinds of bytes, and repetition of a text's words and lines."""
    text = text or ""
    raw = np.frombuffer(text.encode(), np.uint8)
    n, words, lines = max(len(raw), 1), text.split(), text.split("\n")
    by = np.bincount(raw, minlength=256) / n
    w = max(len(words), 1)
    return np.array([
        np.log1p(len(raw)), np.log1p(len(words)), len(raw) / w, len(set(words)) / w, sum(map(eq, words, words[1:])) / w,
        len(set(lines)) / len(lines), len(lines) / w, by[48:58].sum(), by[65:91].sum(), by[97:123].sum(), by[128:].sum(), by[32], by[46], by[44],
        *(by[c] for c in SYMBOLS[:7]), by[list(SYMBOLS)].sum(), sum(len(set(words[a : a + 200])) for a in range(0, len(words), 200)) / w, sum(x[0].isupper() for x in words) / w,
    ], np.float64)


def features_of(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns of keep and each text's statistics, as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [statistics(t.as_py()) for t in column(b, "text")]
            flat = np.concatenate(rows) if rows else np.zeros(0)
            width = len(rows[0]) if rows else 1
            x = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * width), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*(column(b, k) for k in keep), x], names=[*keep, "x"])

    kinds = dict(docs.dtypes)
    return written(docs.select(*keep, "text").mapInArrow(run, ", ".join([*(f"{k} {kinds[k]}" for k in keep), "x array<double>"])), "quality-features")


def matrix(b: pa.RecordBatch) -> np.ndarray:
    x = column(b, "x")
    return np.asarray(x.flatten()).reshape(len(x), -1)


def summed(df: DataFrame, f: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray | None:
    """The sum of f over all batches: summed in each partition, the partitions' sums on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                got = f(b)
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_pydict({"s": [total.tobytes()]})

    parts = [np.frombuffer(r.s) for r in df.mapInArrow(run, "s binary").collect()]
    return sum(parts) if parts else None


def pool_adjacent(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The non-decreasing values nearest to y by weighted least squares."""
    blocks: list[list[float]] = []
    for v, w in zip(y, weight, strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2] + b[2]])
    return np.concatenate([np.full(int(k), v) for v, _, k in blocks])


class Model:
    """Standardised statistics, their Fourier features, ridge weights and the calibration's steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)
        self.beta = np.zeros(FEATURES + len(mean) + 1)
        self.steps = (np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.cos(z @ self.w + self.b) * np.sqrt(2 / FEATURES), z, np.ones((len(z), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.beta

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), *self.steps), 0, 1)


def fit(train: DataFrame) -> Model | float:
    """A model from rows (x, y, calibrate); the base rate alone where the labels are all alike or none."""
    sums = summed(train, lambda b: np.concatenate([[b.num_rows, np.asarray(column(b, "y")).sum()], (x := matrix(b)).sum(0), (x * x).sum(0)]))
    if sums is None:
        return 0.5
    n, ones, d = sums[0], sums[1], (len(sums) - 2) // 2
    if ones in (0, n):
        return float(ones / n)
    mean = sums[2 : 2 + d] / n
    model = Model(mean, np.sqrt(np.maximum(sums[2 + d :] / n - mean**2, 1e-12)) + 1e-9)

    def equations(b: pa.RecordBatch) -> np.ndarray:
        z = model.expand(matrix(b))[~(c := np.asarray(column(b, "calibrate").to_numpy(zero_copy_only=False), bool))]
        return np.concatenate([(z.T @ z).ravel(), z.T @ np.asarray(column(b, "y"), np.float64)[~c]])

    e, k = summed(train, equations), len(model.beta)
    gram = e[: k * k].reshape(k, k)
    model.beta = np.linalg.solve(gram + RIDGE * n * np.eye(k) / k, e[k * k :])

    def histogram(b: pa.RecordBatch) -> np.ndarray:
        c = np.asarray(column(b, "calibrate").to_numpy(zero_copy_only=False), bool)
        at = np.clip((model.raw(matrix(b)[c]) + 0.5) / 2 * BINS, 0, BINS - 1).astype(int)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, np.asarray(column(b, "y"), np.float64)[c], BINS)])

    h = summed(train, histogram)
    count, one = h[:BINS], h[BINS:]
    seen = count > 0
    if seen.any():
        centre = (np.arange(BINS) + 0.5) / BINS * 2 - 0.5
        model.steps = (centre[seen], pool_adjacent(one[seen] / count[seen], count[seen]))
    return model


def sampled(rows: DataFrame, most: int) -> DataFrame:
    """All rows, or about so many by a hash of doc_id."""
    n = rows.count()
    return rows if n <= most else rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(1_000_000)) < int(1e6 * most / n))


def held_out(mod: int, rest: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, mod: int = 4, rest: int = 2) -> DataFrame:
    """doc_id, text_hash, held_out, score and predicted of each document.

    Only labels outside the held-out remainder are learnt from, at most about MAX_TRAIN of them; a document with
    several labels counts with each, null labels not at all. The score is a function of the text's statistics
    alone; null and empty texts get that of no words. With labels all alike the score is their rate, without any
    0.5. Repeated rows are scored each; an empty table gives no rows. Further columns are passed over.
    """
    x = features_of(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text"), ["doc_id", "text_hash"])
    known = sampled(labels.filter(F.col("quality").isNotNull() & ~held_out(mod, rest)).select("doc_id", F.col("quality").cast("double").alias("y")), MAX_TRAIN)
    calibrate = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(CALIBRATE)) == 0
    train = written(known.join(x, "doc_id").select("x", "y", calibrate.alias("calibrate")).repartition(TRAIN_PARTS), "quality-train")
    model = fit(train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                s = np.full(b.num_rows, model) if isinstance(model, float) else model.score(matrix(b))
                yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "text_hash"), pa.array(s)], names=["doc_id", "text_hash", "score"])

    kind = dict(x.dtypes)["doc_id"]
    out = x.mapInArrow(run, f"doc_id {kind}, text_hash long, score double")
    return out.select("doc_id", "text_hash", held_out(mod, rest).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op8_quality(spark, sf_dir: str) -> DataFrame:
    out = classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.drop("text_hash")
