"""Vector codes: product quantisation in whole numbers, whose nearest entries are found in GNATs."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import column, table, unused, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Split points of a node of a tree; a set of at most so many entries is a leaf.
SPLITS, LEAF = 8, 4
#: Vectors that are assigned at once.
SLICE = 4096
#: Squared distances of a vector stay below this.
MAX_ERROR = 1 << 62
#: Sums of at most so many labels are broadcast (a label and a number each); more are joined by label and salt.
MAX_LABELS, SALT = 100_000, 64
#: A distance is taken so much smaller or larger than its rounded root, so that no rounding eliminates an entry.
SLACK = 2.0**-48


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of each row to each entry, in whole numbers."""
    out = np.zeros((len(x), len(entries)), np.int64)
    for i in range(x.shape[1]):
        d = x[:, i, None] - entries[None, :, i]
        out += d * d
    return out


def low(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 - SLACK)


def high(d2: np.ndarray) -> np.ndarray:
    return np.sqrt(d2.astype(np.float64)) * (1 + SLACK)


class Gnat:
    """A node: split points, the range of the distances from each of them to each child's entries, and the children.

    Splits are the first entry, then always the one farthest from those chosen; each other entry belongs to the child
    of its nearest split. A query farther from (or nearer to) a split than a child's range and the distance to the
    best entry so far allow, can't have its nearest entry in that child: the whole subtree is passed over. Only
    strictly farther subtrees are, and distances are rounded away from that, so that equal entries stay: these are
    told apart by whole squared distances and, where these are equal, by their index.
    """

    def __init__(self, entries: np.ndarray, index: np.ndarray) -> None:
        self.splits = self.at = None
        self.children: list[Gnat | None] = []
        if len(index) <= LEAF:
            self.splits, self.at = entries[index], index
            return
        chosen = [0]
        between = squared(entries[index], entries[index])
        while len(chosen) < SPLITS and len(chosen) < len(index):
            d = between[:, chosen].min(1)
            d[chosen] = -1
            chosen.append(int(d.argmax()))
        self.at, self.splits = index[chosen], entries[index[chosen]]
        rest = np.setdiff1d(np.arange(len(index)), chosen)
        owner = between[np.ix_(rest, chosen)].argmin(1)
        self.least, self.most = np.full((len(chosen), len(chosen)), np.inf), np.zeros((len(chosen), len(chosen)))
        for j in range(len(chosen)):
            mine = rest[owner == j]
            self.children.append(Gnat(entries, index[mine]) if len(mine) else None)
            if len(mine):
                d = between[np.ix_(chosen, mine)]
                self.least[:, j], self.most[:, j] = low(d.min(1)), high(d.max(1))

    def search(self, x: np.ndarray, rows: np.ndarray, best: np.ndarray, error: np.ndarray) -> int:
        """Puts into best and error of these rows what is nearer here. Returns how many distances were taken."""
        d2, taken = squared(x[rows], self.splits), len(rows) * len(self.splits)
        nearest = d2.min(1)
        index = np.where(d2 == nearest[:, None], self.at[None], np.iinfo(np.int64).max).min(1)
        closer = (nearest < error[rows]) | (nearest == error[rows]) & (index < best[rows])
        best[rows[closer]], error[rows[closer]] = index[closer], nearest[closer]
        if any(self.children):
            down, up = low(d2), high(d2)
            for j, child in enumerate(self.children):
                if child:
                    reach = high(error[rows])[:, None]
                    out = (down > (self.most[:, j] + reach) * (1 + SLACK)) | ((up + reach) * (1 + SLACK) < self.least[:, j])
                    left = rows[~out.any(1)]
                    if len(left):
                        taken += child.search(x, left, best, error)
        return taken


def cuts(width: int) -> list[tuple[int, int]]:
    """Where each part begins and ends; equal where the width is a multiple of PARTS."""
    return [(i * width // PARTS, (i + 1) * width // PARTS) for i in range(PARTS)]


class Codebooks:
    """The entries of each part, as an array of (entries, width), and a tree for each part."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        self.trees = [Gnat(entries[:, a:b], np.arange(len(entries))) for a, b in cuts(entries.shape[1])]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each part's entry, and the squared distances summed over the parts."""
        codes, total = np.empty((len(x), PARTS), np.int64), np.zeros(len(x), np.int64)
        for p, ((a, b), tree) in enumerate(zip(cuts(x.shape[1]), self.trees, strict=True)):
            best, error = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), np.iinfo(np.int64).max)
            tree.search(np.ascontiguousarray(x[:, a:b]), np.arange(len(x)), best, error)
            codes[:, p] = best
            total += error
        return codes, total

    def digest(self) -> str:
        numbers = np.concatenate([self.entries[:, a:b].ravel() for a, b in cuts(self.entries.shape[1])])
        return hashlib.sha256(",".join(map(str, numbers.tolist())).encode()).hexdigest()


def matrices(b: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of rows and their whole-numbered vectors, of those with this width and components in range."""
    lists = column(b, "embedding")
    size = np.diff(np.asarray(lists.offsets))
    at = np.flatnonzero((size == width) & np.asarray(lists.is_valid()))
    flat = lists.values.to_numpy(zero_copy_only=False)
    start = np.asarray(lists.offsets)[:-1]
    for s in range(0, len(at), SLICE):
        rows = at[s : s + SLICE]
        x = np.floor(flat[start[rows, None] + np.arange(width)] * SCALE)
        fits = (np.abs(x) < bound(width)).all(1)
        yield rows[fits], x[fits].astype(np.int64)


def bound(width: int) -> int:
    return int((MAX_ERROR / max(width, 1)) ** 0.5) // 2


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector isn't null and holds no null or non-finite component, as doubles."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return vectors.withColumn("embedding", F.col("embedding").cast("array<double>")).filter(F.col("embedding").isNotNull() & F.forall("embedding", fine))


def sums(rows: DataFrame, books, width: int) -> np.ndarray:
    """By part and entry, how many parts are assigned to it, then the sums of their components: added in each task,
    the tasks' sums by Spark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b_, n, total = books.value, np.zeros((PARTS, ENTRIES), np.int64), np.zeros((ENTRIES, width), np.int64)
        for b in batches:
            for _, x in matrices(b, width):
                codes, _ = b_.assign(x)
                for p, (a, e) in enumerate(cuts(width)):
                    n[p] += np.bincount(codes[:, p], minlength=ENTRIES)
                    np.add.at(total[:, a:e], codes[:, p], x[:, a:e])
        flat = np.concatenate([n.ravel(), total.ravel()])
        at = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(flat[at])], names=["slot", "n"])

    out = np.zeros(PARTS * ENTRIES + ENTRIES * width, np.int64)
    # a row for each slot, which the width alone bounds
    for r in rows.select("embedding").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[r.slot] = r.n
    return out


def encode(vectors: DataFrame) -> DataFrame:
    """The rows with a usable vector, with code, error, label_error and codebooks_sha256.

    Each component x becomes floor(256 * x). The codebooks begin with the parts of the ENTRIES rows with the smallest
    vec_id, of equal ids those with the smaller vector (all rows, if fewer; null ids are none of them). Where the width
    isn't a multiple of PARTS, parts differ by one component; parts without components have code 0. Vectors of another
    width than most have (of equally many, the smaller width), and those with a component so large that distances would
    pass 64 bits, get a null code and a null error and count in nothing. label_error is null where no row of the label
    has an error, or where the sum passes 64 bits. Repeated rows are encoded each; an empty table gives no rows. Other
    columns than vec_id, label and embedding are passed over.
    """
    spark, rows = vectors.sparkSession, usable(vectors.select("vec_id", "label", "embedding"))
    common = rows.groupBy(F.size("embedding").alias("width")).count().orderBy(F.desc("count"), "width").first()
    width = common.width if common else 0
    limit = float(bound(width)) / SCALE
    first = rows.filter((F.size("embedding") == width) & F.col("vec_id").isNotNull() & F.forall("embedding", lambda x: F.floor(x * SCALE).between(-bound(width) + 1, bound(width) - 1) & (F.abs(x) <= limit)))
    first = first.orderBy("vec_id", "embedding").limit(ENTRIES).collect()
    entries = np.array([np.floor(np.array(r.embedding) * SCALE) for r in first], np.float64).reshape(len(first), width).astype(np.int64)
    if first:
        for _ in range(ROUNDS):
            got = sums(rows, spark.sparkContext.broadcast(Codebooks(entries)), width)
            n, total = got[: PARTS * ENTRIES].reshape(PARTS, ENTRIES)[:, : len(entries)], got[PARTS * ENTRIES :].reshape(ENTRIES, width)[: len(entries)]
            entries = entries.copy()
            for p, (a, b) in enumerate(cuts(width)):
                used = n[p] > 0
                entries[used, a:b] = total[used, a:b] // n[p][used, None]
    books, kinds = spark.sparkContext.broadcast(Codebooks(entries) if first else None), dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, error = np.full(b.num_rows, None, object), np.zeros(b.num_rows, np.int64)
            for at, x in matrices(b, width) if books.value else ():
                codes, error[at] = books.value.assign(x)
                text = codes.astype(np.uint8).tobytes().hex()
                code[at] = [text[i : i + 2 * PARTS] for i in range(0, len(text), 2 * PARTS)]
            yield pa.RecordBatch.from_arrays([column(b, "vec_id"), column(b, "label"), pa.array(code, pa.string()), pa.array(error, mask=code == None)], names=["vec_id", "label", "code", "error"])  # noqa: E711

    out = written(rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), "vector-codes")
    by_label = written(out.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error")), "vector-labels")
    return with_sums(out, by_label).select("vec_id", "code", "error", "label_error", F.lit(Codebooks(entries).digest() if first else hashlib.sha256(b"").hexdigest()).alias("codebooks_sha256"))


def with_sums(out: DataFrame, by_label: DataFrame) -> DataFrame:
    """Each row with the sum of its label, null labels too. Where labels are many, a frequent one is dealt to SALT tasks."""
    if by_label.count() <= MAX_LABELS:
        return out.join(F.broadcast(by_label), F.col("label").eqNullSafe(F.col("of")))
    salt, other = unused(out, "salt"), unused(out, "salt_of")
    by_label = by_label.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return out.withColumn(salt, F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALT)).cast("int")).join(by_label, F.col("label").eqNullSafe(F.col("of")) & (F.col(salt) == F.col(other)))


def op12_codes(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "embeddings"))
