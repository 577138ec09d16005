"""Ranked lexical search: dense blocked products of item weights and document impacts, and the best of each tile."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import column, table, written

#: What isn't a term's character becomes a blank, A-Z the small letters. Bytes from 128 on are parts of
#: characters that all belong to terms.
CHARACTERS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
UNIT, SATURATION, LENGTH = 1_000_000_000, 8, 75
#: Items of a block; terms and documents of a tile.
ITEMS, TERMS, DOCS = 128, 2048, 1024
#: A tile of documents ends earlier once so many of its terms are known.
KNOWN = 1_000_000
#: A group of items is broadcast at once: so many bytes of terms and so many items on average, by a hash of the item.
GROUP_BYTES, GROUP_ITEMS = 16 << 20, 16_384
#: Whole numbers up to here are exact as doubles.
EXACT = 1 << 53
#: No impact is larger: UNIT * tf // (1000 * tf + ...).
MOST = UNIT // 1000
#: Parts of an item's ranking that are ranked for themselves first.
SPREAD = 64


def terms(text: str | None) -> list[bytes]:
    """The maximal runs of letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return (text or "").encode().translate(CHARACTERS).split(b" ")


def bag(text: str | None) -> Counter:
    found = Counter(terms(text))
    found.pop(b"", None)
    return found


def bags(items: DataFrame) -> DataFrame:
    """For each item_id, null too, its terms and how often each stands in the texts of all its rows."""
    kind = dict(items.dtypes)["item_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in zip(column(b, "item_id"), column(b, "text"), strict=True):
                found = bag(t.as_py())
                yield pa.RecordBatch.from_arrays([pa.array([i.as_py()] * len(found), b.schema.field("item_id").type), pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["item_id", "term", "n"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id {kind}, term binary, n long").groupBy("item_id", "term").agg(F.sum("n").alias("n"))


class Group:
    """Items whose terms are numbered: of each, the terms' numbers and counts."""

    def __init__(self, rows: list) -> None:
        self.ids = sorted({r.item_id for r in rows}, key=lambda i: (i is None, i if i is not None else 0))
        self.number = {t: k for k, t in enumerate(sorted({bytes(r.term) for r in rows}))}
        at = {i: k for k, i in enumerate(self.ids)}
        self.item = np.array([at[r.item_id] for r in rows], np.int64)
        self.term = np.array([self.number[bytes(r.term)] for r in rows], np.int64)
        self.count = np.array([r.n for r in rows], np.int64)

    def tiles(self, weight: np.ndarray) -> list[tuple[int, int, list[tuple[np.ndarray, np.ndarray]]]]:
        """For each block of items its first and last and tiles of terms: the terms' numbers, and the weights as doubles
        (items by terms). In a tile no item's weights sum to more than EXACT / MOST, so that all partial sums of a
        product with impacts are exact; larger weights are cut into several columns.
        """
        out, most = [], EXACT // MOST
        value = self.count * weight[self.term]
        for first in range(0, len(self.ids), ITEMS):
            last = min(first + ITEMS, len(self.ids))
            mine = np.flatnonzero((self.item >= first) & (self.item < last) & (value > 0))
            found, local = np.unique(self.term[mine], return_inverse=True)
            tiles = []
            for a in range(0, len(found), TERMS):
                some = (local >= a) & (local < a + TERMS)
                dense = np.zeros((last - first, min(TERMS, len(found) - a)), np.int64)
                dense[self.item[mine[some]] - first, local[some] - a] = value[mine[some]]
                tiles += [(found[a : a + TERMS][use], x) for use, x in halved(dense, most)]
            out.append((first, last, tiles))
        return out


def halved(dense: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The columns in parts in which each row sums to at most ``most``; of a larger single column, parts of its values."""
    todo = [(np.arange(dense.shape[1]), dense)]
    while todo:
        use, x = todo.pop()
        if x.size == 0 or not x.any():
            continue
        if x.sum(1).max() <= most:
            yield use, x.astype(np.float64)
        elif x.shape[1] > 1:
            n = x.shape[1] // 2
            todo += [(use[:n], x[:, :n]), (use[n:], x[:, n:])]
        else:
            todo += [(use, np.minimum(x, most)), (use, x - np.minimum(x, most))]


class Best:
    """The k best documents of each item so far, best first: scores (0: none), ids and whether an id is null."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.score = k, np.zeros((items, k), np.int64)
        self.id, self.null = np.zeros((items, k), np.int64), np.zeros((items, k), bool)

    def add(self, first: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """Scores of a tile, for the items from ``first`` on. What is equal to the k-th best stays until ids decide."""
        last, k = first + len(score), self.k
        floor = np.maximum(self.score[first:last, -1], 1)
        if score.shape[1] > k:
            floor = np.maximum(floor, np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k])
        r, j = np.nonzero(score >= floor[:, None])
        if not len(r):
            return
        touched = np.unique(r)
        old_r, old_j = np.nonzero(self.score[first + touched] > 0)
        row = np.concatenate([r, touched[old_r]])
        s = np.concatenate([score[r, j], self.score[first + touched[old_r], old_j]])
        i = np.concatenate([ids[j], self.id[first + touched[old_r], old_j]])
        n = np.concatenate([null[j], self.null[first + touched[old_r], old_j]])
        order = np.lexsort((i, n, -s, row))
        row = row[order]
        start = np.flatnonzero(np.diff(row, prepend=-1))
        place = np.arange(len(row)) - np.repeat(start, np.diff(np.append(start, len(row))))
        stay = place < k
        order, row, place = order[stay], row[stay], place[stay]
        self.score[first + row, place], self.id[first + row, place], self.null[first + row, place] = s[order], i[order], n[order]


def counted(docs: DataFrame, group) -> tuple[int, int, np.ndarray]:
    """How many documents have a term, their terms with repeats, and in how many each term of the group stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = group.value.number
        n, df = [0, 0], Counter()
        for b in batches:
            for t in column(b, "text"):
                found = bag(t.as_py())
                n[0] += bool(found)
                n[1] += found.total()
                df.update(number.keys() & found.keys())
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *(number[t] for t in df)], pa.int64()), pa.array([*n, *df.values()], pa.int64())], names=["slot", "n"])

    out = np.zeros(len(group.value.number) + 2, np.int64)
    for r in docs.select("text").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[r.slot] = r.n  # -2 and -1: the last two
    return int(out[-2]), int(out[-1]), out[:-2]


def ranked(docs: DataFrame, group: Group, k: int) -> DataFrame:
    """item (its number in the group), doc_id and score of the k best documents of each item, at least."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(group)
    n_docs, n_terms, df = counted(docs, shared)
    weight = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        number, blocks, best = g.number, g.tiles(weight), Best(len(g.ids), k)
        ids, term, doc, impact = [], [], [], []

        def flush() -> None:
            t, d, x = np.array(term, np.int64), np.array(doc, np.int64), np.array(impact, np.int64)
            null = np.array([i is None for i in ids])
            numbers = np.array([0 if i is None else i for i in ids], np.int64)
            for first, last, tiles in blocks:
                score = np.zeros((last - first, len(ids)), np.int64)
                at = np.full(len(number), -1, np.int64)
                for use, w in tiles:
                    at[use] = np.arange(len(use))
                    mine = np.flatnonzero(at[t] >= 0)
                    dense = np.zeros((len(use), len(ids)))
                    dense[at[t[mine]], d[mine]] = x[mine]
                    score += (w @ dense).astype(np.int64)
                    at[use] = -1
                best.add(first, score, numbers, null)
            for held in (ids, term, doc, impact):
                held.clear()

        for b in batches:
            for i, text in zip(column(b, "doc_id").to_pylist(), column(b, "text"), strict=True):
                found = bag(text.as_py())
                known = number.keys() & found.keys()
                if not known:
                    continue
                m = 8 * (100 - LENGTH + LENGTH * found.total() * n_docs // n_terms)
                for x in known:
                    tf = found[x]
                    term.append(number[x])
                    doc.append(len(ids))
                    impact.append(UNIT * tf // (1000 * tf + m))
                ids.append(i)
                if len(ids) == DOCS or len(term) >= KNOWN:
                    flush()
        if ids:
            flush()
        r, j = np.nonzero(best.score)
        yield pa.RecordBatch.from_arrays([pa.array(r.astype(np.int32)), pa.array(best.id[r, j], mask=best.null[r, j]), pa.array(best.score[r, j])], names=["item", "doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of the k documents that score highest for each item, above 0.

    Rows of one item_id, null too, are one item with the terms of all their texts. Each row of docs is a document;
    of equal scores the smaller doc_id goes first, null last. Items and documents without a term, null and empty texts
    among them, give no rows, nor does an empty table. Further columns are passed over. Items are taken in groups of
    about GROUP_BYTES of terms, each of which reads the documents twice: once for counts, once for scores. One item's
    own terms must fit a broadcast.
    """
    spark = docs.sparkSession
    each = written(bags(items), "ranking-items")
    size = each.agg(F.sum(F.length("term") + 100).alias("bytes"), F.approx_count_distinct("item_id").alias("items")).first()
    if not size["bytes"]:
        return spark.createDataFrame([], f"item_id {dict(each.dtypes)['item_id']}, rank int, doc_id long, score long")
    groups = max(-(-size["bytes"] // GROUP_BYTES), -(-size["items"] // GROUP_ITEMS))
    each = each.withColumn("group", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
    found = []
    for i in range(groups):
        rows = each.filter(F.col("group") == i).collect()
        if rows:
            group = Group(rows)
            names = spark.createDataFrame(list(enumerate(group.ids)), f"item int, item_id {dict(each.dtypes)['item_id']}")
            found.append(top(ranked(docs, group, k), k).join(F.broadcast(names), "item"))
    return reduce(DataFrame.unionAll, found).select("item_id", "rank", "doc_id", "score")


def top(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, first within SPREAD parts by document, then over them."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SPREAD)))
    part = part.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= k)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k).drop("part")


def op13_ranking(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
