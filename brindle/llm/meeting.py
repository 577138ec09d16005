"""Hashes of places in texts, packed into blocks where they are made and compared in buckets where they meet.

A row for each hash would cost more than the hash itself: entries travel as columns of bytes, with the document's number
in its block for its ref, and each bucket is sorted as an array. What a block alone shows to repeat doesn't go to the
bucket, so that a hash of any number of places fills no task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of a block, and about how many of a bucket.
BLOCK, BUCKET = 1 << 19, 1 << 20
#: Different stretches of one seed that a block sends to the seed's bucket; further ones are taken as open.
FEW = 8
#: Different stretches of a seed beyond which its windows are compared one by one.
MANY = 20_000
#: Up to so many bits of the bucket blocks are cut in one step; beyond, in two of half the bits each, so that a block's
#: rows stay as long however many buckets there are.
DIRECT = 12

#: Bits of a marked place: its whole stretch stands elsewhere; its windows must be compared; by hash, not by extension.
WHOLE, OPEN, WIDE = 1, 2, 4


class Entries(NamedTuple):
    """Columns: the document, two hashes, a place in it, and a flag."""

    ref: np.ndarray
    hash: np.ndarray
    more: np.ndarray
    value: np.ndarray
    flag: np.ndarray

    def take(self, at: np.ndarray) -> Entries:
        return Entries(*(x[at] for x in self))


KINDS = Entries(np.int64, np.uint64, np.uint64, np.int64, np.uint8)


def entries(ref: int, hash_: np.ndarray, more: np.ndarray | int, value: np.ndarray, flag: np.ndarray | int) -> Entries:
    n = len(hash_)
    return Entries(*(np.asarray(x, k) if np.ndim(x) else np.full(n, x, k) for x, k in zip((ref, hash_, more, value, flag), KINDS, strict=True)))


def joined(parts: list[Entries]) -> Entries:
    return Entries(*map(np.concatenate, zip(*parts, strict=True)))


def ordered(e: Entries) -> tuple[np.ndarray, np.ndarray]:
    """An order by both hashes, and whether each in it equals the one before."""
    order = np.lexsort((e.more, e.hash)) if e.more.any() else np.argsort(e.hash, kind="stable")
    return order, (np.diff(e.hash[order]) == 0) & (np.diff(e.more[order]) == 0)


def planes(x: np.ndarray) -> bytes:
    """All first bytes, all second bytes and so on, which compress well where high bytes are alike."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T.tobytes()


def unplaned(data: bytes, kind: type, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(-1, n).T).view(kind).ravel() if n else np.zeros(0, kind)


def deltas(x: np.ndarray) -> bytes:
    """Differences, the sign in the lowest bit, so that high bytes are 0."""
    d = np.diff(x, prepend=x.dtype.type(0))
    return planes((d << 1) ^ (d >> (8 * d.itemsize - 1)))


def undone(data: bytes, kind: type, n: int) -> np.ndarray:
    d = unplaned(data, kind, n)
    return np.cumsum((d >> 1) ^ -(d & 1), dtype=np.int64)


ROW = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), *((k, pa.binary()) for k in ("docs", *Entries._fields[1:], "refs", "of"))])
ROW_SQL = "bucket int, block long, n int, " + ", ".join(f"{f.name} binary" for f in list(ROW)[3:])


ANSWER = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("docs", pa.binary()), ("value", pa.binary()), ("refs", pa.binary()), ("doc", pa.int32()), ("one", pa.int64())])
ANSWER_SQL = "block long, n int, docs binary, value binary, refs binary, doc int, one long"


def packed(bucket: int, block: int, e: Entries) -> dict:
    """A row of entries, whose ref is the document's number in the block."""
    return {"bucket": bucket, "block": block, "n": len(e.ref), "docs": deltas(e.ref.astype(np.int32)), "hash": planes(e.hash), "more": planes(e.more), "value": deltas(e.value), "flag": e.flag.tobytes()}


def repacked(bucket: int, numbers: np.ndarray, e: Entries) -> dict:
    """A row of entries of several blocks, whose refs hold the place of the block's number in numbers in the upper half."""
    at, of = np.unique(e.ref >> 32, return_inverse=True)
    return packed(bucket, 0, e._replace(ref=e.ref & 0xFFFFFFFF)) | {"refs": numbers[at].tobytes(), "of": deltas(of.astype(np.int32))}


def unpacked(row: dict, numbers: list[int]) -> Entries:
    """The entries, each with its block's place in numbers, which grow by the row's blocks, in the upper half of its ref."""
    n, place = row["n"], len(numbers)
    if row["of"] is None:
        numbers.append(row["block"])
    else:
        numbers += np.frombuffer(row["refs"], np.int64).tolist()
        place = place + undone(row["of"], np.int32, n)
    return Entries(undone(row["docs"], np.int32, n) | (place << 32), unplaned(row["hash"], np.uint64, n), unplaned(row["more"], np.uint64, n), undone(row["value"], np.int64, n), np.frombuffer(row["flag"], np.uint8))


def cut(e: Entries, bits: int) -> Iterator[tuple[int, Entries]]:
    """The entries of each bucket, by document and place, so that neighbours' differences are small."""
    bucket = (e.hash >> np.uint64(64 - bits)).astype(np.int64)
    order = np.lexsort((e.value, e.ref, bucket))
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        yield int(bucket[part[0]]), e.take(part)


def batches_of(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 64):
        yield pa.RecordBatch.from_pylist(rows[at : at + 64], ROW)


def bits_for(n: int) -> int:
    """Bits of the bucket for so many entries."""
    return int(np.clip(np.ceil(np.log2(max(n, 1) / BUCKET)), 5, 24))


def met(df: DataFrame, found: Callable, block: Callable, judge: Callable, bits: int) -> DataFrame:
    """ref and values: of each document the values that judge or block gives.

    found turns Arrow batches of df into Entries, block a block's Entries into those to send and (ref, value) already
    known, judge all Entries of a bucket into (ref, value). A bucket holds whole hashes. Over DIRECT bits, blocks are
    first cut by half the bits; what comes together there is put into new blocks, which are cut by all bits.
    """
    first = bits if bits <= DIRECT else (bits + 1) // 2

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for e in found(batches):
            held.append(e)
            n += len(e.ref)
            if n >= BLOCK:
                yield from rows(joined(held))
                held, n = [], 0
        if n:
            yield from rows(joined(held))

    def rows(e: Entries) -> Iterator[pa.RecordBatch]:
        refs, doc = np.unique(e.ref, return_inverse=True)
        send, (ref, value) = block(e._replace(ref=doc.astype(np.int64)))
        # by content, so that a task that runs again gives the same
        number = int.from_bytes(hashlib.blake2b(refs.tobytes(), digest_size=8).digest(), "little", signed=True)
        apart = (1 << first) + number % (1 << first)
        out = [{"bucket": apart, "block": number, "n": len(refs), "refs": refs.tobytes()}]
        if len(ref):
            order = np.lexsort((value, ref))
            out.append(packed(apart, number, entries(ref[order], np.zeros(len(ref), np.uint64), 0, value[order], 0)))
        if len(send.ref):
            out += [packed(bucket, number, part) for bucket, part in cut(send, first)]
        yield from batches_of(out)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """New blocks of entries that share the first bits, cut by all of them."""
        held, numbers, n, now = [], [], 0, None
        for b in batches:
            for row in b.to_pylist():
                if held and (row["bucket"] != now or n >= BLOCK):
                    yield from anew(held, numbers)
                    held, numbers, n = [], [], 0
                now = row["bucket"]
                if now >= 1 << first:
                    yield from batches_of([row | {"bucket": (1 << bits) + row["block"] % (1 << bits)}])
                else:
                    held.append(unpacked(row, numbers))
                    n += row["n"]
        if held:
            yield from anew(held, numbers)

    def anew(held: list[Entries], numbers: list[int]) -> Iterator[pa.RecordBatch]:
        known = np.array(numbers, np.int64)
        yield from batches_of([repacked(bucket, known, part) for bucket, part in cut(joined(held), bits)])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Answers to each block: documents' numbers and values; and the blocks' documents as they came."""
        held, numbers, now = [], [], None
        for b in batches:
            for row in b.to_pylist():
                if row["bucket"] != now and held:
                    yield answers(numbers, *judge(joined(held)))
                    held, numbers = [], []
                now = row["bucket"]
                if now >= 1 << bits:
                    yield pa.RecordBatch.from_pylist([{k: row.get(k) for k in ANSWER.names}], ANSWER)
                else:
                    held.append(unpacked(row, numbers))
        if held:
            yield answers(numbers, *judge(joined(held)))

    def answers(numbers: list[int], ref: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        if first < bits:  # a bucket has few answers to each of very many blocks: a plain row each
            block, doc = pa.array(np.array(numbers, np.int64)[ref >> 32]), pa.array((ref & 0xFFFFFFFF).astype(np.int32))
            plain = {"block": block, "doc": doc, "one": pa.array(value)}
            return pa.RecordBatch.from_arrays([plain.get(f.name, pa.nulls(len(ref), f.type)) for f in ANSWER], schema=ANSWER)
        order = np.lexsort((value, ref))
        ref, value = ref[order], value[order]
        ends = [0, *(np.flatnonzero(np.diff(ref >> 32)) + 1).tolist(), len(ref)]
        parts = [(numbers[int(ref[a] >> 32)], (ref[a:b] & 0xFFFFFFFF).astype(np.int32), value[a:b]) for a, b in zip(ends, ends[1:], strict=False) if b > a]
        return pa.RecordBatch.from_pylist([{"block": k, "n": len(doc), "docs": deltas(doc), "value": deltas(v)} for k, doc, v in parts], ANSWER)

    def collected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """ref and values of each document of a block that has any."""
        held, now = [], None
        for b in batches:
            block = b.column(0).to_numpy()
            ends = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for start, end in zip(ends, ends[1:], strict=False):
                if end > start:
                    if block[start] != now and held:
                        yield from lists(held)
                        held = []
                    now = block[start]
                    held.append(b.slice(start, end - start))
        if held:
            yield from lists(held)

    def lists(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        single = whole.filter(whole["doc"].is_valid())
        rows = whole.filter(whole["doc"].is_null()).to_pylist()
        refs = next(np.frombuffer(r["refs"], np.int64) for r in rows if r["refs"] is not None)
        rows = [r for r in rows if r["refs"] is None]
        if rows or len(single):
            doc = np.concatenate([single["doc"].to_numpy().astype(np.int64), *(undone(r["docs"], np.int32, r["n"]) for r in rows)])
            value = np.concatenate([single["one"].to_numpy(), *(undone(r["value"], np.int64, r["n"]) for r in rows)])
            order = np.lexsort((value, doc))
            docs, at = np.unique(doc[order], return_index=True)
            out = pa.RecordBatch.from_arrays([pa.array(refs[docs]), pa.ListArray.from_arrays(pa.array(np.append(at, len(doc)).astype(np.int32)), pa.array(value[order]))], names=["ref", "values"])
            for at in range(0, len(docs), 1_000):
                yield out.slice(at, 1_000)

    dealt = df.mapInArrow(make, ROW_SQL)
    if first < bits:
        # some 16 new blocks to a task, so that there are as many tasks as the entries are worth
        slices = F.pmod("block", F.lit(max(1, 1 << max(0, bits - first - 3))))
        dealt = dealt.repartition("bucket", slices).sortWithinPartitions("bucket").mapInArrow(again, ROW_SQL)
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
    told = dealt.mapInArrow(meet, ANSWER_SQL).repartition("block").sortWithinPartitions("block")
    # a document may be in several blocks
    return told.mapInArrow(collected, "ref long, values array<long>").groupBy("ref").agg(F.flatten(F.collect_list("values")).alias("values"))


def block_repeats(e: Entries) -> tuple[Entries, tuple[np.ndarray, np.ndarray]]:
    """A third and further entry of equal hashes surely repeats; of it, only the value is sent, if it asks (flag 1)."""
    order, same = ordered(e)
    third = np.zeros(len(order), bool)
    third[order[2:]] = same[1:] & same[:-1]
    sure = third & (e.flag == 1)
    return e.take(~third), (e.ref[sure], e.value[sure])


def judge_repeats(e: Entries) -> tuple[np.ndarray, np.ndarray]:
    """The entries that ask (flag 1) and whose hashes another entry has too."""
    order, same = ordered(e)
    again = np.zeros(len(order), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    again &= e.flag == 1
    return e.ref[again], e.value[again]


def classes(e: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order by seed (hash) and stretch (more); in it the numbers of seed and stretch, how many equal ones stand
    before each entry, and how many other stretches of its seed stand before its own.
    """
    order, same = ordered(e)
    seed = np.cumsum(np.diff(e.hash[order], prepend=e.hash[order[:1]]) != 0)
    stretch = np.cumsum(np.concatenate([[False], ~same]))
    at = np.arange(len(order))
    before = at - np.searchsorted(stretch, stretch)
    rank = stretch - stretch[np.searchsorted(seed, seed)]
    return order, seed, stretch, before, rank


def block_stretches(e: Entries) -> tuple[Entries, tuple[np.ndarray, np.ndarray]]:
    """Two entries of a stretch and FEW stretches of a seed stand for what the block has of them.

    Flag 1 counts an entry double, flag 2 tells the bucket that the seed has more stretches than are sent.
    """
    order, seed, stretch, before, rank = classes(e)
    value, flag = e.value[order], e.flag[order]
    n = np.bincount(stretch, 1.0 + (flag & 1))[stretch]
    third, far = before >= 2, (rank >= FEW) & (before < 2)
    flag = flag | 2 * (np.maximum.reduceat(rank, np.unique(seed, return_index=True)[1])[seed] >= FEW).astype(np.uint8)
    known = value | (WHOLE * (n > 1)) | np.where(far, WIDE | OPEN * (before == 0), 0)
    sent = ~third & ~far
    part = e.take(order[sent])._replace(flag=flag[sent])
    ref = e.ref[order]
    return part, (ref[~sent], known[~sent])


def judge_stretches(e: Entries) -> tuple[np.ndarray, np.ndarray]:
    """The values of seeds that stand more than once with their marks.

    WHOLE where an equal stretch stands elsewhere. OPEN for stretches that differ from all others of their seed, and for
    one of each equal stretch where the seed has such a one.
    """
    order, seed, stretch, before, rank = classes(e)
    weight = 1.0 + (e.flag[order] & 1)
    n, total = np.bincount(stretch, weight)[stretch], np.bincount(seed, weight)[seed]
    cut = np.unique(seed, return_index=True)[1]
    alone = np.maximum.reduceat(n == 1, cut)[seed]
    forced = np.maximum.reduceat((e.flag[order] & 2) > 0, cut)[seed]
    wide = forced | (np.maximum.reduceat(rank, cut)[seed] >= MANY)
    value = e.value[order] | (WHOLE * (n > 1)) | OPEN * ((alone | forced) & (before == 0)) | (WIDE * wide)
    keep = (total > 1) | forced
    return e.ref[order][keep], value[keep]
