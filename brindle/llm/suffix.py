"""Suffix-array dedup by a difference cover, sorted as far as a window reaches.

A difference cover D of period v is a set of residues such that any two places become sampled places, p mod v in D, if
both are moved on by one and the same number below v. The steps:

1. Sort the samples: each sampled place gets the name of the v bytes from it; names that stand once are discarded, as
   nothing that begins there is repeated as far as is asked for.
2. Recurse on names: in the string of names of one residue, those of p and p + v give the name of 2 v bytes, again sorted
   and discarded where it stands once. A sample's stretch is what all windows reach that begin at most v - 1 bytes before
   it: stretches that stand twice need nothing further.
3. Merge the remaining suffixes: starts whose sample has a name that stands again, but not its stretch, are sorted with
   those of the sample's equals by the window that begins there.
4. Compare adjacent prefixes: a window that equals its neighbour in that order is repeated.

A window of w bytes holds 2 v bytes from any sample that is at most v - 1 bytes from its start if 3 v <= w + 1, so equal
windows always meet: their common sample has equal names in both rounds. Names and windows are hashes; a prefix's order
by hash puts equal ones side by side as the alphabet's would.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import column, mixed, written
from brindle.llm.meeting import OPEN, WHOLE, Entries, bits_for, block_repeats, block_stretches, entries, judge_repeats, judge_stretches, met
from brindle.llm.repeats import BASE, CHUNK, SPAN, SPANS, Judge, byte_units, copies, finished, fresh, hashes, inflated, numbered, sums, zipped

#: Perfect difference sets by their period. Each number below the period is the difference of one pair.
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
    133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109),
}


def cover_for(size: int) -> tuple[int, np.ndarray]:
    """The largest period v with 3 v <= size + 1, and which residues of it are sampled."""
    period = max(v for v in COVERS if 3 * v <= size + 1)
    sampled = np.zeros(period, bool)
    sampled[list(COVERS[period])] = True
    return period, sampled


def named(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes; starts ascend. A long text is taken in pieces."""
    out = np.empty(len(start), np.uint64)
    cut = np.searchsorted(start, np.arange(0, len(data) + CHUNK, CHUNK))
    for base, a, b in zip(range(0, len(data), CHUNK), cut, cut[1:], strict=False):
        if b > a:
            s = sums(byte_units(data[base : int(end[a:b].max())]))
            out[a:b] = hashes(s, start[a:b] - base, end[a:b] - base)
    return out


def reach(p: np.ndarray, n: int, size: int, period: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and last start of the windows that hold sample p within a period of their start; none if last < first."""
    return np.maximum(p - period + 1, 0), np.minimum(p, n - size)


def mask_of(lo: np.ndarray, hi: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in the closed ranges."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, lo, 1)
    np.add.at(step, hi + 1, -1)
    return np.cumsum(step)[:n] > 0


def ranges(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return [{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


def remove(docs: DataFrame, size: int, digest: bool = False) -> DataFrame:
    """doc_id, text_hash, n, n_removed, n_spans, spans and kept (or its SHA-256, kept_sha256) of each document.

    A byte goes if a string of ``size`` bytes (8 at least) that covers it also starts anywhere else, in any text or the
    same one; spans are the maximal runs of bytes that go, end exclusive. Null texts are empty; texts shorter than a
    window lose nothing; repeated rows are copies of each other and lose all that windows cover; an empty table gives
    no rows. Further columns are passed over. Names are compared by 48 and 40 bits of hash, which do as a filter;
    stretches by 64 under a name, windows by 80.
    """
    period, sampled = cover_for(size)
    kind = dict(docs.dtypes)["doc_id"]
    docs = numbered(docs)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bits_for(total * int(sampled.sum()) // period)
    judge = Judge(words=False, digest=digest)

    def samples(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        """Each sampled place with the name of the period that begins there."""
        for ref, data in fresh(batches, size):
            for base in range(0, len(data) - period + 1, CHUNK):
                part = data[base : base + CHUNK + period - 1]
                p = np.flatnonzero(sampled[np.arange(base, base + len(part) - period + 1) % period])
                # a filter alone: 48 bits do, and cost less in the shuffle
                yield entries(ref, hashes(sums(byte_units(part)), p, p + period) & ~np.uint64(0xFFFF), 0, p + base, 1)

    again = met(docs.select("ref", "text"), samples, block_repeats, judge_repeats, bits)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The result of copies and of texts without a sample whose name and next name stand again; such samples."""
        for b in batches:
            out, z, todo = [], [], []
            for x, n, values, copy in zip(*(column(b, c).to_pylist() for c in ("z", "n_bytes", "values", "copy")), strict=True):
                p = np.unique(np.array(values or [], np.int64))
                p = p[np.isin(p + period, p, assume_unique=True)]
                lo, hi = reach(p, n, size, period)
                p = p[lo <= hi]
                out.append(judge(inflated(x, n), [(0, n)] if copy and n >= size else []) if copy or not len(p) else None)
                z.append(x if len(p) else None)
                todo.append(p if len(p) else None)
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in ("doc_id", "text_hash", "ref", "n_bytes", "copy")), pa.array(out, judge.arrow), pa.array(z, pa.binary()), pa.array(todo, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "ref", "n_bytes", "copy", "out", "z", "todo"])

    state = zipped(docs).join(again.join(copies(docs), "ref", "full"), "ref", "left").select("doc_id", "text_hash", "ref", "z", "n_bytes", "values", "copy")
    state = written(state.mapInArrow(first, f"doc_id {kind}, text_hash long, ref long, n_bytes long, copy boolean, out {judge.sql}, z binary, todo array<long>"), "suffix-samples")
    open_texts = state.filter("todo is not null")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        """Each such sample with the name of two names, and its stretch. A copy counts double."""
        for b in batches:
            for ref, z, n, p, copy in zip(*(column(b, c).to_pylist() for c in ("ref", "z", "n_bytes", "todo", "copy")), strict=True):
                data, p = inflated(z, n), np.array(p, np.int64)
                lo, hi = reach(p, n, size, period)
                name = mixed(named(data, p, p + period) * np.uint64(BASE) + named(data, p + period, p + 2 * period))
                stretch = mixed(named(data, lo, hi + size) + (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (p - lo).astype(np.uint64) * np.uint64(BASE))
                yield entries(ref, name & ~np.uint64(0xFFFFFF), stretch, p << 3, int(bool(copy)))

    marks = met(open_texts.select("ref", "z", "n_bytes", "todo", "copy"), pairs, block_stretches, judge_stretches, bits)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The result of texts without open starts; of others what is known, and the starts that ask and that answer."""
        for b in batches:
            out, zs, covered, asks, tells = [], [], [], [], []
            for z, n, values, copy in zip(*(column(b, c).to_pylist() for c in ("z", "n_bytes", "values", "copy")), strict=True):
                v = np.array(values or [], np.int64)
                lo, hi = reach(v >> 3, n, size, period)
                whole, open_ = (v & WHOLE) > 0, (v & OPEN) > 0
                sure = mask_of(lo[whole], hi[whole], n)
                ask = mask_of(lo[open_ & ~whole], hi[open_ & ~whole], n) & ~sure
                tell = mask_of(lo[open_], hi[open_], n) & ~ask  # what is sure itself must answer others
                last = copy or not ask.any()
                cover = [(x["start"], x["end"] - 1 + size) for x in ranges(sure)]
                out.append(judge(inflated(z, n), cover) if last and not copy else None)
                covered.append(None if last else [{"start": x, "end": y} for x, y in cover])
                asks.append([] if copy else ranges(ask))
                tells.append(ranges(tell | ask) if copy else ranges(tell))
                zs.append(z if asks[-1] or tells[-1] else None)
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in ("doc_id", "text_hash", "ref", "n_bytes")), pa.array(out, judge.arrow), pa.array(zs, pa.binary()), *(pa.array(x, pa.list_(SPAN)) for x in (covered, asks, tells))], names=["doc_id", "text_hash", "ref", "n_bytes", "out", "z", "covered", "asks", "tells"])

    late = open_texts.join(marks, "ref", "left").select("doc_id", "text_hash", "ref", "z", "n_bytes", "values", "copy")
    late = written(late.mapInArrow(second, f"doc_id {kind}, text_hash long, ref long, n_bytes long, out {judge.sql}, z binary, covered {SPANS}, asks {SPANS}, tells {SPANS}"), "suffix-starts")

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        """The starts that are left, with the windows that begin there."""
        for b in batches:
            for ref, z, n, asks, tells in zip(*(column(b, c).to_pylist() for c in ("ref", "z", "n_bytes", "asks", "tells")), strict=True):
                data = inflated(z, n)
                for found, ask in ((asks, 1), (tells, 0)):
                    if found:
                        at = np.concatenate([np.arange(x["start"], x["end"]) for x in found])
                        yield entries(ref, named(data, at, at + size), named(data, at, at + size // 2) >> np.uint64(48), at, ask)

    starts = met(late.filter("z is not null").select("ref", "z", "n_bytes", "asks", "tells"), suffixes, block_repeats, judge_repeats, bits)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for z, n, covered, at in zip(*(column(b, c).to_pylist() for c in ("z", "n_bytes", "covered", "values")), strict=True):
                out.append(judge(inflated(z, n), [(x["start"], x["end"]) for x in covered] + [(x, x + size) for x in at or []]))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "text_hash"), pa.array(out, judge.arrow)], names=["doc_id", "text_hash", "out"])

    last = late.filter("covered is not null").select("doc_id", "text_hash", "ref", "z", "n_bytes", "covered").join(starts, "ref", "left")
    last = last.select("doc_id", "text_hash", "z", "n_bytes", "covered", "values").mapInArrow(final, f"doc_id {kind}, text_hash long, out {judge.sql}")
    done = [x.filter("out is not null").select("doc_id", "text_hash", "out") for x in (state, late)]
    return finished([*done, last])


def op1_suffix(spark, sf_dir: str) -> DataFrame:
    out = remove(spark.read.parquet(f"{sf_dir}/documents.parquet"), 400, digest=True)
    return out.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")
