"""Substring dedup by seed and extend: documents meet on winnowed anchors, matches are extended both ways, and maximal
repeats over the length threshold are kept.

Anchors: each window of ``size`` words chooses the smallest hash among its grams of ``gram`` words (winnowing), so equal
windows choose equal anchors at equal places. The starts that choose one anchor are a run, and its stretch is what its
windows cover. Runs of equal anchors meet. An anchor that stands once has no repeat; of equal stretches all windows
repeat; stretches that share an anchor and then differ are extended: their words to the right and to the left are
compared, sorted so that each stretch's longest match for every reach to the left is a neighbour. No group is paired
throughout. Anchors with very many different stretches (``meeting.MANY``) have their windows compared by hash instead,
so that no anchor fills a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import column, mixed, written
from brindle.llm.meeting import OPEN, WHOLE, WIDE, Entries, bits_for, block_repeats, block_stretches, entries, judge_repeats, judge_stretches, met

BASE = 0x9E3779B97F4A7C15 | 1
#: Starts that are taken at once; a longer text is taken in pieces that overlap by a window.
CHUNK = 1 << 18
#: Runs that are extended at once; those of one anchor always are.
EXTENDED = 10_000
#: Tasks over which copies of one text are dealt when they are told.
SALTS = 16
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
SPANS = "array<struct<start:int,end:int>>"


@lru_cache(1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse, modulo 2 ** 64."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def sums(units: np.ndarray) -> np.ndarray:
    """Running sums of a polynomial over the units, one more than units."""
    size = 1 << max(16, int(len(units)).bit_length())
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units + np.uint64(1)) * powers(size)[0][: len(units)], out=out[1:])
    return out


def hashes(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each stretch of units, which doesn't depend on where it stands."""
    size = 1 << max(16, int(len(s) - 1).bit_length())
    return mixed((s[end] - s[start]) * powers(size)[1][start])


def smallest(g: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest of each ``width`` values in a row stands, the last of equal ones."""
    n = len(g)
    pad = -n % width
    top = np.iinfo(np.uint64).max
    rows = np.concatenate([g, np.full(pad, top, np.uint64)]).reshape(-1, width)
    at = np.arange(n + pad).reshape(rows.shape)
    low = np.minimum.accumulate(rows, 1)
    low_at = np.maximum.accumulate(np.where(rows == low, at, -1), 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)
    new = np.ones(rows.shape, bool)
    new[:, 1:] = rows[:, ::-1][:, 1:] < back[:, :-1]
    back_at = np.minimum.accumulate(np.where(new, at[:, ::-1], n + pad), 1)[:, ::-1].ravel()
    first = np.arange(n - width + 1)
    left, right = back_at[first], low_at[first + width - 1]
    flat = rows.ravel()
    return np.where(flat[right] <= flat[left], right, left)


def byte_units(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).astype(np.uint64)


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    gap = np.concatenate([[True], SPACES[np.frombuffer(data, np.uint8)], [True]])
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    return edge[::2], edge[1::2]


def word_units(data: bytes) -> np.ndarray:
    start, end = word_bounds(data)
    return hashes(sums(np.frombuffer(data, np.uint8).astype(np.uint64)), start, end)


def text_bytes(x: pa.Scalar) -> bytes:
    return (x.as_py() or "").encode()


def deflated(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def inflated(z: bytes, n: int) -> bytes:
    return pa.decompress(z, n, codec="zstd", asbytes=True) if n else b""


def numbered(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.xxhash64("doc_id", "text").alias("ref"), "text")


def zipped(docs: DataFrame) -> DataFrame:
    """The numbered documents with their texts compressed, as z and n_bytes, for the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data = [text_bytes(t) for t in column(b, "text")]
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in ("doc_id", "text_hash", "ref")), pa.array([deflated(x) for x in data], pa.binary()), pa.array(map(len, data), pa.int64())], names=["doc_id", "text_hash", "ref", "z", "n_bytes"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, text_hash long, ref long, z binary, n_bytes long")


def copies(docs: DataFrame) -> DataFrame:
    """ref of each document whose whole text stands in another too, with copy = true."""
    texts = docs.select("ref", F.md5("text").alias("key"), F.pmod("ref", F.lit(SALTS)).alias("salt"))
    more = texts.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    return texts.join(more, ["key", "salt"], "left_semi").select("ref").distinct().withColumn("copy", F.lit(True))


def kept(data: bytes, mask: np.ndarray, words: bool) -> bytes:
    if not words:
        return np.frombuffer(data, np.uint8)[~mask].tobytes()
    start, end = word_bounds(data)
    stay = np.flatnonzero(~mask)
    return b" ".join(data[a:b] for a, b in zip(start[stay].tolist(), end[stay].tolist(), strict=True))


class Judge:
    """Results of documents from the spans of units that repeat."""

    def __init__(self, words: bool, digest: bool) -> None:
        self.words, self.digest = words, digest
        self.arrow = pa.struct([("n", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(SPAN)), ("kept_sha256", pa.string()) if digest else ("kept", pa.binary())])
        self.sql = f"struct<n:bigint,n_removed:bigint,spans:{SPANS},{'kept_sha256:string' if digest else 'kept:binary'}>"

    def size(self, data: bytes) -> int:
        return len(word_bounds(data)[0]) if self.words else len(data)

    def __call__(self, data: bytes, covered: np.ndarray | list) -> dict:
        """covered: rows of first unit and end of what goes; they may overlap."""
        n = self.size(data)
        step = np.zeros(n + 1, np.int32)
        if len(covered):
            a, b = np.asarray(covered).T
            np.add.at(step, a, 1)
            np.add.at(step, b, -1)
        mask = np.cumsum(step)[:n] > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
        out = kept(data, mask, self.words)
        return {"n": n, "n_removed": int(mask.sum()), "spans": [{"start": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)], **({"kept_sha256": hashlib.sha256(out).hexdigest()} if self.digest else {"kept": out})}


def finished(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("doc_id", "text_hash", "out.*").withColumn("n_spans", F.size("spans").cast("long"))


def fresh(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[tuple[int, bytes]]:
    """ref and bytes of each text of so many bytes, but those that the task has met: they are covered as copies."""
    seen = set()
    for b in batches:
        for ref, t in zip(column(b, "ref").to_pylist(), column(b, "text"), strict=True):
            data = text_bytes(t)
            if len(data) >= least and (key := hashlib.blake2b(data, digest_size=12).digest()) not in seen:
                seen.add(key)
                yield ref, data


def runs(units: np.ndarray, size: int, gram: int) -> Iterator[tuple[np.ndarray, ...]]:
    """anchor, stretch, place of the anchor, lo and hi of the runs of starts in a text's units."""
    for base in range(0, len(units) - size + 1, CHUNK):
        part = units[base : base + CHUNK + size - 1]
        s = sums(part)
        place = np.arange(len(part) - gram + 1)
        g = hashes(s, place, place + gram)
        of_each = smallest(g, size - gram + 1)
        cut = np.flatnonzero(np.diff(of_each, prepend=-1))
        lo, hi = cut, np.append(cut[1:], len(of_each)) - 1
        of = of_each[lo]
        tied = mixed(hashes(s, lo, hi + size) + (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (of - lo).astype(np.uint64) * np.uint64(BASE))
        yield g[of], tied, of + base, lo + base, hi + base


#: A run in one number: place of its first start, starts after it, and the anchor's distance; marks are the lowest bits.
def run_value(lo: np.ndarray, hi: np.ndarray, of: np.ndarray) -> np.ndarray:
    return (lo << 27) | ((hi - lo) << 15) | ((of - lo) << 3)


def run_parts(value: np.ndarray) -> tuple[np.ndarray, ...]:
    """lo, hi and place of the anchor, and marks."""
    lo = value >> 27
    return lo, lo + ((value >> 15) & 0xFFF), lo + ((value >> 3) & 0xFFF), value & 7


def prefixes(words: np.ndarray, first: np.ndarray, here: np.ndarray) -> np.ndarray:
    """Hashes of each row's first 0, 1, 2 ... words, from first; here: whether a row has the word. A row without a word
    equals none from there.
    """
    out = np.empty((len(first), words.shape[1] + 1), np.uint64)
    out[:, 0] = first
    own = mixed(np.arange(1, len(first) + 1, dtype=np.uint64) * np.uint64(BASE))
    for j in range(words.shape[1]):
        out[:, j + 1] = mixed(out[:, j] * np.uint64(BASE) + np.where(here[:, j], words[:, j], own * np.uint64(2 * j + 3)))
    return out


def extended(seed: np.ndarray, left: np.ndarray, right: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, words to the left and words to the right of each maximal match of at least so many words.

    left and right: for each row hashes of its 0, 1, 2 ... words before the anchor, and from the anchor on. For each
    reach to the left, rows that share it stand in order of what is on their right, so that the longest match to the
    right is with a neighbour. Of matches within each other the longest is kept.
    """
    n, reach = left.shape
    order = np.lexsort([right[:, j] for j in range(right.shape[1] - 1, 0, -1)])
    longest = np.zeros((n, reach), np.int64)
    for k in range(reach):
        key = mixed(left[order, k] ^ mixed(seed[order]))
        at = order[np.argsort(key, kind="stable")]
        key = np.sort(key)
        a, b = at[:-1], at[1:]
        match = np.where(key[:-1] == key[1:], (right[a, 1:] == right[b, 1:]).sum(1), 0)
        longest[a, k] = match
        longest[b, k] = np.maximum(longest[b, k], match)
    reaches = np.arange(reach)
    further = np.concatenate([longest[:, 1:], np.full((n, 1), -1)], 1)
    row, k = np.nonzero((longest + reaches >= least) & (longest > further))
    return row, k, longest[row, k]


def remove(docs: DataFrame, size: int, gram: int, digest: bool = False) -> DataFrame:
    """doc_id, text_hash, n, n_removed, n_spans, spans and kept (or its SHA-256, kept_sha256) of each document.

    A word goes if a window of ``size`` words that covers it also starts anywhere else, in any text or the same one;
    spans are the maximal runs of words that go, end exclusive. Null texts are empty; texts shorter than a window
    lose nothing; repeated rows are copies of each other and lose all that windows cover; an empty table gives no
    rows. Further columns are passed over. Anchors and stretches are compared by 64 bits of hash each, extended words
    by 64, windows by 80; size is below 4,096.
    """
    kind = dict(docs.dtypes)["doc_id"]
    docs = numbered(docs)
    # about two runs in so many words, of six bytes
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = bits_for(total // 3 // (size - gram + 2))
    judge = Judge(words=True, digest=digest)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        for ref, data in fresh(batches, 2 * size - 1):
            for g, tied, of, lo, hi in runs(word_units(data), size, gram):
                yield entries(ref, g, tied, run_value(lo, hi, of), 0)

    marks = met(docs.select("ref", "text"), found, block_stretches, judge_stretches, bits)
    about = marks.join(copies(docs), "ref", "full")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The result of each text without open runs; of others the text and what is known."""
        for b in batches:
            out, z, covered, todo = [], [], [], []
            for x, n_bytes, values, copy in zip(*(column(b, c).to_pylist() for c in ("z", "n_bytes", "values", "copy")), strict=True):
                data = inflated(x, n_bytes)
                lo, hi, _, mark = run_parts(values := np.array(values or [], np.int64))
                whole, open_ = (mark & WHOLE) > 0, (mark & OPEN) > 0
                if copy:
                    cover = [(0, n)] if (n := judge.size(data)) >= size else []
                else:
                    cover = np.stack([lo, hi + size], 1)[whole].tolist()
                last = copy or not (open_ & ~whole).any()
                out.append(judge(data, cover) if last else None)
                covered.append(None if last else [{"start": s, "end": e} for s, e in cover])
                todo.append(values[open_].tolist() if open_.any() else None)
                z.append(x if open_.any() else None)
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in ("doc_id", "text_hash", "ref", "n_bytes")), pa.array(out, judge.arrow), pa.array(z, pa.binary()), pa.array(covered, pa.list_(SPAN)), pa.array(todo, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "ref", "n_bytes", "out", "z", "covered", "todo"])

    state = zipped(docs).join(about, "ref", "left").select("doc_id", "text_hash", "ref", "z", "n_bytes", "values", "copy")
    state = written(state.mapInArrow(first, f"doc_id {kind}, text_hash long, ref long, n_bytes long, out {judge.sql}, z binary, covered {SPANS}, todo array<long>"), "substring-runs")
    open_texts = state.filter("todo is not null").select("ref", "z", "n_bytes", "todo")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words of each open run's stretch, and how many stand before the anchor."""
        for b in batches:
            rows = []
            for ref, z, n, todo in zip(*(column(b, c).to_pylist() for c in ("ref", "z", "n_bytes", "todo")), strict=True):
                lo, hi, of, mark = run_parts(np.array(todo, np.int64))
                if ((mark & WIDE) > 0).all():
                    continue
                data = inflated(z, n)
                (start, end), units = word_bounds(data), word_units(data)
                near = (mark & WIDE) == 0
                s = sums(units)
                seed = hashes(s, of, of + gram).view(np.int64)
                for i in np.flatnonzero(near).tolist():
                    rows.append({"seed": int(seed[i]), "ref": ref if not mark[i] & WHOLE else None, "at": int(of[i]), "before": int(of[i] - lo[i]), "words": data[start[lo[i]] : end[hi[i] + size - 1]]})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("seed", pa.int64()), ("ref", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("words", pa.binary())]))

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= EXTENDED:
                t = pa.Table.from_batches(held).combine_chunks()
                seed = t["seed"].to_numpy()
                cut = int(np.searchsorted(seed, seed[-1]))  # the last anchor's runs may go on
                if cut:
                    yield spans(t.slice(0, cut))
                held = t.slice(cut).to_batches()
                n = t.num_rows - cut
        if n:
            yield spans(pa.Table.from_batches(held).combine_chunks())

    def spans(t: pa.Table) -> pa.RecordBatch:
        texts = t["words"].to_pylist()
        flat, count = word_units(b"\n".join(texts)), np.array([len(word_bounds(x)[0]) for x in texts])
        zero, before, seed = np.cumsum(count) - count, t["before"].to_numpy().astype(np.int64), t["seed"].to_numpy().view(np.uint64)

        def side(step: np.ndarray) -> np.ndarray:
            place = before[:, None] + step[None, :]
            here = (place >= 0) & (place < count[:, None])
            return prefixes(flat[np.clip(place + zero[:, None], 0, len(flat) - 1)], seed, here)

        row, k, r = extended(seed, side(-1 - np.arange(size - gram)), side(np.arange(size)), size)
        asks = np.flatnonzero(t["ref"].is_valid().to_numpy()[row])
        row, k, r = row[asks], k[asks], r[asks]
        at = t["at"].to_numpy()[row].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(t["ref"].fill_null(0).to_numpy()[row]), pa.StructArray.from_arrays([pa.array((at - k).astype(np.int32)), pa.array((at + r).astype(np.int32))], fields=list(SPAN))], names=["ref", "span"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[Entries]:
        """The windows of runs whose anchor has very many stretches."""
        for b in batches:
            for ref, z, n, todo in zip(*(column(b, c).to_pylist() for c in ("ref", "z", "n_bytes", "todo")), strict=True):
                lo, hi, _, mark = run_parts(np.array(todo, np.int64))
                wide = (mark & WIDE) > 0
                if wide.any():
                    s = sums(word_units(inflated(z, n)))
                    for x, y, m in zip(lo[wide], hi[wide], mark[wide], strict=True):
                        at = np.arange(x, y + 1)
                        yield entries(ref, hashes(s, at, at + size), hashes(s, at, at + size // 2) >> np.uint64(48), at, int(not m & WHOLE))

    # a seed's runs together and in order, however many seeds a task has
    near = gathered(open_texts, contexts, "seed long, ref long, at int, before int, words binary").repartition("seed").sortWithinPartitions("seed")
    matches = near.mapInArrow(extend, "ref long, span struct<start:int,end:int>").groupBy("ref").agg(F.collect_list("span").alias("matches"))
    starts = met(open_texts, windows, block_repeats, judge_repeats, bits)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for z, n, covered, found_, at in zip(*(column(b, c).to_pylist() for c in ("z", "n_bytes", "covered", "matches", "values")), strict=True):
                out.append(judge(inflated(z, n), [(x["start"], x["end"]) for x in covered + (found_ or [])] + [(x, x + size) for x in at or []]))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), column(b, "text_hash"), pa.array(out, judge.arrow)], names=["doc_id", "text_hash", "out"])

    late = state.filter("covered is not null").select("doc_id", "text_hash", "ref", "z", "n_bytes", "covered").join(matches, "ref", "left").join(starts, "ref", "left")
    late = late.select("doc_id", "text_hash", "z", "n_bytes", "covered", "matches", "values").mapInArrow(final, f"doc_id {kind}, text_hash long, out {judge.sql}")
    return finished([state.filter("covered is null").select("doc_id", "text_hash", "out"), late])


def gathered(df: DataFrame, f: Callable, schema: str, rows: int = 20_000) -> DataFrame:
    """mapInArrow with small batches put together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in f(batches):
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return df.mapInArrow(run, schema)


def op10_substring(spark, sf_dir: str) -> DataFrame:
    out = remove(spark.read.parquet(f"{sf_dir}/documents.parquet"), 35, 10, digest=True)
    return out.select("doc_id", F.col("n").alias("n_words"), "n_removed", "kept_sha256")
