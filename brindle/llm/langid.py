"""Language identification: multinomial naive Bayes over hashed character n-grams, scored in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import column, table, written
from brindle.llm.quality import held_out

SIZES = (1, 2, 3, 4)
BITS = 17
BINS = 1 << BITS
#: What each bin counts before any text.
ALPHA = 0.1
#: At most about so many documents of a language are learnt from; chosen by a hash of their id.
MAX_TRAIN = 20_000
#: Languages whose vectors one matrix holds: BINS * LANGUAGES * 4 bytes are broadcast at most, 34 MB.
LANGUAGES = 64
#: A longer text is taken in pieces of at most so many characters; so many n-grams are looked up at once.
PIECE, SLICE = 1 << 19, 1 << 16
#: Log-probabilities are whole multiples of 1 / STEPS, so that sums don't depend on their order.
STEPS = 1 << 16


@cache
def letters() -> np.ndarray:
    """Whether each code point is a letter (Unicode category L)."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def pieces(text: str) -> Iterator[str]:
    """The text in pieces that end behind a non-letter, or at PIECE characters within a longer run of letters."""
    at = 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        while cut > at and text[cut - 1].isalpha():
            cut -= 1
        cut = cut if cut > at else at + PIECE
        yield text[at:cut]
        at = cut
    yield text[at:]


def gathered(texts: Iterator[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces of many texts, about PIECE characters at once, with the number of the text of each."""
    owners, held, size = [], [], 0
    for i, t in enumerate(texts):
        for p in pieces(t or ""):
            if held and size + len(p) > PIECE:
                yield owners, held
                owners, held, size = [], [], 0
            owners.append(i)
            held.append(p)
            size += len(p)
    if held:
        yield owners, held


def grams(held: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, the number of the piece and the bin of each n-gram, by piece. An n-gram lies within one word in
    lower case (a run of letters) and one blank on its two sides; a single blank is none.
    """
    lower = [p.lower() for p in held]
    points = np.frombuffer("".join(f"\0{p}\0" for p in lower).encode("utf-32-le"), np.uint32)
    letter = letters()[points]
    keep = letter.copy()  # of a run of other characters one stays, next to a letter
    keep[1:] |= letter[:-1]
    keep[:-1] |= letter[1:]
    piece = np.repeat(np.arange(len(lower), dtype=np.int32), [len(p) + 2 for p in lower])[keep]
    letter, code = letter[keep], np.where(letter, points, 0)[keep].astype(np.uint64)
    for n in SIZES:
        m = len(code) - n + 1
        if m <= 0:
            return
        whole = letter[:m].copy() if n == 1 else piece[:m] == piece[n - 1 :]
        for i in range(1, n - 1):
            whole &= letter[i : i + m]
        if n == 2:
            whole &= letter[:m] | letter[1:]
        at = np.flatnonzero(whole)
        key = np.full(len(at), n, np.uint64)
        for i in range(n):
            key = (key ^ code[at + i]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        yield piece[at], ((key * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int64)


def counted(train: DataFrame) -> DataFrame:
    """n of each lang and bin over all texts; a task keeps vectors of LANGUAGES languages at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            langs = column(b, "lang").to_pylist()
            for owners, held in gathered(t.as_py() for t in column(b, "text")):
                names = sorted({langs[i] for i in owners})
                number = {x: k for k, x in enumerate(names)}
                of = np.array([number[langs[i]] for i in owners])
                for piece, at in grams(held):
                    for k in np.unique(of[piece]).tolist():
                        got = np.bincount(at[of[piece] == k], minlength=BINS)
                        sums[names[k]] = got + sums.get(names[k], 0)
                if len(sums) > LANGUAGES:
                    yield from sent(sums)
                    sums = {}
        yield from sent(sums)

    def sent(sums: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], names=["lang", "bin", "n"])

    return train.select("lang", "text").mapInArrow(run, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def vectors(train: DataFrame) -> DataFrame:
    """lang and its log-probabilities in STEPS, as int32; a row for each language that has an n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for bins, n in zip(column(b, "bins"), column(b, "n"), strict=True):
                x = np.full(BINS, ALPHA)
                x[np.asarray(bins.values)] += np.asarray(n.values)
                out.append(np.rint(np.log(x / x.sum()) * STEPS).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([column(b, "lang"), pa.array(out, pa.binary())], names=["lang", "v"])

    # a group has a row for each of its bins, BINS at most
    each = counted(train).groupBy("lang").agg(F.collect_list(F.struct("bin", "n")).alias("x"))
    return each.select("lang", F.col("x.bin").alias("bins"), F.col("x.n").alias("n")).mapInArrow(run, "lang string, v binary")


def judged(docs: DataFrame, langs: list[str], prior: np.ndarray, matrix) -> DataFrame:
    """docs with best (a language), top (its log-probability in STEPS) and rest (the logarithm of the sum over all
    languages so far, less top, as a probability ratio), from what they were and from these languages.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = matrix.value
        for b in batches:
            total, found = np.tile(prior, (b.num_rows, 1)), np.zeros(b.num_rows, bool)
            for owners, held in gathered(t.as_py() for t in column(b, "text")):
                of = np.array(owners)
                for piece, at in grams(held):
                    for s in range(0, len(at), SLICE):
                        p = of[piece[s : s + SLICE]]
                        first = np.flatnonzero(np.diff(p, prepend=-1))
                        total[p[first]] += np.add.reduceat(m[at[s : s + SLICE]], first, axis=0, dtype=np.int64)
                        found[p[first]] = True
            if not b.num_rows:
                continue
            k = total.argmax(1)
            top = total[np.arange(len(k)), k]
            rest = np.exp((total - top[:, None]) / STEPS).sum(1)
            before, was, had = column(b, "top").to_numpy(zero_copy_only=False), column(b, "rest").to_numpy(zero_copy_only=False), np.asarray(column(b, "best").is_valid())
            old = np.where(had, np.nan_to_num(before), -(2.0**62))
            new, high = top > old, np.maximum(top, old)
            rest = rest * np.exp((top - high) / STEPS) + np.where(had, np.nan_to_num(was), 0) * np.exp((old - high) / STEPS)
            best = np.where(new, np.array(langs, object)[k], column(b, "best").to_numpy(zero_copy_only=False))
            out = {"best": pa.array(best, pa.string(), mask=~found), "top": pa.array(high, pa.float64(), mask=~found), "rest": pa.array(rest, pa.float64(), mask=~found)}
            yield pa.RecordBatch.from_arrays([out.get(c, column(b, c)) for c in names], names=names)

    names = docs.columns
    return docs.mapInArrow(run, docs.schema)


def identify(docs: DataFrame, mod: int = 4, rest: int = 2, most: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document.

    Learnt from text and lang of the documents outside the held-out remainder whose lang isn't null, at most about
    ``most`` of each language, by a hash of their id; each language's prior is its share of all of them. lang_pred is
    the likeliest language, of equal ones the first by code point; score its posterior probability. Texts that are
    null or have no letter, and all where nothing is learnt, get ``und`` and 0. A language in whose texts no letter
    stands isn't learnt. Repeated rows, null ids too, count and are judged each; an empty table gives no rows. Further
    columns are passed over. Each LANGUAGES languages are one step more over the same rows.
    """
    spark = docs.sparkSession
    learn = docs.filter(F.col("lang").isNotNull() & ~held_out(mod, rest))
    share = written(learn.groupBy("lang").agg(F.count(F.lit(1)).alias("docs")), "langid-share")
    # a written table tells its size: small, it is broadcast
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) * F.col("docs") < F.lit(most << 20)
    known = written(vectors(learn.select("doc_id", "lang", "text").join(share, "lang").filter(chosen)).join(share, "lang"), "langid-model")
    langs = sorted(r.lang for r in known.select("lang").collect())
    all_docs = known.agg(F.sum("docs")).first()[0] or 1
    out = docs.select("doc_id", held_out(mod, rest).alias("held_out"), "text", F.lit(None).cast("string").alias("best"), F.lit(None).cast("double").alias("top"), F.lit(None).cast("double").alias("rest"))

    def step(df: DataFrame, at: int) -> DataFrame:
        rows = sorted(known.filter(F.col("lang").between(langs[at], langs[min(at + LANGUAGES, len(langs)) - 1])).collect())
        prior = np.rint(np.log([r.docs / all_docs for r in rows]) * STEPS).astype(np.int64)
        matrix = np.stack([np.frombuffer(r.v, np.int32) for r in rows], axis=1)
        return judged(df, [r.lang for r in rows], prior, spark.sparkContext.broadcast(np.ascontiguousarray(matrix)))

    out = reduce(step, range(0, len(langs), LANGUAGES), out)
    return out.select("doc_id", "held_out", F.coalesce("best", F.lit("und")).alias("lang_pred"), F.coalesce(1 / F.col("rest"), F.lit(0.0)).alias("score"))


def op11_langid(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
