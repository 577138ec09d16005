"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import column, written
from brindle.llm.quality import held_out

#: Words are runs of letters: ASCII bytes but letters part them, and so do other characters that no word holds.
PARTS = bytes(c if chr(c).isalpha() or c >= 0x80 else 0x20 for c in range(256))
OTHER = re.compile(r"[^\x00-\x7F\w]+")
#: Bounds of the sample that fits (by a hash of doc_id) and of the terms that the classifiers see. Terms are chosen by
#: counts over all documents that may be learnt from.
MAX_POSITIVE, MAX_UNLABELLED, MAX_TERMS, MIN_DOCS = 8_000, 16_000, 300, 5
#: So many labelled ids (by a hash) tell the positives among them: they are broadcast, so that no text is shuffled.
MAX_CONFIRMED = 1 << 19
#: A term is a word or, with a dash at its end, the beginning of longer ones, of so many bytes.
STEMS = (4, 5, 6)
#: The share of a text's words at which a term counts by half: where terms are chosen, and in the two inputs that a
#: classifier has for each, the first nearly whether the term is there at all.
HALF, LOW, HIGH = 0.004, 0.0005, 0.01
#: What a task counts at once (so many bytes or texts), and the sums of terms that it keeps before it sends them.
SLICE, ROWS, KEPT = 8 << 20, 4_000, 1 << 20
#: Classifiers, each fitted in a task of its own on three quarters of the sample; their scores are averaged.
MODELS, EPOCHS, RATE, DECAY = 3, 600, 0.1, 1e-4


def terms(words: pa.Array, vocabulary: pa.Array | None) -> tuple[pa.Array, np.ndarray]:
    """Names of terms (the vocabulary, or all that the words have, if there is none) and, for each word, the numbers of
    itself and of its beginnings, -1 for what it hasn't.
    """
    length, least = pc.binary_length(words).to_numpy(), (0, *STEMS)
    rows = [np.flatnonzero(length > c) for c in least]
    starts = [pc.binary_join_element_wise(pc.binary_slice(words.take(pa.array(r)), 0, c), b"-", b"") for r, c in zip(rows[1:], STEMS, strict=True)]
    found = pa.concat_arrays([words.take(pa.array(rows[0])), *starts])
    if vocabulary is None:
        coded = found.dictionary_encode()
        names, number = coded.dictionary, coded.indices.to_numpy()
    else:
        names, number = vocabulary, pc.fill_null(pc.index_in(found, value_set=vocabulary), -1).to_numpy()
    out = np.full((len(words), len(least)), -1, np.int64)
    out[np.concatenate(rows), np.repeat(np.arange(len(least)), list(map(len, rows)))] = number
    return names, out


def slices(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The words of the texts, lower-cased and parted by blanks, for SLICE bytes or ROWS texts at once (a longer text by
    itself), each with the number of its first text.
    """
    first, size, out = 0, 0, []
    for i, t in enumerate(texts):
        text = OTHER.sub(" ", (t.as_py() or "").lower()).encode().translate(PARTS).strip()
        if out and (size + len(text) > SLICE or len(out) >= ROWS):
            yield first, out
            first, size, out = i, 0, []
        out.append(text)
        size += len(text)
    if out:
        yield first, out


def counts(texts: list[bytes], vocabulary: pa.Array | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names of terms; text, term and how often the text holds it, once for each such pair; and each text's number of
    words.
    """
    split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
    words, length = split.flatten().dictionary_encode(), split.value_lengths().to_numpy()
    names, numbers = terms(words.dictionary.cast(pa.binary()), vocabulary)
    text, code = np.repeat(np.arange(len(texts)), length), words.indices.to_numpy()
    has = (numbers >= 0).any(1)[code]
    of = max(len(numbers), 1)
    pair, k = np.unique(text[has] * of + code[has], return_counts=True)
    text, code = np.divmod(pair, of)
    row, place = np.nonzero(numbers[code] >= 0)
    of = max(len(names), 1)  # words of a text may share a beginning
    pair, place = np.unique(text[row] * of + numbers[code[row], place], return_inverse=True)
    nothing = [not t for t in texts]  # splits into one empty word
    return names, *np.divmod(pair, of), np.bincount(place, k[row], len(pair)), np.where(nothing, 0, length)


def inputs(texts: pa.Array, vocabulary: pa.Array) -> Iterator[np.ndarray]:
    """Rows of two inputs for each term of the vocabulary, and a 1 for the bias; some rows at once."""
    width = len(vocabulary)
    for _, some in slices(texts):
        _, text, term, k, n = counts(some, vocabulary)
        x = np.zeros((len(some), 2 * width + 1), np.float32)
        x[text, term], x[text, term + width], x[:, -1] = k / (k + LOW * n[text]), k / (k + HIGH * n[text]), 1
        yield x


def chances(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> np.ndarray:
    """Weights (the last is the bias) that minimise the non-negative risk of the logistic loss by Adam.

    risk = prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)]); where the second part is below 0, the step
    goes up it instead, so that the classifier doesn't fit unlabelled examples as negatives beyond the prior.
    """
    width = positive.shape[1]
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, EPOCHS + 1):
        zp, zu = positive @ w.astype(np.float32), unlabelled @ w.astype(np.float32)
        negative = np.logaddexp(0, zu, dtype=np.float64).mean() - prior * np.logaddexp(0, zp, dtype=np.float64).mean()
        sp, su = chances(zp), chances(zu)
        of_negative = (su @ unlabelled) / len(zu) - prior * (sp @ positive) / len(zp)
        g = prior * ((sp - 1) @ positive) / len(zp) + of_negative if negative >= 0 else -of_negative
        g = g.astype(np.float64)
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def parting(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The logit from which on missed positives and flagged negatives, each as a share of its class, are fewest; the
    negatives' share is that of unlabelled text without what the prior puts down to positives.
    """
    at = np.unique(positive)
    missed = np.searchsorted(np.sort(positive), at) / len(positive)
    flagged = 1 - np.searchsorted(np.sort(unlabelled), at) / len(unlabelled)
    loss = missed + np.maximum(flagged - prior * (1 - missed), 0) / (1 - prior)
    best = np.flatnonzero(loss <= loss.min() + 1e-9)
    return float(at[best[len(best) // 2]])


def told(texts: DataFrame) -> DataFrame:
    """term, p, u and docs: what each term weighs in the positives (p = 1) and in all texts, and how many hold it."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rows = [], 0
        for b in batches:
            positive = column(b, "p").to_numpy()
            for first, some in slices(column(b, "text")):
                names, text, term, k, n = counts(some)
                weight = k / (k + HALF * n[text])
                p, u, docs = (np.bincount(term, w, len(names)) for w in (weight * positive[first + text], weight, None))
                kept.append(pa.table({"term": names, "p": p, "u": u, "docs": docs}))
                rows += len(names)
                if rows > KEPT:
                    kept = [added(kept)]
                    rows = len(kept[0])
                    if rows > KEPT / 2:
                        yield from kept[0].to_batches()
                        kept, rows = [], 0
        if kept:
            yield from added(kept).to_batches()

    def added(parts: list[pa.Table]) -> pa.Table:
        out = pa.concat_tables(parts).group_by("term", use_threads=False).aggregate([(c, "sum") for c in ("p", "u", "docs")])
        return pa.table({"term": out["term"], **{c: out[f"{c}_sum"] for c in ("p", "u", "docs")}})

    return texts.mapInArrow(sums, "term binary, p double, u double, docs long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("u").alias("u"), F.sum("docs").alias("docs"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, mod: int = 3, rest: int = 1) -> DataFrame:
    """doc_id, held_out, score and predicted of each document.

    Confirmed toxic documents outside the held-out remainder (a draw of MAX_CONFIRMED, where there are more) are the
    positives; a draw of all documents outside it, confirmed ones too, is the unlabelled text. The class prior is the
    share of toxic labels there. Each classifier's bias puts the threshold where it parts the quarter of the sample
    that it wasn't fitted on best. The classifiers see how often a whole text holds each of MAX_TERMS words and
    beginnings of words: those whose weight differs most between the positives and all documents that may be learnt
    from. Null labels don't count; a document with several labels is positive if one is. Null and empty texts have no
    words and score as the bias says. Without positives the score is 0, or 1 if all labels are toxic. Repeated rows are
    scored each; an empty table gives no rows. Further columns are passed over.
    """
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out(mod, rest))
    prior = known.agg(F.avg("toxic")).first()[0]
    vocabulary, models = pa.array([], pa.binary()), []
    if prior and prior < 1:
        draw = lambda salt, most, of: F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1_000_000)) < int(1e6 * min(1, most / max(of, 1)))
        confirmed = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("toxic = 1").select("doc_id", F.lit(1).alias("p"))
        confirmed = written(confirmed, "toxicity-confirmed")
        confirmed = confirmed.filter(draw("confirmed", MAX_CONFIRMED, confirmed.count()))
        learnt = docs.select("doc_id", "text").filter(~held_out(mod, rest)).join(F.broadcast(confirmed), "doc_id", "left").select("doc_id", "text", F.coalesce("p", F.lit(0)).alias("p"))
        n = learnt.agg(F.sum("p").alias("p"), F.count(F.lit(1)).alias("u")).first()
        if n.p:
            apart = F.abs(F.col("p") / n.p - F.col("u") / n.u) / F.sqrt((F.col("p") + F.col("u")) / (n.p + n.u) + 1 / n.p)
            top = told(learnt.select("p", "text")).filter(F.col("docs") >= MIN_DOCS).orderBy(apart.desc(), "term").limit(MAX_TERMS).select("term").collect()
            vocabulary = pa.array([bytes(r.term) for r in top], pa.binary())

            def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    x = [row.tobytes() for some in inputs(column(b, "text"), vocabulary) for row in some]
                    yield pa.RecordBatch.from_arrays([column(b, "part"), column(b, "p"), column(b, "drawn"), pa.array(x, pa.binary())], names=["part", "p", "drawn", "x"])

            def train(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
                """Fits on all parts but one, and puts the score that parts best there at the threshold."""
                x, p, u = np.stack([np.frombuffer(x, np.float32) for x in pdf.x]), pdf.p.to_numpy() == 1, pdf.drawn.to_numpy()
                own = pdf.part.to_numpy() == key[0]
                if not (p & ~own).any() or not (u & ~own).any():
                    return pd.DataFrame({"w": [[0.0] * (x.shape[1] - 1) + [float(np.log(prior / (1 - prior)))]]})
                w = fit(x[p & ~own], x[u & ~own], prior)
                if (p & own).any() and (u & own).any():
                    w[-1] += np.log(threshold / (1 - threshold)) - parting(x[p & own] @ w, x[u & own] @ w, prior)
                return pd.DataFrame({"w": [w.tolist()]})

            part = F.pmod(F.xxhash64("doc_id", F.lit("bag")), F.lit(MODELS + 1)).cast("int")
            sample = learnt.select("text", part.alias("part"), ((F.col("p") == 1) & draw("positive", MAX_POSITIVE, n.p)).cast("int").alias("p"), draw("unlabelled", MAX_UNLABELLED, n.u).alias("drawn")).filter("p = 1 or drawn")
            sample = written(sample.mapInArrow(vectors, "part int, p int, drawn boolean, x binary"), "toxicity-sample")
            dealt = sample.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(MODELS - 1))))
            models = [np.array(r.w) for r in dealt.groupBy("model").applyInPandas(train, "w array<double>").collect()]
    constant = float(prior or 0)
    stack = np.stack(models, 1) if models else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = np.full(b.num_rows, constant)
            if stack is not None and b.num_rows:
                out = np.concatenate([chances(x @ stack).mean(1) for x in inputs(column(b, "text"), vocabulary)])
            yield pa.RecordBatch.from_arrays([column(b, "doc_id"), pa.array(out)], names=["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, score double")
    return out.select("doc_id", held_out(mod, rest).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
