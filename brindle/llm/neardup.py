"""Near-duplicates: SetSketch registers are banded, estimated jointly by likelihood, and verified on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brindle.llm.common import column, mixed, written
from brindle.llm.repeats import hashes, sums, text_bytes, word_units

SHINGLE = 5
#: Registers of a sketch, floor(1 - log_B(x)) of minima x of exponentials of rate A; at B near 1 two of them are
#: equal with a probability of about the Jaccard similarity.
REGISTERS, B, A = 192, 1.001, 20.0
#: Bands and registers of each. At a similarity of 0.75, 32 bands of 3 miss a pair once in 4e7.
BANDS, ROWS = 32, 3
#: Rounds in which what is still apart in a bucket is paired with two of the bucket's largest component.
ROUNDS = 1
#: Pairs that the registers put so far below the threshold, over five standard errors, aren't verified.
SLACK = 0.17
#: Words of 64 bits of a set's parities.
WORDS = 8
#: Tasks over which what one component holds is dealt.
SALTS = 16
#: Keys of a bucket that are put in order together.
TOGETHER = 20_000
#: Classes of a bucket's lesser components that one task compares with the others; more are dealt to several tasks.
FREQUENT = 128

_RNG = np.random.default_rng(20)
FACTORS = _RNG.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RNG.integers(0, 1 << 63, REGISTERS, np.uint64) * np.uint64(2)


def shingles(data: bytes) -> np.ndarray:
    """Distinct hashes of each five words in a row, A-Z in lower case; all words of a shorter text as one."""
    words = word_units(data.lower())
    if not len(words):
        return words
    k, s = min(SHINGLE, len(words)), sums(words)
    at = np.arange(len(words) - k + 1)
    return np.unique(hashes(s, at, at + k) if k == SHINGLE else mixed(hashes(s, at, at + k) + np.uint64(k)))


def sketch(h: np.ndarray) -> np.ndarray:
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(h), 2048):
        np.minimum(low, (h[at : at + 2048, None] * FACTORS + SHIFTS).min(0), out=low)
    x = -np.log1p(-np.minimum((low.astype(np.float64) + 1) / 2.0**64, 1 - 1e-16)) / A
    return np.clip(np.floor(1 - np.log(x) / np.log(B)), 0, 65535).astype(np.uint16)


def key_of(h: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    return np.array([mixed(h).sum(), mixed(h ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum()], np.uint64).tobytes()


def parities(h: np.ndarray) -> np.ndarray:
    """Whether an odd number of hashes falls on each of 64 * WORDS bits: two sets differ in as many as these, or more."""
    return np.packbits(np.bincount((h % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1).view(np.int64)


def bands(k: np.ndarray) -> np.ndarray:
    rows = k[: BANDS * ROWS].reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(len(rows), dtype=np.uint64)
    for i in range(ROWS):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return out.view(np.int64)


def likeliest(ka: np.ndarray, kb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The similarities (of a grid) under which the registers' order is likeliest, given the sets' sizes."""
    up, down = (ka > kb).sum(1)[:, None], (ka < kb).sum(1)[:, None]
    u = (na / (na + nb))[:, None]
    j = np.linspace(0, 1, 101)[None, :] * np.minimum(u / (1 - u), (1 - u) / u)
    p = lambda x: np.clip(-np.log1p(-x * (B - 1) / B) / np.log(B), 1e-12, 1)
    a, b = p(u - (1 - u) * j), p((1 - u) - u * j)
    fit = up * np.log(a) + down * np.log(b) + (ka.shape[1] - up - down) * np.log(np.clip(1 - a - b, 1e-12, 1))
    return j[np.arange(len(j)), fit.argmax(1)]


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, ref, n and key of each document; registers and bands where its task meets a set first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            n, keys, registers, in_bands = [], [], [], []
            for t in column(b, "text"):
                h = shingles(text_bytes(t))
                n.append(len(h))
                key = key_of(h) if len(h) else None
                keys.append(key)
                new = key is not None and key not in seen
                seen.add(key)
                k = sketch(h) if new else None
                registers.append(k.tobytes() if new else None)
                in_bands.append(bands(k) if new else None)
            yield pa.RecordBatch.from_arrays([*(column(b, c) for c in ("doc_id", "text_hash", "ref")), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(registers, pa.binary()), pa.array(in_bands, pa.list_(pa.int64()))], names=["doc_id", "text_hash", "ref", "n", "key", "registers", "bands"])

    kind = dict(docs.dtypes)["doc_id"]
    return written(docs.mapInArrow(run, f"doc_id {kind}, text_hash long, ref long, n long, key binary, registers binary, bands array<long>"), "near-sketches")


def sets_of(docs: DataFrame, refs: DataFrame) -> DataFrame:
    """key, bits and the whole set of the documents in refs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(text_bytes(t)) for t in column(b, "text")]
            yield pa.RecordBatch.from_arrays([column(b, "key"), pa.array([h.tobytes() for h in sets], pa.binary()), pa.array([parities(h) for h in sets], pa.list_(pa.int64()))], names=["key", "set", "bits"])

    return written(docs.select("ref", "text").join(refs, "ref").select("key", "text").mapInArrow(run, "key binary, set binary, bits array<long>").dropDuplicates(["key"]), "near-sets")


def verified(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, estimate: bool = True) -> DataFrame:
    """The pairs (a, b) of set keys whose sets are so similar: by their registers, if estimate, and then exactly."""

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                ka, kb = (np.frombuffer(b"".join(column(b, c).to_pylist()), np.uint16).reshape(b.num_rows, -1).astype(np.int32) for c in ("ra", "rb"))
                est = likeliest(ka, kb, *(column(b, c).to_numpy().astype(float) for c in ("na", "nb")))
                yield b.filter(pa.array(est >= percent / 100 - SLACK)).select(["a", "b"])

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(column(b, "sa"), column(b, "sb"), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    side = lambda c: classes.select(F.col("key").alias(c), F.col("n").alias(f"n{c}"), F.col("registers").alias(f"r{c}"))
    close = pairs
    if estimate:
        known = pairs.join(side("a"), "a").join(side("b"), "b").filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
        close = written(known.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(likely, "a binary, b binary"), "near-likely")
    full = close.join(sets.select(F.col("key").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("key").alias("b"), F.col("set").alias("sb")), "b")
    return written(full.select("a", "b", "sa", "sb").mapInArrow(exact, "a binary, b binary"), "near-links")


def components(links: DataFrame) -> DataFrame:
    """key and component (its smallest key) of all keys in links (a, b), by rounds of large and small stars."""
    edges = written(links.select("a", "b").filter("a != b").distinct(), "near-stars")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = None
    while (now := mark(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, as Spark splits a hub's rows in a join of tables, but not in one with an aggregate
        least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "near-least")
        large = both.filter(F.col("b") > F.col("a")).join(least, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "near-large")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "near-least")
        small = large.join(least, "a")
        small = small.select("a", F.col("m").alias("b")).union(small.filter(F.col("b") != F.col("m")).select("b", "m"))
        edges = written(small.distinct(), "near-stars")
    roots = edges.select(F.col("b").alias("key")).distinct().withColumn("component", F.col("key"))
    return edges.select(F.col("a").alias("key"), F.col("b").alias("component")).unionByName(roots)


def apart(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """bucket, key, component and main (the bucket's largest component) of the buckets of several components."""
    at = buckets.select("bucket", "key", "n").join(found, "key", "left").select("bucket", "key", "n", F.coalesce("component", "key").alias("component"))
    main = at.groupBy("bucket", "component").count().groupBy("bucket").agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
    main = written(main.filter("parts > 1").select("bucket", "main"), "near-several")
    return written(at.join(main, "bucket").select("bucket", "key", "n", "component", "main"), "near-apart")


def answered(keys: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The keys (key, n, component) of which other components hold so many hundredths of the shingles, with that number:
    a link to another component shares no fewer.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, x in enumerate(column(b, "set")):
                h = np.frombuffer(x.as_py(), np.int64)
                for base in range(0, len(h), 50_000):
                    part = h[base : base + 50_000]
                    one = pa.array(np.full(len(part), i))
                    yield pa.RecordBatch.from_arrays([*(column(b, c).take(one) for c in ("key", "of")), pa.array(part)], names=["key", "of", "hash"])

    every = keys.join(sets, "key").select("key", F.xxhash64("component").alias("of"), "set")
    every = written(every.mapInArrow(run, "key binary, of long, hash long"), "near-shingles")
    several = every.groupBy("hash").agg(F.min("of").alias("least"), F.max("of").alias("most")).filter("least < most").select("hash")
    # written, so that Spark can split a frequent shingle's rows
    held = every.join(written(several, "near-common"), "hash").groupBy("key").agg(F.count(F.lit(1)).alias("held"))
    return written(keys.join(held, "key").filter(100 * F.col("held") >= percent * F.col("n")).select("key", "n", "component", "held"), "near-answered")


def compared(keys: DataFrame, sets: DataFrame, percent: int, buckets: DataFrame | None = None) -> DataFrame:
    """Rows of two keys (key, other) of different components that share one of the buckets (bucket, key; if None, all
    do) and are of neighbouring sizes. What can't be linked to another component is left out before.
    """
    some = answered(keys, sets, percent)
    rows = some.withColumn("bucket", F.lit(0).cast("long")) if buckets is None else some.join(buckets.select("key", "bucket"), "key")
    # sets of the similarity asked for are of one range of sizes or of ranges side by side
    step = F.floor(F.log(F.col("n")) / F.lit(np.log(100 / percent) + 1e-9)).cast("int")
    rows = written(rows.withColumn("range", step), "near-open")
    by_part = rows.groupBy("bucket", "component").count()
    main = by_part.groupBy("bucket").agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.count(F.lit(1)).alias("parts")).filter("parts > 1")
    rows = rows.join(written(main.select("bucket", "main"), "near-mains"), "bucket").join(sets.select("key", "bits"), "key")
    rows = written(rows, "near-open-bits")
    minor = rows.filter("component != main").withColumn("range", F.explode(F.array(F.col("range") - 1, "range", F.col("range") + 1)))
    # what a bucket holds outside its main component is dealt to several tasks, to each of which the others go
    dealt = written(minor.groupBy("bucket", "range").agg(F.ceil(F.count(F.lit(1)) / FREQUENT).alias("parts")), "near-parts")
    minor = minor.join(dealt, ["bucket", "range"]).withColumn("part", F.pmod(F.xxhash64("key"), "parts"))
    minor = minor.select("bucket", "range", "part", F.col("key").alias("other"), F.col("component").alias("of"), F.col("n").alias("size"), F.col("held").alias("helds"), F.col("bits").alias("others"))
    each = rows.join(dealt, ["bucket", "range"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return each.join(minor, ["bucket", "range", "part"]).filter(F.col("component") != F.col("of"))


def meeting(keys: DataFrame, sets: DataFrame, percent: int, buckets: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of different components that share a bucket and whose sizes, shingles held elsewhere and bits don't rule
    them out.
    """
    alike = 100 * F.least("n", "size") >= percent * F.greatest("n", "size")
    both = F.col("n") + F.col("size")
    differ = sum((F.bit_count(F.col("bits")[i].bitwiseXOR(F.col("others")[i])) for i in range(WORDS)), F.lit(0))
    # what they share is no more than what other components hold of either
    enough = ((100 + percent) * F.least("held", "helds") >= percent * both) & ((100 + percent) * (both - differ) >= 2 * percent * both)
    return compared(keys, sets, percent, buckets).filter(alike & enough).select(*pair("key", "other")).distinct()


def pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def groups(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept of each document.

    Documents are linked where their sets of shingles share so many hundredths of their union; component_id is the
    smallest doc_id that links reach. Documents of one set are one class from the start. In each bucket of a band
    every class is paired with a few others. Classes whose bucket still holds several components, and of whose shingles
    other components hold enough, are then compared with all others of the bucket under bounds of size and parity bits,
    and what is left in full: no link between components of one bucket is lost. Two classes that share no bucket aren't compared; at a
    similarity of 0.75 that befalls a pair once in 4e7.
    Texts without words, null ones too, have no shingles and stand alone. Null ids are passed over when the smallest
    is sought; repeated rows share a component and are all kept if one is; an empty table gives no rows. Further
    columns are passed over. Shingles are compared by 64 bits of hash, classes by 128.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.xxhash64("doc_id", "text").alias("ref"), "text")
    each = sketched(docs)
    classes = each.filter("registers is not null").groupBy("key").agg(F.min(F.struct("ref", "n", "registers", "bands")).alias("x")).select("key", "x.*")
    classes = written(classes, "near-every")
    buckets = classes.select("key", "n", "ref", F.posexplode("bands").alias("band", "hash")).select(F.xxhash64("band", "hash").alias("bucket"), "key", "n", "ref")
    shared = buckets.groupBy("bucket").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("held")).filter("held > 1")
    # a bucket of very many keys is put in order by parts
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("held") / TOGETHER)).alias("part")
    buckets = written(buckets.join(written(shared, "near-shared"), "bucket").select("bucket", "key", "n", "ref", "first", part), "near-buckets")
    near = buckets.select("key", "ref").distinct()
    classes = written(classes.select("key", "n", "registers").join(near.select("key"), "key", "left_semi"), "near-classes")
    sets = sets_of(docs, near)

    # in each bucket, of however many classes: with the first of all, and with the one before in order of keys
    before = F.lag("key").over(Window.partitionBy("bucket", "part").orderBy("key"))
    tried = buckets.withColumn("before", before).select("key", F.explode(F.array("first", "before")).alias("other")).filter("key != other").select(*pair("key", "other")).distinct()
    links = verified(tried, classes, sets, percent)
    found = components(links)
    for k in range(ROUNDS):
        at = apart(buckets, found)
        if at.isEmpty():
            break
        # a few of the largest component for each class outside it, others in each round
        order = F.struct(F.xxhash64("key", F.lit(k)), "key")
        some = at.filter("component = main").groupBy("bucket").agg(F.array(F.min(order), F.max(order)).alias("some"))
        few = at.filter("component != main").join(written(some, "near-some"), "bucket").select("key", F.explode("some").alias("x")).select("key", F.col("x.key").alias("other"))
        more = verified(few.select(*pair("key", "other")).distinct(), classes, sets, percent)
        links = found.select(F.col("key").alias("a"), F.col("component").alias("b")).unionByName(more)
        found = components(links)
    # what is left, across components: the pairs of a bucket's keys that no bound rules out, so no link is lost
    at = apart(buckets, found)
    if not at.isEmpty():
        rest = meeting(at.select("key", "n", "component").distinct(), sets, percent, at)
        more = verified(rest, classes, sets, percent, estimate=False)
        found = components(found.select(F.col("key").alias("a"), F.col("component").alias("b")).unionByName(more))

    named = each.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = named.join(found, "key", "left").select("key", "least", F.coalesce("component", "key").alias("component"))
    # a component of very many classes is dealt to SALTS tasks
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    smallest = written(named.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")), "near-components")
    several = smallest.filter("n > 1").select("component", "component_id", salts.alias("salt"))
    label = named.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS))).join(several, ["component", "salt"], "left").select("key", F.coalesce("component_id", "least").alias("component_id"))
    out = each.join(label, "key", "left").withColumn("component_id", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op7_neardup(spark, sf_dir: str) -> DataFrame:
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("text_hash")
