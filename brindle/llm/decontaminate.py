"""Benchmark decontamination: a prefix-filtered join of item-sized windows, in DataFrame operations alone."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import written

#: What isn't a word, once A-Z are in lower case.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: So many bytes of the benchmark's shingles or windows are broadcast; more go through a shuffled join.
MAX_BROADCAST = 32 << 20
#: Rows of a sieve, of 64 longs each: some 36 MB at most, however many tokens it is of.
SIEVE_ROWS = 1 << 16
#: A token of more places than this is dealt to several tasks, as is one of over a 100,000th of all places.
HOT = 1 << 20


def words(text: str) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.array_remove(F.split(lowered, GAP), "")


def shingles(w: Column, n: Column) -> Column:
    """(at, token) for each two words in a row, token being their hash; a text of one word has that word's."""
    pairs = F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.struct(i.alias("at"), F.xxhash64(F.get(w, i), F.get(w, i + 1)).alias("token")))
    return F.when(n >= 2, pairs).when(n == 1, F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(F.get(w, F.lit(0))).alias("token"))))


def windows_of(benchmark: DataFrame, size: int) -> DataFrame:
    """item, w (its words with blanks between) and len of each distinct window of each item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words("text").alias("words"))
    items = items.withColumn("n", F.size("words")).filter("n > 0").withColumn("len", F.least("n", F.lit(size)))
    items = items.select("item", "words", "len", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("len"))).alias("s"))
    return items.select("item", "len", F.array_join(F.slice("words", F.col("s") + 1, F.col("len")), " ").alias("w")).distinct()


def small(df: DataFrame, size: Column) -> bool:
    """Whether the rows' sizes are MAX_BROADCAST bytes at most, with 64 more for each row."""
    return (df.agg(F.sum(size + 64).alias("bytes")).first().bytes or 0) <= MAX_BROADCAST


def shingled(base: DataFrame, single: bool, *more: str) -> DataFrame:
    """token and at of each shingle of the documents, with the columns in more; single: of each lone word too.
    Rows are made one by one in generated code, not as an array of each document.
    """
    each = base.select("n_words", "words", *more, F.posexplode("words").alias("at", "word"))
    two = F.when(F.col("at") < F.col("n_words") - 1, F.xxhash64("word", F.get("words", F.col("at") + 1)))
    if single:
        return each.select("at", "n_words", *more, F.explode(F.array(two, F.xxhash64("word"))).alias("token")).filter("token is not null")
    return each.select("at", "n_words", *more, two.alias("token")).filter("token is not null")


def cells(token: Column) -> list[Column]:
    """The three bits of 4,096 that a token sets in its row of a sieve."""
    return [F.shiftright(token, at).bitwiseAND(F.lit(4095)).cast("int") for at in (16, 28, 40)]


def sieve(tokens: DataFrame) -> DataFrame:
    """row and bits (64 longs) of a blocked Bloom filter of the tokens, SIEVE_ROWS rows at most."""
    row = F.col("token").bitwiseAND(F.lit(SIEVE_ROWS - 1)).alias("row")
    each = tokens.select(row, F.explode(F.array(*cells(F.col("token")))).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)))
    longs = each.groupBy("row", F.shiftright("bit", 6).alias("cell")).agg(F.bit_or(one).alias("bits"))
    rows = longs.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("cell", "bits"))).alias("held"))
    return rows.select("row", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(F.try_element_at("held", i), F.lit(0).cast("long"))).alias("bits"))


def possible(each: DataFrame, tokens: DataFrame) -> DataFrame:
    """The rows whose token is among the tokens, and few others, without a shuffle of the rest."""
    held = each.join(F.broadcast(sieve(tokens)), F.col("token").bitwiseAND(F.lit(SIEVE_ROWS - 1)) == F.col("row"))
    for bit in cells(F.col("token")):
        held = held.filter(F.call_function("bit_get", F.get("bits", F.shiftright(bit, 6)), bit.bitwiseAND(F.lit(63))) == 1)
    return held.drop("row", "bits")


def dealt(each: DataFrame, prefix: DataFrame) -> DataFrame:
    """The rows of each joined to the prefixes of their token, of which frequent ones are dealt to several tasks."""
    total = prefix.select("token", "n").distinct().agg(F.sum("n")).first()[0] or 0
    hot = max(HOT, total // 100_000)  # so that under 100,000 tokens are
    shares = F.ceil(F.col("n") / hot).cast("int")
    frequent = prefix.filter(F.col("n") > hot).select("token", shares.alias("shares")).distinct()
    each = each.join(F.broadcast(frequent), "token", "left")
    each = each.withColumn("share", F.pmod(F.xxhash64("uid", "at"), F.coalesce("shares", F.lit(1))).cast("int")).drop("shares")
    return each.join(prefix.withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1))), ["token", "share"])


def occurrences(base: DataFrame, prefix: DataFrame, single: bool, size: int) -> DataFrame:
    """uid, start, len and w of each place in the documents where a window's prefix stands and all its words do. Where
    the prefixes outgrow a broadcast, places go through a sieve of their tokens and take the words around them along.
    """
    start = F.col("at") - F.col("offset")
    inside = (start >= 0) & (start + F.col("len") <= F.col("n_words"))
    each = shingled(base, single, "uid", "words")
    if small(prefix, F.octet_length("w")):
        tried, first = each.join(F.broadcast(prefix), "token"), F.lit(0)
    else:
        first = F.greatest(F.col("at") - (size - 1), F.lit(0))
        around = possible(each, prefix.select("token").distinct()).withColumn("words", F.slice("words", first + 1, F.lit(2 * size)))
        tried = dealt(around, prefix)
    equal = F.array_join(F.slice("words", start - first + 1, F.col("len")), " ") == F.col("w")
    return tried.filter(inside).filter(equal).select("uid", start.alias("start"), "len", "w")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, items and spans (start and length in words) of each document.

    Windows are ``window`` consecutive words of an item, or all of a shorter one. A window's tokens are its
    shingles of two words, by 64 bits of hash; the rarest over all documents is the prefix that an occurrence must
    hold, so documents are searched for those alone. A place gives the window's start; it must lie within the document,
    and all its words must be equal. Hit words are those inside any occurrence. Null and wordless texts hit nothing and
    wordless items have no windows; repeated documents are judged each; items of one id count once, a null
    item_id as an empty string. An empty benchmark hits nothing. Further columns are passed over.
    """
    base = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.xxhash64("text").alias("text_hash"), words("text").alias("words"))
    base = written(base.withColumn("n_words", F.size("words")), "decontaminate-words")
    items = written(windows_of(benchmark, window), "decontaminate-windows")

    unique = items.select("w", "len").distinct().withColumn("of", F.split("w", " "))
    tokens = unique.select("w", "len", F.inline(shingles(F.col("of"), F.col("len"))))
    vocabulary = written(tokens.select("token").distinct(), "decontaminate-tokens")
    single = not items.filter("len = 1").isEmpty()
    every = shingled(base, single)
    known = every.join(F.broadcast(vocabulary), "token") if small(vocabulary, F.lit(8)) else possible(every, vocabulary)
    counts = known.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    # a token that no document has rules its window out
    prefix = tokens.join(counts, "token", "left").groupBy("w", "len").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token", "at")).alias("p"))
    prefix = written(prefix.filter("p.n > 0").select("w", "len", F.col("p.token").alias("token"), F.col("p.at").alias("offset"), F.col("p.n").alias("n")), "decontaminate-prefix")

    hits = occurrences(base, prefix, single, window)
    hits = written(hits, "decontaminate-hits")
    spans = hits.groupBy("uid").agg(F.array_sort(F.collect_set(F.struct("start", "len"))).alias("spans"))
    named = hits.select("uid", "w").distinct().join(items.select("w", "item"), "w").groupBy("uid").agg(F.array_sort(F.collect_set("item")).alias("items"))
    seen = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, x: F.struct((a.n + F.greatest(x.start + x.len - F.greatest(a.end, x.start), F.lit(0))).alias("n"), F.greatest(a.end, x.start + x.len).alias("end")), lambda a: a.n,
    )
    out = base.select("uid", "doc_id", "text_hash", "n_words").join(spans, "uid", "left").join(named, "uid", "left")
    return out.select(
        "doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"), F.coalesce(seen, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", F.array().cast("array<struct<start:int,len:int>>")).alias("spans"),
    )


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    out = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
