"""Personal data: exact base patterns, and bootstrapped contextual extraction of further identifiers."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import column, joined, unused, written

#: The base kinds in the order in which spans that start together are listed.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# No digit can stand before a leftmost match, and none of its runs can give one back: possessive, so that a long
# run of digits is read once.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: What may be an identifier: numbers with blanks between, or an unbroken string with four digits, or a digit and a
#: letter, or an at or underscore.
PIECE = r"\(?[0-9][0-9()./-]*+"
SPACED = re.compile(rf"(?<![\w.+/-])\+?{PIECE}(?:[\x20\xA0]{PIECE})+(?!\w)")
TOKEN = re.compile(r"(?<!\S)[^\s0-9@_]*+[0-9@_]\S*+")
LETTER = re.compile(r"[^\W\d_]")
EDGE = ".,;:!?()[]{}<>\"'*#%$&|"
MIN_DIGITS, MIN_LENGTH, MAX_LENGTH = 4, 6, 80
#: A value behind a key name, as in ``key = "value"``, and what stands before it.
VALUE = re.compile(r"[:=]{1,2}[\x20\t]{0,2}[\"'`]?([^\s\"'`<>/][^\s\"'`<>]*+)")
KEY = re.compile(r"([^\W\d_][\w.-]{0,39})[\x20\t]{0,2}([:=]{1,2})[\x20\t]{0,2}[\"'`]?$")
#: A string of letters and digits mixed that is long enough to be a secret: a seed of a kind of its own.
SECRET, MAX_SECRET = re.compile(r"(?=[^0-9]*[0-9][^0-9]*[0-9][^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z][^A-Za-z]*[A-Za-z][^A-Za-z]*[A-Za-z])[A-Za-z0-9_-]{20,}"), 256
#: Ways in which a card's digits stand in groups.
GROUPS = re.compile(r"[0-9]{14,19}(?![0-9])|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])(?:\1[0-9]{1,3}(?![0-9]))?")
#: A context is a pattern once so many different seeds share it; one this precise discovers.
MIN_SUPPORT, MIN_SCORE, ROUNDS = 3, 0.8, 3


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def small(part: str) -> bool:
    return len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of each base match, in code points, by start and kind."""
    out = []
    at, floor = text.find("@"), 0
    while at >= 0:
        start = at
        while start > floor and LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, 0, m.end()))
            floor = m.end()
        else:
            floor = at + 1  # what stands before can't reach a later @
        at = text.find("@", max(at + 1, floor))
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(small, m[0].split(".")))]
    for kind, pattern, least, most in ((2, CARD, 14, 19), (3, PHONE, 10, 15)):
        if kind == 3 and "+" not in text:
            continue
        for m in pattern.finditer(text):
            if m.end() - m.start() >= least and least <= len(d := "".join(DIGIT.findall(m[0]))) <= most and (kind == 3 or luhn(d)):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def sure_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Like base_spans, of what proves itself in runs that a base pattern took as one and dropped: two or more cards in
    a row, each in one group or in fours, each valid and with nothing between but a separator; and a phone that only a
    base match right behind it made too long.
    """
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() > 28 and (20 <= len(DIGIT.findall(m[0]))):
            found, at = [], m.start()
            while at < m.end() and (g := GROUPS.match(text, at, m.end())) and luhn("".join(DIGIT.findall(g[0]))):
                found.append((at, 2, g.end()))
                at = g.end() + 1
            if at == m.end() + 1 and len(found) > 1:
                out += found
    if "+" in text:
        starts = [a for a, _, _ in base]
        for m in PHONE.finditer(text):
            if len(DIGIT.findall(m[0])) > 15 and (i := bisect_left(starts, m.start() + 1)) < len(starts) and starts[i] < m.end():
                end = m.start() + len(text[m.start() : starts[i]].rstrip(" ().-"))
                if 10 <= len(DIGIT.findall(text, m.start(), end)) <= 15 and (i == 0 or base[i - 1][2] <= m.start()):
                    out.append((m.start(), 3, end))
    return sorted(out)


def trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """Without the marks around it, but with a bracket that opens for one that closes inside."""
    s = text[a:b]
    first, b = a + len(s) - len(s.lstrip(EDGE)), a + len(s.rstrip(EDGE))
    inside = text[first:b].partition(")")
    if first > a and text[first - 1] == "(" and inside[1] and "(" not in inside[0]:
        first -= 1
    return first, b


def like(s: str) -> bool:
    """Whether it has the length and signs of an identifier."""
    if not MIN_LENGTH <= len(s) <= MAX_LENGTH:
        return False
    n = len(DIGIT.findall(s))
    return n >= MIN_DIGITS or bool(LETTER.search(s)) and (n > 0 or "@" in s or "_" in s)


def failed(s: str) -> bool:
    """Whether a string outside all base matches is of the form of one, but not of its numbers or length."""
    digits = (DIGIT.findall(m[0]) for m in CARD.finditer(s))
    return bool(IP.search(s) or PHONE.search(s)) or any(len(d) >= 14 and not (len(d) <= 19 and luhn("".join(d))) for d in digits)


def free(spans: Iterable[tuple[int, int]], taken: list[tuple[int, int]], most: int) -> Iterator[tuple[int, int]]:
    """The spans that overlap none of taken; both by start, at most so many of taken in one place."""
    at = 0
    for a, b in spans:
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if not any(x < b and a < y for x, y in taken[at : at + most]):
            yield a, b


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str]]:
    """start, end and kind of each string outside the base matches that looks like an identifier (empty, or secret), and
    of those behind key names that don't (plain). Numbers with blanks between are one string, unless it is too long or
    has more digits than any base kind.
    """
    taken = [(a, b) for a, _, b in base]
    values = [(a, b) for a, b in free((trimmed(text, *m.span(1)) for m in VALUE.finditer(text)), taken, len(KINDS)) if KEY.search(text, max(0, a - 46), a)]
    spaced = [(a, b) for a, b in free((trimmed(text, *m.span()) for m in SPACED.finditer(text)), taken, len(KINDS)) if b - a <= MAX_LENGTH and len(DIGIT.findall(text[a:b])) <= 19]
    tokens = free(free((trimmed(text, *m.span()) for m in TOKEN.finditer(text)), taken, len(KINDS)), spaced, 2)
    marked = [(a, b) for a, b in values if like(text[a:b]) or SECRET.fullmatch(text, a, b)]
    for a, b in (*free(spaced, marked, 2), *marked, *free(tokens, marked, 2)):
        if b - a <= MAX_SECRET and SECRET.fullmatch(text, a, b):
            yield a, b, "secret"
        elif like(s := text[a:b]) and not failed(s):
            yield a, b, ""
    for a, b in values:
        if a < b <= a + MAX_LENGTH and not like(text[a:b]) and not SECRET.fullmatch(text, a, b):
            yield a, b, "plain"


def places(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str, str, list[str]]]:
    """start, end, kind (empty: not known), instance and lexical contexts of each identifier-like string: the two
    words before it, the words on its two sides, and the key name and sign before it. Of values that don't
    look like identifiers (plain), the last alone.
    """
    found = [(a, b, KINDS[k]) for a, k, b in base] + [(a, b, kind) for a, b, kind in candidates(text, base)]
    last = -1
    for a, b, kind in sorted(found):
        if (a, b) == last:
            continue
        last = (a, b)
        left, right = text[max(0, a - 60) : a].lower().split(), text[b : b + 60].lower().split()
        l1, l2, r1 = (left or ["^"])[-1], (["^", "^", *left])[-2], (right or ["$"])[0]
        contexts = [] if kind == "plain" else [f"L {l2} {l1}"] * bool(LETTER.search(l2 + l1)) + [f"B {l1} _ {r1}"] * bool(LETTER.search(l1 + r1))
        if key := KEY.search(text, max(0, a - 46), a):
            contexts.append(f"K {key[1].lower()} {key[2]}")
        if contexts:
            yield a, b, kind, text[a:b], contexts


def scored(edges: DataFrame) -> DataFrame:
    """kind of each instance that the patterns discover, from edges (pattern, instance, kind).

    Seeds (the base kinds, what proves itself, and secrets) score 1, plain ones always 0. In each round a pattern scores
    the mean of its instances' scores, where at least MIN_SUPPORT different ones score at all, and an instance that is
    not known yet the largest score of its patterns from MIN_SCORE on. A secret is a seed by its form alone, so it too
    counts as discovered only where such a pattern has it. Patterns and instances meet in joins and counts over all
    documents.
    """
    edges = written(edges.groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pii-edges")
    open_ = "kind in ('', 'secret')"
    names = edges.filter("kind not in ('', 'plain')").groupBy("pattern", "kind").count().groupBy("pattern").agg(F.max_by("kind", F.struct("count", "kind")).alias("of"))
    edges = edges.join(names, "pattern")  # only what seeds induce is a pattern
    edges = written(edges.withColumn("score", (~F.col("kind").isin("", "plain")).cast("double")), "pii-graph")
    graph = edges
    for _ in range(ROUNDS):
        pattern = graph.groupBy("pattern").agg(F.avg("score").alias("p"), F.sum((F.col("score") > 0).cast("int")).alias("support")).filter((F.col("support") >= MIN_SUPPORT) & (F.col("p") >= MIN_SCORE))
        instance = graph.filter(open_).join(pattern, "pattern").groupBy("instance").agg(F.max("p").alias("best"), F.max_by("of", F.struct("p", "of")).alias("named"))
        found = edges.join(instance, "instance", "left").withColumn("best", F.when(F.expr(open_), F.col("best")))
        graph = written(found.withColumn("score", F.greatest("score", F.coalesce("best", F.lit(0.0)))).drop("best"), "pii-graph")
        edges_named = graph
        graph = graph.drop("named")
    return edges_named.filter(f"{open_} and named is not null").select("instance", F.col("named").alias("found")).distinct()


def find(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, base and spans (start, kind, end; code points, end exclusive) of each document.

    base holds what the patterns for KINDS match; spans also what proves itself in runs that these dropped (see
    sure_spans), and what the contexts of all these and of secrets discover: kind context_ and the kind of the seeds. Null and empty texts hold nothing; repeated rows are judged each; an empty table gives no
    rows. Further columns are passed over.
    """
    kind = dict(docs.dtypes)["doc_id"]
    span = pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())])
    place = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, sure, found = [], [], []
            for t in column(b, "text"):
                text = t.as_py() or ""
                got = base_spans(text)
                base.append([{"start": a, "kind": KINDS[k], "end": e} for a, k, e in got])
                more = sure_spans(text, got)
                sure.append([{"start": a, "kind": f"context_{KINDS[k]}", "end": e} for a, k, e in more])
                found.append([{"start": a, "end": e, "kind": k, "instance": s, "patterns": p} for a, e, k, s, p in places(text, sorted(got + more))])
            yield pa.RecordBatch.from_arrays([column(b, "uid"), column(b, "doc_id"), column(b, "text_hash"), pa.array(base, pa.list_(span)), pa.array(sure, pa.list_(span)), pa.array(found, pa.list_(place))], names=["uid", "doc_id", "text_hash", "base", "sure", "places"])

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), "doc_id", F.xxhash64("text").alias("text_hash"), "text")
    base = written(rows.mapInArrow(run, f"uid long, doc_id {kind}, text_hash long, base array<struct<start:int,kind:string,end:int>>, sure array<struct<start:int,kind:string,end:int>>, places array<struct<start:int,end:int,kind:string,instance:string,patterns:array<string>>>"), "pii-base")
    each = base.select("uid", F.inline("places"))
    found = scored(each.select(F.explode("patterns").alias("pattern"), "instance", "kind"))
    added = each.filter("kind in ('', 'secret')").join(found, "instance").groupBy("uid").agg(F.collect_list(F.struct("start", F.concat(F.lit("context_"), "found").alias("kind"), "end")).alias("added"))
    none = F.array().cast("array<struct<start:int,kind:string,end:int>>")
    # kinds as listed, those of contexts after them
    order = lambda k: F.when(k.startswith("context_"), 9).otherwise(F.array_position(F.array(*map(F.lit, KINDS)), k))
    sorted_ = F.transform(F.array_sort(F.transform(F.concat("base", "sure", F.coalesce("added", none)), lambda x: F.struct(x.start.alias("start"), order(x.kind).cast("int").alias("order"), x.kind.alias("kind"), x.end.alias("end")))), lambda x: F.struct(x.start.alias("start"), x.kind.alias("kind"), x.end.alias("end")))
    return base.join(added, "uid", "left").select("doc_id", "text_hash", "base", sorted_.alias("spans"))


def masked(docs: DataFrame) -> DataFrame:
    """docs with each span of personal data in the text replaced by its kind in angle brackets; overlapping ones
    as one, by the kind that starts first. All columns stay, whatever their names; null texts stay null.
    """
    own = unused(docs, "spans")
    both = joined(docs, find(docs).filter(F.size("spans") > 0), "left", {"spans": own})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, spans in zip(column(b, "text"), column(b, own), strict=True):
                text, s = t.as_py(), spans.as_py()
                if s:
                    parts, at = [], 0
                    for x in s:
                        if x["start"] >= at:
                            parts += [text[at : x["start"]], f"<{x['kind'].removeprefix('context_')}>"]
                        at = max(at, x["end"])
                    text = "".join([*parts, text[at:]])
                out.append(text)
            i = b.schema.get_field_index("text")
            yield b.set_column(i, "text", pa.array(out, pa.string())).select(names)

    names = docs.columns
    return both.mapInArrow(run, docs.schema)


def op2_pii(spark, sf_dir: str) -> DataFrame:
    out = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x.kind, x.start, x.end)), ",")
    count = lambda k: F.size(F.filter("base", lambda x: x.kind == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *map(count, KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
