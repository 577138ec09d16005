import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from brindle.llm import codes, langid, ranking

SF = "/root/testdata/sf0.01"


def test_grams_are_counted_by_word():
    """Against a plain count of the n-grams of each word, blanks around it, whatever the pieces."""
    texts = ["Ab c", "", "12 ³½ _", "ÀB-cd'E ΑΣ İx", "x" * 40, "Жa  \n b", "a", " "]

    def bin_of(gram):
        key = len(gram)
        for c in gram:
            key = (key ^ (0 if c == " " else ord(c))) * 0x9E3779B97F4A7C15 % 2**64
            key ^= key >> 29
        return (key * 0xBF58476D1CE4E5B9 % 2**64) >> (64 - langid.BITS)

    want = Counter()
    for i, t in enumerate(texts):
        for w in "".join(c if c.isalpha() else " " for c in t.lower()).split():
            padded = f" {w} "
            want.update((i, bin_of(g)) for n in langid.SIZES for a in range(len(padded) - n + 1) if (g := padded[a : a + n]) != " ")
    for size in (1 << 19, 7):
        got, before = Counter(), langid.PIECE
        langid.PIECE = size
        try:
            for owners, held in langid.gathered(t for t in texts if len(t) < 40 or size > 40):
                shift = [x if size > 40 or x < 4 else x + 1 for x in owners]
                for piece, at in langid.grams(held):
                    got.update((shift[p], b) for p, b in zip(piece.tolist(), at.tolist(), strict=True))
        finally:
            langid.PIECE = before
        assert got == (want if size > 40 else Counter({k: v for k, v in want.items() if k[0] != 4}))
    assert list(langid.pieces("ab cd" * langid.PIECE))[0][-1] == " " and [len(p) for p in langid.pieces("x" * (langid.PIECE + 5))] == [langid.PIECE, 5]


def of_crc(rest):
    """ids whose crc32 as text leaves rest by 4."""
    import zlib

    return (i for i in range(10**6) if zlib.crc32(str(i).encode()) % 4 == rest)


@pytest.fixture(scope="module")
def spoken(spark):
    learn, held = of_crc(0), of_crc(2)
    rows = [(next(learn), t, x) for _ in range(20) for t, x in (("the cat and the dog", "en"), ("der Hund und die Katze", "de"), ("le chien et la souris", "fr"))]
    rows += [(next(learn), "123 !", "num"), (next(learn), "zzz qqq", None)]
    odd = [(next(held), t, x) for t, x in ((None, "en"), ("", "en"), (" 12 ³½ _", "fr"), ("THE DOG", "xx"), ("die Katze", None), ("la souris et " * 60_000, "de"))]
    odd += [odd[3], (None, "und die Maus", "en")]
    return spark.createDataFrame([(*r, "clash", 1.0) for r in rows + odd], "doc_id long, text string, lang string, best string, top double").repartition(3), rows, odd


def test_languages_of_odd_rows(spark, spoken, monkeypatch):
    df, rows, odd = spoken
    want = {(i, x) for (i, _, _), x in zip(odd, ["und", "und", "und", "en", "de", "fr", "en", "de"], strict=True)}
    seen = []
    for languages, piece in ((64, 1 << 19), (1, 1 << 19), (2, 50)):
        monkeypatch.setattr(langid, "LANGUAGES", languages)
        monkeypatch.setattr(langid, "PIECE", piece)
        got = langid.identify(df).collect()
        assert len(got) == len(rows) + len(odd) and {(r.doc_id, r.lang_pred) for r in got if r.held_out or r.doc_id is None} == want
        assert all((r.lang_pred == "und") == (r.score == 0) and 0 <= r.score <= 1 for r in got)
        assert all(r.lang_pred == x for r in got for i, _, x in rows if r.doc_id == i and x in ("en", "de", "fr"))
        seen.append(sorted((str(r.doc_id), r.lang_pred, round(r.score, 9)) for r in got))
    assert seen[0] == seen[1] == seen[2]
    assert {r.lang_pred for r in langid.identify(df.filter("lang is null")).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def test_ties_go_to_the_first_language(spark):
    ids = of_crc(1)
    df = spark.createDataFrame([(next(ids), "same words", x) for x in ("b", "a", "c")], "doc_id long, text string, lang string")
    assert {(r.lang_pred, round(r.score, 6)) for r in langid.identify(df).collect()} == {("a", round(1 / 3, 6))}


def test_posterior_is_that_of_plain_naive_bayes(spark, spoken):
    df, rows, _ = spoken
    bins = lambda t: [b for _, at in langid.grams([t]) for b in at.tolist()]
    n, docs = defaultdict(Counter), Counter()
    for _, t, x in rows:
        if x and x != "num":
            n[x].update(bins(t))
            docs[x] += 1
    text = "die dog"
    p = {x: math.log(docs[x] / docs.total()) + sum(math.log((c[b] + langid.ALPHA) / (c.total() + langid.ALPHA * langid.BINS)) for b in bins(text)) for x, c in n.items()}
    more = df.select("doc_id", "text", "lang").union(spark.createDataFrame([(next(of_crc(2)), text, "en")], "doc_id long, text string, lang string"))
    got = langid.identify(more).filter(f"doc_id = {next(of_crc(2))} and held_out").collect()
    best = max(p, key=p.get)
    assert any(r.lang_pred == best and r.score == pytest.approx(1 / sum(math.exp(v - p[best]) for v in p.values()), rel=0.01) for r in got)


def test_held_out_languages(spark):
    """Whole and with few to learn from."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    for most in (langid.MAX_TRAIN, 20):
        held = [truth[r.doc_id] == r.lang_pred for r in langid.identify(docs, most=most).collect() if r.held_out]
        assert len(held) > 150 and sum(held) / len(held) >= 0.98


def nearest(x, entries):
    d = ((x[:, None, :] - entries[None]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


@pytest.mark.parametrize("spread", [1, 3, 1000, 1 << 27])
def test_trees_find_the_nearest_entry(spread):
    """Equal entries, ties and far queries, against all distances."""
    rng = np.random.default_rng(spread)
    for n, d in ((1, 4), (5, 1), (64, 4), (64, 1), (200, 2), (64, 0)):
        entries, x = (rng.integers(-spread, spread + 1, (k, d)) for k in (n, 500))
        entries[n // 2 :] = np.where(rng.random((n - n // 2, 1)) < 0.3, entries[:1], entries[n // 2 :])
        best, error = np.full(500, np.iinfo(np.int64).max), np.full(500, np.iinfo(np.int64).max)
        taken = codes.Gnat(entries, np.arange(n)).search(x, np.arange(500), best, error)
        want = nearest(x, entries)
        assert (best == want[0]).all() and (error == want[1]).all()
        if spread > 100 and n == 200:
            assert taken < 500 * n / 2  # whole subtrees are passed over


def encoded(rows):
    """Brute force for rows (vec_id, vector, label) that are all usable and of one width."""
    x = np.floor(np.array([v for _, v, _ in rows]) * 256).astype(np.int64)
    order = sorted((i for i in range(len(rows)) if rows[i][0] is not None), key=lambda i: (rows[i][0], list(rows[i][1])))[:64]
    cuts = [(p * x.shape[1] // 16, (p + 1) * x.shape[1] // 16) for p in range(16)]
    books = [x[order, a:b] for a, b in cuts]
    for _ in range(2):
        for p, (a, b) in enumerate(cuts):
            at, _ = nearest(x[:, a:b], books[p])
            books[p] = np.array([[math.floor(sum(c) / len(c)) if abs(sum(c)) < 2**50 else sum(c) // len(c) for c in zip(*x[at == k, a:b].tolist(), strict=True)] if (at == k).any() else books[p][k].tolist() for k in range(len(order))], np.int64).reshape(len(order), b - a)
    found = [nearest(x[:, a:b], books[p]) for p, (a, b) in enumerate(cuts)]
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b.tolist() for v in e).encode()).hexdigest()
    code = ["".join(f"{at[i]:02x}" for at, _ in found) for i in range(len(x))]
    error = sum(d for _, d in found)
    total = Counter()
    for (_, _, label), e in zip(rows, error.tolist(), strict=True):
        total[label] += e
    return [(i, c, e, total[label], digest) for (i, _, label), c, e in zip(rows, code, error.tolist(), strict=True)]


@pytest.mark.parametrize("width,n", [(16, 200), (32, 30), (20, 90), (5, 70), (48, 1)])
@pytest.mark.parametrize("labels", [codes.MAX_LABELS, 0])
def test_codes_equal_brute_force(spark, monkeypatch, width, n, labels):
    """Repeated rows and ids, null ids and labels, negative zeros, and rows that take no part."""
    monkeypatch.setattr(codes, "MAX_LABELS", labels)
    rng = np.random.default_rng(width)
    rows = [(int(i), rng.normal(size=width).round(2).tolist(), (None, 1, 2)[i % 3]) for i in rng.permutation(n)]
    rows += [rows[0], (rows[0][0], [-0.0] * width, 1), (None, [0.5] * width, 2), (-3, [-1 / 256] * width, None)]
    nan, inf = float("nan"), float("inf")
    gone = [(900, None, 1), (901, [nan] * width, 1), (902, [1.0] * (width - 1) + [inf], 1), (903, [None] + [1.0] * (width - 1), 2)]
    odd = [(-9, [1.0] * (width + 1), 1), (905, [], 1), (-8, [1e30] * width, 2), (907, [-1e12] * width, 7)]
    df = spark.createDataFrame([(i, v, label, "c", 1) for i, v, label in rows + gone + odd], "vec_id long, embedding array<double>, label int, code string, `of` int").repartition(3)
    got = codes.encode(df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    want = encoded(rows)
    total = {label: e for (_, _, label), (*_, e, _) in zip(rows, want, strict=True)}
    want += [(i, None, None, total.get(label), want[0][-1]) for i, _, label in odd]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_codes_of_no_vectors(spark):
    df = spark.createDataFrame([(1, None, 1), (2, [None], 1)], "vec_id long, embedding array<float>, label int")
    assert codes.encode(df).count() == 0 and codes.encode(df.limit(0)).count() == 0
    got = codes.encode(spark.createDataFrame([(1, [], 1)], "vec_id long, embedding array<float>, label int")).first()
    assert (got.code, got.error) == ("00" * 16, 0)


def brute(docs, items, k=10):
    """docs: (doc_id, text); items: (item_id, text). As the contract says, term by term."""
    find = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode()))
    d = [(i, Counter(find(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in d), sum(c.total() for _, c in d)
    df = Counter(t for _, c in d for t in c)
    q = defaultdict(Counter)
    for i, t in items:
        q[i].update(find(t))
    out = []
    for i, want in q.items():
        scored = []
        for doc, c in d:
            s = 0
            for t, times in want.items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 25 + 75 * c.total() * n_docs // n_terms
                    s += times * w * (10**9 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(i, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


LONG = " ".join(f"w{i % 997}" for i in range(30_000))
DOCS = [(1, None), (2, ""), (3, "One two, THREE"), (4, LONG), (5, "one two three"), (9, "ONE two three"), (5, "one two three"), (None, "one"), (8, "-- !"), (7, "été w1 w2 é"), (6, "w3 w3 w3 ſ"), (-4, "w3 w3 w3 ſ")]
ITEMS = [(1, "one TWO"), (2, None), (3, "..."), (4, "w1 w2 w3 é absent"), (5, "one " * 40), (5, "w7"), (None, "three w996"), (6, LONG), (7, "été")]


@pytest.mark.parametrize("sizes", [{}, {"ITEMS": 2, "TERMS": 3, "DOCS": 2}, {"GROUP_ITEMS": 2, "EXACT": 1 << 34, "DOCS": 3}, {"SPREAD": 2, "KNOWN": 4}])
def test_ranking_equals_brute_force(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ranking, name, value)
    docs = spark.createDataFrame([(*r, "c", 1) for r in DOCS], "doc_id long, text string, item string, score int").repartition(3)
    items = spark.createDataFrame([(*r, 0) for r in ITEMS], "item_id long, text string, `rank` int").repartition(2)
    for k in (10, 1, 3):
        assert sorted(map(tuple, ranking.search(docs, items, k).collect()), key=repr) == brute(DOCS, ITEMS, k)
    assert ranking.search(docs.limit(0), items).count() == 0 and ranking.search(docs, items.limit(0)).count() == 0
    assert ranking.search(docs, items.filter("item_id in (2, 3)")).count() == 0


def test_many_ties_keep_the_smallest_ids(spark):
    docs = [(i, "same text") for i in range(3000)] + [(i, f"other {i}") for i in range(3000, 3100)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = ranking.search(df, spark.createDataFrame([("a", "same same"), ("b", "other")], "item_id string, text string"))
    assert {k: [r.doc_id for r in sorted(got.collect(), key=lambda r: r["rank"]) if r.item_id == k] for k in "ab"} == {"a": [*range(10)], "b": [*range(3000, 3010)]}


def test_tiles_stay_exact():
    rng = np.random.default_rng(1)
    dense = rng.integers(0, 50, (7, 40))
    dense[2, 5], dense[3] = 1000, 0
    out = np.zeros_like(dense)
    for use, x in ranking.halved(dense, 120):
        assert x.sum(1).max() <= 120
        out[:, use] += x.astype(np.int64)
    assert (out == dense).all()
