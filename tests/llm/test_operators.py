import base64
import hashlib
import io
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from brindle.llm import ann, common, decontaminate, meeting, mixing, neardup, pii, quality, repeats, suffix, toxicity, warc
from brindle.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, source string, text_hash string, kept string"
#: Nulls, empty and one-word texts, a long one, copies, a repeated row, a null id, and columns whose names clash.
LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
SHARED = " ".join(f"shared{i}" for i in range(90))
ROWS = [(1, None, "a"), (2, "", None), (3, "One", "a"), (4, LONG, "b"), (5, SHARED, "b"), (6, SHARED, "b"), (7, f"lead in {SHARED} tail", None), (8, "a b c " * 60, "c"), (9, "x y", "c"), (9, "x y", "c"), (None, "no id at all", "a"), (10, SHARED.upper(), "a")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "clash", "clash") for r in ROWS], DOC).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def words(t, gap=rb"[^\x20\x09-\x0D]+"):
    return re.findall(gap, (t or "").encode())


def removed(units, size):
    """Brute force: the mask of what goes in each text."""
    seen = Counter(u[s : s + size] for u in units for s in range(len(u) - size + 1))
    out = []
    for u in units:
        mask = np.zeros(len(u), bool)
        for s in range(len(u) - size + 1):
            if seen[u[s : s + size]] > 1:
                mask[s : s + size] = True
        out.append(mask)
    return out


REMOVE = [(lambda d: repeats.remove(d, 35, 10), 35, True), (lambda d: repeats.remove(d, 12, 5), 12, True), (lambda d: suffix.remove(d, 60), 60, False), (lambda d: suffix.remove(d, 400), 400, False)]


def check_removed(remove, size, by_word, texts, got):
    got = sorted(((r.n, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()), key=repr)
    units = [tuple(words(t)) if by_word else (t or "").encode() for t in texts]
    want = []
    for u, m in zip(units, removed(units, size), strict=True):
        stay = [u[i : i + 1] for i in np.flatnonzero(~m)]
        want.append((len(u), int(m.sum()), int((np.diff(np.append([False], m).astype(int)) > 0).sum()), b" ".join(x[0] for x in stay) if by_word else b"".join(stay)))
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("remove,size,by_word", REMOVE)
def test_removed(docs, none, remove, size, by_word):
    check_removed(remove, size, by_word, [t for _, t, _ in ROWS], remove(docs))
    assert remove(none).count() == 0


@pytest.mark.parametrize("pieces,few,many", [(97, 8, 20_000), (1 << 18, 1, 20_000), (1 << 18, 8, 1)])
@pytest.mark.parametrize("remove,size,by_word", REMOVE)
def test_removed_in_pieces_and_hot_seeds(spark, monkeypatch, remove, size, by_word, pieces, few, many):
    """Long texts in pieces, phrases with very many surroundings, overlapping repeats, and windows that just fall short."""
    for name, value in (("FEW", few), ("MANY", many), ("BLOCK", 500)):
        monkeypatch.setattr(meeting, name, value)
    for m in (repeats, suffix):
        monkeypatch.setattr(m, "CHUNK", max(pieces, 3 * size))
    rng = np.random.default_rng(size + pieces)
    word = lambda n: " ".join(f"{x:x}" for x in rng.integers(0, 1 << 28, n))
    phrase, long = word(size), word(size + 40)
    cut = lambda t, a, b: " ".join(t.split()[a:b])
    texts = [f"{word(int(rng.integers(0, 50)))} {cut(phrase, 0, size - int(rng.integers(0, 3)))} {word(int(rng.integers(0, 50)))}" for _ in range(25)]
    texts += [f"{word(5)} {cut(long, int(a), int(b))} {word(7)}" for a, b in rng.integers(0, size + 40, (25, 2))]
    texts += ["a b c d " * 60, "a b c d " * 50 + word(20), word(400) + " " + phrase + " " + word(300) + " " + long, long, long]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check_removed(remove, size, by_word, texts, remove(df))


def test_covers():
    for v, d in suffix.COVERS.items():
        assert sorted((a - b) % v for a in d for b in d if a != b) == list(range(1, v))


W34, B392 = " ".join(f"w{i}" for i in range(34)), "".join(f"{i:04d}" for i in range(98))


def test_stretches_of_one_seed_differ(spark):
    """Texts of one window each share an anchor or a name, but not the window."""
    got = repeats.remove(spark.createDataFrame([(i, f"v{i} {W34}") for i in (26455, 120850)], "doc_id long, text string"), 35, 10)
    assert [(r.n, r.n_removed) for r in got.collect()] == [(35, 0)] * 2
    got = suffix.remove(spark.createDataFrame([(i, f"{i:08d}{B392}") for i in (9023, 99373)], "doc_id long, text string"), 400)
    assert [(r.n, r.n_removed) for r in got.collect()] == [(400, 0)] * 2


def test_groups(docs, none):
    sets = [({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()) for w in (words((t or "").encode().lower().decode()) for _, t, _ in ROWS)]
    part = list(range(len(ROWS)))
    for i in range(len(ROWS)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = part[i], part[j]
                part = [b if x == a else x for x in part]
    ids = defaultdict(list)
    for p, r in zip(part, ROWS, strict=True):
        ids[p].append(r[0])
    least = {p: min((x for x in v if x is not None), default=None) for p, v in ids.items()}
    want = [(r[0], len(s), least[p], r[0] == least[p]) for r, s, p in zip(ROWS, sets, part, strict=True)]
    got = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.groups(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert neardup.groups(none).count() == 0


def test_groups_link_what_stars_leave_apart(spark):
    """A chain in which the first is like none but its neighbour."""
    base = [f"t{i}" for i in range(200)]
    rows = [(k, " ".join(base[k * 12 : k * 12 + 100])) for k in range(8)]
    got = {r.doc_id: r.component_id for r in neardup.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {0}


def test_meeting_loses_no_pair(spark):
    """Edited copies of one text, some of other lengths: every two that are similar enough come out of the prefix join."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 150, np.uint64)
    sets = {}
    for i in range(60):
        own = rng.integers(0, 1 << 63, rng.integers(0, 40), np.uint64)
        sets[bytes([i])] = np.unique(np.concatenate([rng.permutation(base)[: 150 - rng.integers(0, 40)], own]))
    keys = spark.createDataFrame([(k, len(h), k) for k, h in sets.items()], "key binary, n long, component binary")
    table = spark.createDataFrame([(k, h.tobytes(), neardup.parities(h).tolist()) for k, h in sets.items()], "key binary, set binary, bits array<long>")
    got = {(bytes(r.a), bytes(r.b)) for r in neardup.meeting(keys, table, 75).collect()}
    close = {(a, b) for a in sets for b in sets if a < b and 100 * (both := len(np.intersect1d(sets[a], sets[b]))) >= 75 * (len(sets[a]) + len(sets[b]) - both)}
    assert close and close <= got and len(got) < 60 * 59 / 2


def test_holders_of_a_frequent_shingle_are_compared_by_bucket(spark, monkeypatch):
    """Sets that share a line and otherwise a bucket in fives: the rows that are compared grow as the sets do, and the
    pairs that meet are those of a plain join where they share a bucket.
    """
    monkeypatch.setattr(neardup, "FREQUENT", 16)
    rng = np.random.default_rng(9)
    line = rng.integers(0, 1 << 63, 10, np.uint64)
    counts = []
    for fives in (20, 40):
        sets, buckets = {}, []
        for f in range(fives):
            base = rng.integers(0, 1 << 63, 40, np.uint64)
            for i in range(5):
                key = bytes([f, i])
                sets[key] = np.unique(np.concatenate([line, base[i:]]))
                buckets.append((f, key))
        keys = spark.createDataFrame([(k, len(h), k) for k, h in sets.items()], "key binary, n long, component binary")
        table = spark.createDataFrame([(k, h.tobytes(), neardup.parities(h).tolist()) for k, h in sets.items()], "key binary, set binary, bits array<long>")
        by = spark.createDataFrame(buckets, "bucket long, key binary")
        counts.append(neardup.compared(keys, table, 75, by).select("key", "other").distinct().count())
        got = {(bytes(r.a), bytes(r.b)) for r in neardup.meeting(keys, table, 75, by).collect()}
        assert got >= {(a, b) for a in sets for b in sets if a < b and a[0] == b[0]}
    assert counts[1] <= 2.1 * counts[0]


def test_a_pair_meets_once_in_a_bucket(spark):
    """Edited copies of one text, each a component, in the same buckets: however many shingles two of them share, they are
    compared once in each; sets of which others hold too little aren't compared.
    """
    rng = np.random.default_rng(10)
    base = rng.integers(0, 1 << 63, 100, np.uint64)
    own = lambda n: rng.integers(0, 1 << 63, n, np.uint64)
    sets = {bytes([0, i]): np.unique(np.concatenate([rng.permutation(base)[:95], own(5)])) for i in range(40)}
    odd = {bytes([1, i]): np.unique(np.concatenate([base[:60], own(40)])) for i in range(40)}
    many = 10
    by = spark.createDataFrame([(b, k) for k in (sets | odd) for b in range(many)], "bucket long, key binary")
    keys = spark.createDataFrame([(k, len(h), k) for k, h in (sets | odd).items()], "key binary, n long, component binary")
    table = spark.createDataFrame([(k, h.tobytes(), neardup.parities(h).tolist()) for k, h in (sets | odd).items()], "key binary, set binary, bits array<long>")
    rows = [(bytes(r.key), bytes(r.other)) for r in neardup.compared(keys, table, 75, by).select("key", "other").collect()]
    assert {k for r in rows for k in r} == set(sets) and len(rows) <= many * len(sets) ** 2
    got = {(bytes(r.a), bytes(r.b)) for r in neardup.meeting(keys, table, 75, by).collect()}
    assert got >= {(a, b) for a in sets for b in sets if a < b and 100 * (both := len(np.intersect1d(sets[a], sets[b]))) >= 75 * (len(sets[a]) + len(sets[b]) - both)} != set()


def test_groups_with_split_buckets_are_the_same(spark, monkeypatch):
    base = [f"t{i}" for i in range(400)]
    rows = [(k, " ".join(base[k * 6 : k * 6 + 100])) for k in range(40)] + [(100 + k, " ".join([*base[:90], f"x{k}", f"y{k}"])) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(tuple, neardup.groups(docs).collect()))
    monkeypatch.setattr(neardup, "TOGETHER", 3)
    monkeypatch.setattr(neardup, "FREQUENT", 2)
    assert sorted(map(tuple, neardup.groups(docs).collect())) == want


def test_likelihood_estimates_similarity():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        n = 2000
        both = rng.integers(0, 1 << 63, int(n * share), np.uint64)
        a, b = (np.concatenate([both, rng.integers(0, 1 << 63, n - len(both), np.uint64)]) for _ in "ab")
        true = len(both) / (2 * n - len(both))
        est = neardup.likeliest(neardup.sketch(a)[None].astype(int), neardup.sketch(b)[None].astype(int), np.array([float(n)]), np.array([float(n)]))
        assert abs(est[0] - true) < 0.13


def test_decontaminate(spark, docs, none):
    items = [(1, " ".join(f"Shared{i}" for i in range(20, 50))), (2, "one"), (3, None), (4, "x Y"), (10, "shared30 shared31"), (10, "b c a"), (None, "never seen anywhere"), (5, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    find = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    window = defaultdict(set)
    for i, t in items:
        w = find(t)
        for s in range(len(w) - min(10, len(w)) + 1) if w else ():
            window[tuple(w[s : s + 10])].add("" if i is None else str(i))
    want = []
    for i, t, _ in ROWS:
        w, hit, named = find(t), set(), set()
        for k, v in window.items():
            for s in range(len(w) - len(k) + 1):
                if tuple(w[s : s + len(k)]) == k:
                    hit |= set(range(s, s + len(k)))
                    named |= v
        want.append((i, len(w), len(hit), sorted(named)))
    collect = lambda: sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontaminate.decontaminate(docs, bench).collect()), key=repr)
    assert collect() == sorted(want, key=repr)
    before, decontaminate.MAX_BROADCAST = decontaminate.MAX_BROADCAST, 1
    try:
        assert collect() == sorted(want, key=repr)
    finally:
        decontaminate.MAX_BROADCAST = before
    assert decontaminate.decontaminate(none, bench).count() == 0
    assert {r.n_hit for r in decontaminate.decontaminate(docs, bench.limit(0)).collect()} == {0}


def aims(sizes, weights, share=1.5, cap=2):
    """Brute force: targets by filling, and stopping at the cap."""
    capped = set()
    while True:
        left, weight = share * sum(sizes) - sum(cap * sizes[i] for i in capped), sum(w for i, w in enumerate(weights) if i not in capped)
        over = {i for i, w in enumerate(weights) if i not in capped and w * left / weight > cap * sizes[i]}
        if not over:
            return [cap * s if i in capped else weights[i] * left / weight for i, s in enumerate(sizes)]
        capped |= over


def check_mix(df, rows):
    """rows: doc_id, text, source. Sizes and targets in full; what is taken by what it may be."""
    got = [r.asDict() for r in mixing.mix(df).collect()]
    size = lambda t: len(words(t))
    assert sorted(((r["doc_id"], r["source"], r["size"]) for r in got), key=repr) == sorted(((i, s, size(t)) for i, t, s in rows), key=repr)
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(size(t) for _, t, s in rows if s == x) for x in sources]
    want = aims(sizes, [(5, 2, 1)[i % 3] for i in range(len(sources))])
    for x, n, aim in zip(sources, sizes, want, strict=True):
        mine = [r for r in got if r["source"] == x]
        taken = sum(r["taken"] for r in mine)
        assert all(r["source_size"] == n and r["target"] == pytest.approx(aim) and 0 <= r["taken"] <= 2 * r["size"] for r in mine)
        assert aim - len(mine) - 1 < taken <= aim + 1e-6
        # each whole so many times, and once more for those below a threshold: one document or equal ones lie on it
        k = int(aim // n) if n else 0
        between = {(r["doc_id"], r["text_hash"]) for r in mine if r["taken"] not in (k * r["size"], (k + 1) * r["size"])}
        assert len(between) <= 1
    return sorted(map(repr, got))


def test_mixing(spark, docs, none):
    assert check_mix(docs, ROWS) == check_mix(docs.repartition(2), ROWS)
    assert mixing.mix(none).count() == 0
    rng = np.random.default_rng(6)
    rows = [(i, "w " * int(rng.integers(0, 40)), f"s{int(rng.integers(0, 90))}" if i % 9 else None) for i in range(600)] + [(i, "x " * 900, "hot") for i in range(600, 640)] + [(700, None, "\U0001F600"), (701, "a", "\uFFFD"), (702, " ", "empty")]
    check_mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), rows)


def test_warc(spark):
    rows = [(1, "http://a/ b\r\nX: y", "<p>é</p>"), (2, None, None), (3, "u", "same"), (7, "u", "same"), (5, "u", "same"), (None, "n", "same"), (8, "u", ""), (9, "u", "x" * 300_000)]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, payload int")
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    for i, _, html in rows:
        data = (html or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
    assert {i: r.refers_to for i, r in got.items()} == {1: None, 2: 8, 3: 7, 7: None, 5: 7, None: 7, 8: None, 9: None}
    assert bytes(got[9].payload) == b"x" * 300_000 and got[1].url == "http://a/%20b%0D%0AX:%20y"
    assert {r.refers_to for r in warc.round_trip(pages, min_bytes=5).collect()} == {None}
    assert warc.round_trip(pages.limit(0)).count() == 0
    data = warc.member(warc.record(1, "u", b"abc", None)) + warc.member(warc.record(2, "u", b"abc", 1))
    assert [r["record_type"] for r in warc.records(io.BytesIO(data))] == ["response", "revisit"]
    for bad in (data[:-9], warc.member(warc.record(1, "u", b"abc", None).replace(b"abc", b"abd")), warc.member(b"HTTP/1.1\r\n\r\n")):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(bad)))


def test_nearest(spark):
    rng = np.random.default_rng(3)
    vecs = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    vecs[7] = (7, (np.array(vecs[9][1]) * 3).tolist())
    odd = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] + [1.0] * 15), (1004, [None] + [1.0] * 15), (1005, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1) for r in vecs + odd], "vec_id long, embedding array<double>, score int").repartition(3)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.nearest(df, df.filter("vec_id % 50 = 0")).collect()}
    x = np.array([v for _, v in vecs])
    x /= np.linalg.norm(x, axis=1)[:, None]
    for q in range(0, 300, 50):
        s = x @ x[q]
        s[q] = -9
        for k, j in enumerate(np.lexsort((np.arange(300), -np.round(s, 12)))[:5]):
            assert got[q, k + 1][0] == j and got[q, k + 1][1] == pytest.approx(s[j], abs=1e-12)
    assert len(got) == 30 and ann.nearest(df.limit(0), df.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<double>")
    assert [(r["rank"], r.vec_id, r.score) for r in ann.nearest(few, few.filter("vec_id = 0")).orderBy("rank").collect()] == [(1, 1, 1.0), (2, 2, -1.0)]


def test_nearest_deals_tiles_to_as_many_keys_as_there_are(spark):
    """Keys grow with both sides, blocks are int8, and no vectors as doubles go through the join of tiles."""
    assert ann.grid(0, 0) == (1, 1) and ann.grid(10**6, 10**9) == (245, 15259)
    df = spark.range(300).selectExpr("id as vec_id", "array(double(id + 1), 1D) as embedding")
    block = ann.blocks(ann.usable(df), 100, "c")
    assert max(len(r.c) / 2 for r in block.collect()) <= 100 and sum(len(r.c) for r in block.collect()) == 600


@pytest.mark.parametrize("rows,heaps", [(4096, 100_000), (16, 1)])
def test_nearest_among_many_copies(spark, monkeypatch, rows, heaps):
    """A vector with very many ids: its queries get the smallest of them, and few pairs of copies are kept."""
    monkeypatch.setattr(ann, "ROWS", rows)
    monkeypatch.setattr(ann, "HEAPS", heaps)
    rng = np.random.default_rng(9)
    vecs = [(i, [1.0, 2.0, 3.0] if i % 3 else rng.normal(size=3).tolist()) for i in range(600)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>").repartition(4)
    kept, sizes = ann.written, []

    def seen(out, name):
        out = kept(out, name)
        sizes.append(out.count()) if name == "nearest-pairs" else None
        return out

    monkeypatch.setattr(ann, "written", seen)
    got = ann.nearest(df, df.filter("vec_id % 20 = 0")).collect()
    for q in range(0, 600, 20):
        mine = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        x = np.array([v for _, v in vecs])
        score = np.round(ann.cosine(np.repeat(x[[q]], 600, axis=0), x), 12)
        assert mine == [i for i in np.lexsort((np.arange(600), -score)).tolist() if i != q][:5]
    assert sizes[0] < 30 * (100 if rows > 600 else 240)  # there are 30 * 400 pairs of copies


@pytest.mark.parametrize("rows,heaps", [(4096, 100_000), (16, 100_000), (16, 1)])
def test_nearest_counts_repeated_ids_once(spark, monkeypatch, rows, heaps):
    """Rows that repeat, ids with several vectors, and ties, in one tile and in many."""
    monkeypatch.setattr(ann, "ROWS", rows)
    monkeypatch.setattr(ann, "HEAPS", heaps)
    rng = np.random.default_rng(4)
    vecs = [(i, rng.normal(size=8)) for i in range(30)]
    vecs += [(1, vecs[1][1])] * 6 + [(2, vecs[0][1])] * 3 + [(2, rng.normal(size=8)), (7, vecs[0][1] * 2), (50, vecs[3][1]), (50, vecs[4][1])]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in vecs], "vec_id long, embedding array<double>").repartition(3)
    best = defaultdict(lambda: -9.0)
    for q, a in vecs:
        for i, b in vecs:
            if q % 10 == 0 and i != q:
                best[q, i] = max(best[q, i], round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 12))
    got = {(r.query_id, r["rank"]): (r.vec_id, round(r.score, 12)) for r in ann.nearest(df, df.filter("vec_id % 10 = 0")).collect()}
    want = {(q, k + 1): x for q in (0, 10, 20, 50) for k, x in enumerate(sorted(((i, s) for (p, i), s in best.items() if p == q), key=lambda x: (-x[1], x[0]))[:5])}
    assert got == want


EMAIL, IP = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD, PHONE = re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def test_base_spans():
    rng = np.random.default_rng(5)
    pieces = ["a@b.c", "x.y+z@q-r.co.uk", "@", ".", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111111111111112", "+1 (743) 555-3824", "+", " ", "é", "12", "-", "a@b", "00.01.2.3.4"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces, rng.integers(1, 9)))
        want = []
        for kind, pattern in enumerate((EMAIL, IP, CARD, PHONE)):
            for m in pattern.finditer(text):
                d = re.sub("[^0-9]", "", m[0])
                if (True, kind == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(d) <= 19 and pii.luhn(d), 10 <= len(d) <= 15)[kind]:
                    want.append((m.start(), kind, m.end()))
        assert pii.base_spans(text) == sorted(want), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_contexts_discover(spark, docs, none):
    rows = [(i, f"please dial number +1 (555) 555-{1000 + i} today") for i in range(6)] + [(50, "please dial number +9 (55) 55-12 today"), (51, "it was +9 (55) 55-12 then"), (52, "mail a@b.co")]
    got = {r.doc_id: [tuple(x) for x in r.spans] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == [(19, "phone", 36)] and got[52] == [(5, "email", 11)]
    masked = {r.doc_id: r.text for r in pii.masked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert masked[0] == "please dial number <phone> today"
    assert pii.find(docs).count() == len(ROWS) and pii.find(none).count() == 0
    edges = [("p", f"s{i}", "phone") for i in range(4)] + [("p", "new", ""), ("q", "new", ""), ("q", "other", "")]
    found = pii.scored(spark.createDataFrame(edges, "pattern string, instance string, kind string")).collect()
    assert [(r.instance, r.found) for r in found] == [("new", "phone")]


def test_contexts_discover_other_forms(spark):
    """Unseen identifiers in the context of phones are found and masked, and what fails a base check isn't."""
    unseen = ["743 555 3824", "(743) 555-3824", "743-555-3824", "AC-77120-X", "@kim_lee", "12345678"]
    decoys = ["300.155.1.1", "4111111111111112", "4111 1111 1111 1112", "+9 (55) 55-12", "+99 123456", "1" * 25]
    seeds = [f"+1 (555) 555-{1000 + i}" for i in range(30)]
    rows = [(i, f"please dial number {x} today") for i, x in enumerate(seeds + unseen + decoys)] + [(100, "the year 20201231 and @some_one else")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.spans] for r in pii.find(df).collect()}
    n, m = len(seeds), len(seeds) + len(unseen)
    assert [got[i] for i in range(n, m)] == [[(19, "context_phone", 19 + len(x))] for x in unseen]
    assert not any(got[i] for i in [*range(m, m + len(decoys)), 100])
    masked = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert {masked[i] for i in range(m)} == {"please dial number <phone> today"}
    assert [masked[i] for i, _ in rows[m:]] == [t for _, t in rows[m:]]


def spans_of(spark, rows):
    return {r.doc_id: [(x.kind, t[x.start : x.end]) for x in r.spans] for (i, t), r in zip(rows, sorted(pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect(), key=lambda r: r.doc_id), strict=True) if i == r.doc_id}


def test_secrets_are_discovered_behind_key_names(spark):
    """Where enough different ones stand behind a name, also short ones and those elsewhere; neither words nor lone ones."""
    digest = lambda i: hashlib.sha1(str(i).encode()).hexdigest()
    texts = [f'put token = "{digest(i)}" here' for i in range(30)]
    texts += ['put Token = "ab12-cd34" here', f"put token={digest(31)}, here", f"only {digest(3)} again"]
    texts += [f"a lone {digest(50)} stays", 'colour = "red"', f'colour = "{digest(60)}"', 'put token = "hello" here', f'id = "{digest(61)}"', "see http://a.b/c?d=e1 at 12:30", None, "", f'put token = "{digest(1)}" here']
    texts += [f'colour = "{c}"' for c in ("blue", "green", "black")] + [f'colour = "{digest(70 + i)}"' for i in range(3)]
    got = spans_of(spark, list(enumerate(texts)))
    assert all(got[i] == [("context_secret", digest(i))] for i in range(30))
    assert (got[30], got[31], got[32]) == ([("context_secret", "ab12-cd34")], [("context_secret", digest(31))], [("context_secret", digest(3))])
    assert not any(got[i] for i in (*range(33, 41), *range(42, len(texts)))) and got[41] == [("context_secret", digest(1))]


def test_what_proves_itself_in_dropped_runs(spark):
    a, b = "4111111111111111", "5500000000000004"
    four = lambda x, gap: gap.join(x[i : i + 4] for i in range(0, 16, 4))
    rows = [
        (f"pay {a} {b}.", [("context_card", a), ("context_card", b)]), (f"{four(a, ' ')} {four(b, ' ')}", [("context_card", four(a, " ")), ("context_card", four(b, " "))]),
        (f"{a}-{b} {a}", [("context_card", a), ("context_card", b), ("context_card", a)]), (f"{a} 4111111111111112", []), (f"{a} 12 {b}", []), (f"{a}{b}", []), ("1 2 3 4 5 6 7 8 9 " * 40, []),
        ("call +1 (826) 555-4081 190.137.22.10 now", [("context_phone", "+1 (826) 555-4081"), ("ip", "190.137.22.10")]), ("+12 190.137.22.10 190.137.22.10", [("ip", "190.137.22.10")] * 2), (a, [("card", a)]),
    ]
    got = spans_of(spark, [(i, t) for i, (t, _) in enumerate(rows)])
    assert [got[i] for i in range(len(rows))] == [w for _, w in rows]


def test_pii_of_odd_rows(docs):
    """Null, empty, long and repeated texts: values, not only rows."""
    got = sorted(((r.doc_id, r.base, r.spans) for r in pii.find(docs).collect()), key=repr)
    assert got == sorted(((i, [], []) for i, _, _ in ROWS), key=repr)
    more = docs.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" a.b@c.de")))
    assert sorted(((r.doc_id, [(x.kind, x.end - x.start) for x in r.spans]) for r in pii.find(more).collect()), key=repr) == sorted(((i, [("email", 8)]) for i, _, _ in ROWS), key=repr)


@pytest.mark.parametrize("run,truth,recall,alarms", [(quality.classify, "quality", 0.95, 0.1), (toxicity.classify, "toxic", 0.75, 0.05)])
def test_classifiers(spark, docs, none, run, truth, recall, alarms):
    """Recall and false alarms on labels that weren't learnt from."""
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = run(d, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held, one = got[got.held_out], got[got.held_out][truth] == 1
    assert held[one].predicted.mean() >= recall and held[~one].predicted.mean() <= alarms
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    few = spark.createDataFrame([(3, 1, None), (5, None, 1), (7, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert run(docs, few).count() == len(ROWS)
    assert run(docs, few.limit(0)).count() == len(ROWS) and run(none, few).count() == 0


def test_terms_are_counted_whole(docs, monkeypatch):
    """Against a plain count of each text's words and their beginnings, however the texts are dealt."""
    texts = [t for (t,) in docs.select("text").collect()] + [None, "", " 12 ", "Ünïcode ünïcodes—x", "Ж" * 9]
    want, n = Counter(), []
    for i, t in enumerate(texts):
        found = "".join(c if (c.isalpha() if c < "\x80" else re.match(r"\w", c)) else " " for c in (t or "").lower()).encode().split()
        n.append(len(found))
        for w in found:
            want.update((i, x) for x in (w, *(w[:c] + b"-" for c in toxicity.STEMS if len(w) > c)))
    for size in (50, toxicity.SLICE):
        monkeypatch.setattr(toxicity, "SLICE", size)
        got, lengths = {}, []
        for first, some in toxicity.slices(pa.array(texts, pa.string())):
            names, text, term, k, each = toxicity.counts(some)
            got.update({(first + a, names[b.item()].as_py()): c for a, b, c in zip(text, term, k, strict=True)})
            lengths += each.tolist()
        assert got == want and lengths == n
    few = pa.array(sorted({x for _, x in want})[:20], pa.binary())
    rows = np.concatenate(list(toxicity.inputs(pa.array(texts, pa.string()), few)))
    assert rows.shape == (len(texts), 41) and ((rows[:, :20] > 0) == [[(i, x) in want for x in few.to_pylist()] for i in range(len(texts))]).all()


def test_toxicity_where_the_sample_is_bounded(spark, monkeypatch):
    """Few fit, but terms are counted over all."""
    monkeypatch.setattr(toxicity, "MAX_POSITIVE", 25)
    monkeypatch.setattr(toxicity, "MAX_UNLABELLED", 200)
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = toxicity.classify(d, labels).toPandas().merge(labels.toPandas(), on="doc_id")
    held, one = got[got.held_out], got[got.held_out].toxic == 1
    assert held[one].predicted.mean() >= 0.6 and held[~one].predicted.mean() <= 0.15


def test_non_negative_risk_learns_from_unlabelled():
    rng = np.random.default_rng(2)

    def rows(toxic):
        x = np.zeros((len(toxic), 51), np.float32)
        for r, t in zip(x, toxic, strict=True):
            r[rng.integers(1, 50, 8)], r[0], r[-1] = 1, t, 1
        return x

    w = toxicity.fit(rows([True] * 200), rows([i % 10 == 0 for i in range(1000)]), 0.1)
    assert w[0] + w[-1] > 0 > w[-1] + np.abs(w[1:-1]).max()
    p, u = np.array([1.0, 3.0, 4.0]), np.array([-3.0] * 7 + [-1.0, 1.5, 4.0])
    assert toxicity.parting(p, u, 0.2) == 1.0 and toxicity.parting(p, np.array([-3.0] * 3 + [2.0] * 6 + [4.0]), 0.1) == 3.0


def test_isotonic():
    y = np.array([0.1, 0.5, 0.3, 0.9, 0.8])
    out = quality.pool_adjacent(y, np.ones(5))
    assert (np.diff(out) >= 0).all() and out == pytest.approx([0.1, 0.4, 0.4, 0.85, 0.85])


def near(rows):
    """Brute force: the row with the smallest id of each group, of repeated rows one."""
    sets = [({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()) for w in (words((t or "").encode().lower().decode()) for _, t, _ in rows)]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                part = [part[j] if x == part[i] else x for x in part]
    least = {p: min((r[0] for r, x in zip(rows, part, strict=True) if x == p and r[0] is not None), default=None) for p in part}
    return {(i, t) for (i, t, _), p in zip(rows, part, strict=True) if i == least[p]}


def test_pipeline(spark, docs, none):
    """Each stage on null, empty, long, repeated and clashing rows, against what brute force keeps of its own input."""
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "pii", "mixing"]
    stage, source = dict(corpus_pipeline.STAGES), {i: s for i, _, s in ROWS}
    docs = docs.withColumn("spans", F.lit(1)).withColumn("target", F.lit("own")).withColumn("of", F.lit(2))
    texts = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)
    found = {(r.doc_id, r.text_hash) for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet"), threshold=0.5).filter("predicted = 1").collect()}
    good = stage["quality"](spark, docs, SF)
    assert texts(good) == sorted(((r.doc_id, r.text) for r in docs.withColumn("h", F.xxhash64("text")).collect() if (r.doc_id, r.h) in found), key=repr)
    distinct = stage["near_dedup"](spark, docs, SF)
    assert texts(distinct) == sorted(near(ROWS), key=repr)
    bench = [tuple(b) for b in (words(r.text.lower(), rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect())]
    leak = b" ".join(bench[0][3:13]).decode().upper()
    more = spark.createDataFrame([(70, f"so {leak} it is", "a", "", ""), (71, f"so {leak[:-1]}", "a", "", ""), (72, "to a.b@c.de, at 1.2.3.4", "b", "", ""), (72, "to a.b@c.de, at 1.2.3.4", "b", "", "")], DOC).select("*", F.lit(1).alias("spans"), F.lit("own").alias("target"), F.lit(2).alias("of"))
    both = docs.unionByName(more)
    clean = stage["decontaminate"](spark, both, SF)
    assert texts(clean) == sorted(((i, t) for i, t in texts(both) if i != 70), key=repr)
    private = stage["pii"](spark, both, SF)
    assert texts(private) == sorted(((i, t if i != 72 else "to <email>, at <ip>") for i, t in texts(both)), key=repr)
    for df in (good, distinct, clean, private):
        assert df.columns == docs.columns
    mix = stage["mixing"](spark, docs, SF)
    taken = {(r.doc_id, r.text_hash): r.taken for r in mixing.mix(docs).collect()}
    assert mix.columns == ["doc_id", "text", "source", "text_hash", "kept", "spans", "target_", "of", "size", "source_size", "target", "taken"]
    assert texts(mix) == sorted(((r.doc_id, r.text) for r in docs.withColumn("h", F.xxhash64("text")).collect() if taken[r.doc_id, r.h]), key=repr)
    assert all(r.source == source[r.doc_id] and r["size"] == len(words(r.text)) for r in mix.collect())
    assert {r.target_ for r in mix.collect()} == {"own"}
    for f in stage.values():
        assert f(spark, none, SF).count() == 0
    # of repeated rows that differ elsewhere, the first by their other columns, however they are dealt
    again = docs.filter("doc_id = 9").withColumn("of", F.expr("int(monotonically_increasing_id() % 7) + 3")).withColumn("source", F.when(F.col("of") > 3, F.col("source")))
    both = docs.unionByName(again)
    first = min(((r.source is not None, r.source or "", r.of) for r in both.filter("doc_id = 9").collect()))
    for n in (1, 5):
        got = stage["near_dedup"](spark, both.repartition(n), SF)
        assert texts(got) == sorted(near(ROWS), key=repr) and [(r.source is not None, r.source or "", r.of) for r in got.filter("doc_id = 9").collect()] == [first]


def test_pipeline_of_odd_rows(spark, docs, none, tmp_path):
    """Whole runs: on rows with nulls, repeats and clashing names, without labels or benchmark, and on no rows."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(str(tmp_path / f"odd/{name}.parquet"))
    docs.write.parquet(str(tmp_path / "odd/documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path / "odd"))
    assert got.columns == [*docs.columns, "size", "source_size", "target", "taken"]
    # without labels all score 0.5 and stay; nothing is personal; each source's words are below what it may give
    left = {(i, t) for i, t in near(ROWS)}
    assert {(r.doc_id, r.text) for r in got.collect()} <= left and {r.text_hash for r in got.collect()} <= {"clash"}
    sizes = {i: len(words(t)) for i, t in left}
    assert all(r["size"] == sizes[r.doc_id] and 0 < r.taken <= 2 * r["size"] for r in got.collect()) and got.count() > 0
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"none/{name}.parquet"))
    none.write.parquet(str(tmp_path / "none/documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0


def test_pipeline_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = corpus_pipeline.run(spark, SF)
    left = got.toPandas()
    assert 0 < len(left) < docs.count() and left.doc_id.is_unique and got.columns == [*docs.columns, "size", "source_size", "target", "taken"]
    assert not any(pii.base_spans(t) for t in left.text)


def test_tables_need_a_shared_folder(spark):
    """On a cluster without one, writing is refused."""
    class Conf(dict):
        set = dict.__setitem__

    class Session:
        conf = Conf({"spark.master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(Session())
    Session.conf = Conf({"spark.master": "local[2]"})
    assert common.shared_dir(Session()) == Session.conf["spark.checkpoint.dir"]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF).select(names)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
