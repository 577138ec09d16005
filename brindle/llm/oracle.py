"""SQL for the operators that it can express, as plain brute force."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bl AS (SELECT item_id, w, least(10, len(w)) AS l FROM b WHERE len(w) > 0),
bs AS (SELECT item_id, w, l, unnest(range(0, len(w) - l + 1)) AS s FROM bl),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, l, array_to_string(w[s + 1 : s + l], ' ') AS k FROM bs),
ds AS (SELECT doc_id, w, l, unnest(range(0, len(w) - l + 1)) AS s FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l),
dw AS (SELECT doc_id, l, s, array_to_string(w[s + 1 : s + l], ' ') AS k FROM ds),
hit AS (SELECT dw.doc_id, dw.l, dw.s, bw.item FROM dw JOIN bw ON dw.l = bw.l AND dw.k = bw.k),
places AS (SELECT DISTINCT doc_id, unnest(range(s, s + l)) AS p FROM hit),
n AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN i ON d.doc_id = i.doc_id
"""

SUFFIX = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399, 500)) AS c FROM d),
piece AS (SELECT doc_id, c, substr(h, 2 * c + 1, 1798) AS h FROM c),
s AS (SELECT doc_id, c, h, unnest(range(0, len(h) // 2 - 399)) AS s FROM piece),
k AS (SELECT doc_id, c + s AS s, md5(substr(h, 2 * s + 1, 800)) AS k FROM s),
again AS (SELECT doc_id, s FROM k WHERE k IN (SELECT k FROM k GROUP BY k HAVING count(*) > 1)),
cut AS (SELECT *, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 400, true) AS new FROM again),
part AS (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY s) AS part FROM cut),
span AS (SELECT doc_id, min(s) AS a, max(s) + 400 AS b FROM part GROUP BY doc_id, part),
gone AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans, max(b) AS last FROM span GROUP BY doc_id),
before AS (SELECT doc_id, a, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS since FROM span),
lead AS (SELECT doc_id, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS x FROM before JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(x, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN lead USING (doc_id)
"""

SUBSTRING = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(0, len(w) - 34)) AS s FROM d),
k AS (SELECT doc_id, s, md5(array_to_string(w[s + 1 : s + 35], ' ')) AS k FROM s),
again AS (SELECT doc_id, s FROM k WHERE k IN (SELECT k FROM k GROUP BY k HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM again),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(0, len(w))) AS p FROM d),
stay AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS x FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(x, '')) AS kept_sha256
FROM d LEFT JOIN stay USING (doc_id)
"""

NEARDUP = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, least(5, len(w)) AS l, unnest(range(0, len(w) - least(5, len(w)) + 1)) AS s FROM d WHERE len(w) > 0),
g AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(w[s + 1 : s + l], ' ')) AS k FROM p),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
meet AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM meet JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS r FROM d UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.r),
least AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM d JOIN least USING (doc_id) LEFT JOIN n USING (doc_id)
"""

#: DuckDB has no SHA-1 in base 32: its hex digits are turned into five-bit groups by way of bits.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
r AS (SELECT html, max(page_id) AS response FROM p GROUP BY html HAVING count(*) > 1),
s AS (SELECT page_id, html, sha1(html) AS h FROM p),
bits AS (SELECT page_id, html, array_to_string([right('000' || bin(strpos('0123456789abcdef', substr(h, i, 1)) - 1), 4) FOR i IN range(1, 41)], '') AS b FROM s)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + 16 * CAST(substr(b, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(b, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * i + 4, 1) AS INT) + CAST(substr(b, 5 * i + 5, 1) AS INT), 1) FOR i IN range(0, 32)], '') AS payload_digest,
       CASE WHEN page_id < response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < response THEN response END AS refers_to
FROM bits LEFT JOIN r USING (html)
"""

#: floor(1000 * ln(...)) is in doubles, all else in whole numbers, products in 128 bits where 64 might not do.
RANKING = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
q AS (SELECT item_id, t, count(*) AS q FROM b GROUP BY ALL),
total AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
word AS (SELECT row, doc_id, len(w) AS n, unnest(w) AS t FROM d),
tf AS (SELECT row, doc_id, n, t, count(*) AS tf FROM word WHERE t IN (SELECT t FROM q) GROUP BY ALL),
weight AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY t),
impact AS (SELECT row, doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS x FROM tf JOIN weight USING (t), total),
score AS (SELECT item_id, row, doc_id, CAST(sum(q * x) AS BIGINT) AS score FROM impact JOIN q USING (t) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= 10
"""


def _rounds(n: int) -> str:
    """Steps of codebooks: from c{i} (part, entry, v) each part's nearest entry a{i}, and from these c{i + 1}."""
    out, squares = "", "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    for i in range(n + 1):
        out += f"""
a{i} AS MATERIALIZED (SELECT vec_id, part, min_by(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT vec_id, p.part, entry, {squares} AS d FROM p JOIN c{i} c ON p.part = c.part) GROUP BY ALL),"""
        if i < n:
            out += f"""
s{i} AS (SELECT part, entry, k, sum(x) AS s, count(*) AS n FROM (SELECT p.part, entry, unnest(range(1, len(v) + 1)) AS k, unnest(v) AS x FROM p JOIN a{i} USING (vec_id, part)) GROUP BY ALL),
m{i} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY k) AS v FROM s{i} GROUP BY part, entry),
c{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN m{i} m USING (part, entry)),"""
    return out


CODES = f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT unnest(range(16)) AS part),
p AS MATERIALIZED (SELECT vec_id, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS v FROM e, parts),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM e ORDER BY vec_id LIMIT 64),
c0 AS MATERIALIZED (SELECT part, entry, v FROM p JOIN f USING (vec_id)),{_rounds(2)}
code AS (SELECT vec_id, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id),
book AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS h FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM code JOIN e USING (vec_id), book
"""

#: Sums go from the first component to the last, as the operator's do, so that scores are equal to the last bit.
NEAREST = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
m AS (SELECT vec_id, v, list_max(list_transform(v, lambda x: abs(x))) AS m FROM e),
s AS (SELECT vec_id, list_transform(v, lambda x: x / m) AS v FROM m WHERE m > 0),
n AS (SELECT vec_id, v, list_reduce(list_transform(v, lambda x: x * x), lambda a, b: a + b) AS n FROM s),
p AS (SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]), lambda a, b: a + b) / sqrt(q.n * c.n) AS score
      FROM n q JOIN n c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM p QUALIFY rank <= 5
"""

ORACLE_SQL = {"op6_nearest": NEAREST, "op1_suffix": SUFFIX, "op4_decontaminate": DECONTAMINATE, "op7_neardup": NEARDUP, "op9_warc": WARC, "op10_substring": SUBSTRING, "op12_codes": CODES, "op13_ranking": RANKING}
