"""What the queries give, stated in DuckDB SQL by brute force: no filters, no index, no hashing."""

from __future__ import annotations

from skygalley.llm.licenses import CONTAINMENT, TEMPLATES, window

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x20\x09-\x0D]+"
_LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g
  FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b
  WHERE 100 * c.n >= 90 * (x.n + y.n - c.n)
), reach AS (
  SELECT a, b FROM links
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), smallest AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.b, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN smallest m ON m.a = d.doc_id
"""

EXACT = f"""
WITH lowered AS (SELECT doc_id, {_LOWERED} AS t FROM documents),
ranked AS (
  SELECT doc_id, t, first_value(doc_id) OVER (PARTITION BY t ORDER BY doc_id DESC) AS keep_id,
    count(*) OVER (PARTITION BY t) AS group_size
  FROM lowered
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM ranked
"""

SUBSTRING = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS t
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM words WHERE len(w) >= 20)
), later AS (
  SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY t ORDER BY doc_id, s) > 1
), removed AS (
  SELECT doc_id, list(DISTINCT p) AS r FROM (SELECT doc_id, unnest(generate_series(s, s + 19)) AS p FROM later)
  GROUP BY doc_id
), places AS (
  SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM words
), gone AS (
  SELECT doc_id, unnest(r) AS p FROM removed
), kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM places ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(len(r.r), 0) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN removed r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

# A block of a name that holds all its words can begin at one of them.
_NAME_STARTS = ", ".join(sorted({f"'{w}'" for text in TEMPLATES.values() if window(text)[1] == 1 for w in text.split()}))
_TEMPLATE_ROWS = ", ".join(f"('{label}', '{text}', {window(text)[0]}, {window(text)[1]})" for label, text in TEMPLATES.items())

LICENSES = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '{_LICENSE_WORD}') AS w FROM documents
), places AS (
  SELECT doc_id, w, unnest(generate_series(0, len(w) - 1)) AS p FROM words WHERE len(w) > 0
), base AS (
  SELECT doc_id, p, CASE
    WHEN w[p + 1] = 'cc' AND w[p + 2] = 'by' THEN 'cc-by'
    WHEN w[p + 1] = 'general' AND w[p + 2] = 'public' AND w[p + 3] = 'license' THEN 'gpl'
    WHEN w[p + 1] = 'all' AND w[p + 2] = 'rights' AND w[p + 3] = 'reserved' THEN 'reserved' END AS label
  FROM places
), found AS (
  SELECT doc_id, count(*) AS n, min(p) AS first_word, max(p) AS last_word, list(DISTINCT label) AS labels
  FROM base WHERE label IS NOT NULL GROUP BY doc_id
), templates AS (
  SELECT label, list_distinct(string_split(t, ' ')) AS ws, size, step FROM (VALUES {_TEMPLATE_ROWS}) v(label, t, size, step)
), blocks AS (
  SELECT doc_id, size, step, w[s + 1:s + size] AS b
  FROM (SELECT doc_id, w, size, step, unnest(generate_series(0, len(w) - 1, step)) AS s
        FROM words, (SELECT DISTINCT size, step FROM templates) WHERE len(w) > 0)
  WHERE step > 1 OR w[s + 1] IN ({_NAME_STARTS})
), held AS (
  SELECT doc_id, label, len(list_intersect(ws, b)) / len(ws) AS share FROM blocks JOIN templates USING (size, step)
), best AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(share) AS share FROM held WHERE share >= {CONTAINMENT} - 1e-9
  GROUP BY doc_id
)
SELECT w.doc_id, len(w.w) AS n_words, coalesce(f.n, 0) AS n_base, f.first_word, f.last_word,
  coalesce(array_to_string(list_sort(f.labels), ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(f.labels, []), coalesce(b.labels, [])))), ',') AS labels,
  CASE WHEN f.n > 0 THEN 1.0::DOUBLE ELSE coalesce(b.share, 0.0) END AS score
FROM words w LEFT JOIN found f USING (doc_id) LEFT JOIN best b USING (doc_id)
"""

WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
  FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM firsts
"""

# CRC-32 of a decimal number's characters, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda v, _: xor(v >> 1, (v & 1) * 3988292384))))"""

TRIE = f"""
WITH own AS (
  SELECT conv_id AS c, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), sized AS (
  SELECT c, l, ({_CRC32} % 4)::BIGINT AS h FROM own
), rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.l[1:a.h], []), a.l[a.h + 1:]) AS l FROM sized a LEFT JOIN own b ON b.c = a.c - a.c % 20
), beginnings AS (
  SELECT c, d, l[1:d] AS p, len(l) = d AS ends FROM (SELECT c, l, unnest(generate_series(0, len(l))) AS d FROM rebuilt)
), nodes AS (
  SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), ''))
    AS ends_sha256 FROM beginnings GROUP BY d, p
), families AS (
  SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), counted AS (
  SELECT n.*, coalesce(f.n_children, 0) AS n_children, CASE WHEN n.d = 0 THEN 0 ELSE
    (n.n_convs - 1) * len(regexp_extract_all(n.p[n.d].x, '{_WORD}')) END AS saved
  FROM nodes n LEFT JOIN families f ON f.d = n.d AND f.p = n.p
), ancestors AS (
  SELECT a, p[1:a] AS ap, n_children, saved FROM (SELECT *, unnest(generate_series(0, d)) AS a FROM counted)
), sums AS (
  SELECT a, ap, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM ancestors GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM counted n JOIN sums s ON s.a = n.d AND s.ap = n.p LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
"""

SQL = {
    "op2_ngram_jaccard": JACCARD,
    "op7_exact_dedup": EXACT,
    "op9_substring_dedup": SUBSTRING,
    "op10_license_scan": LICENSES,
    "op11_warc": WARC,
    "op13_conversation_trie": TRIE,
}
